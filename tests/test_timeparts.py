from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from tests import helpers as h
from wattline.operators import timeparts as tp
from wattline.schemas import LAKE_MESSAGE
from wattline.sources.tables import read_time_slice


def lake_rows(spark):
    return spark.createDataFrame(
        [
            ("m-71", 2, "plug-4", "Heartbeat", "2023-01-01T09:00:00+00:00", "{}", 1),
            ("m-72", 2, "plug-4", "Heartbeat", "2023-01-01T09:05:00+00:00", "{}", 2),
        ],
        LAKE_MESSAGE,
    )


def test_bronze_parts_replace_the_text(spark):
    df = spark.createDataFrame(
        [(f"2023-01-01T{t}Z", "bar", "123") for t in ("09:00:00", "10:00:00", "10:30:00")],
        "write_timestamp string, action string, charge_point_id string",
    )
    result = df.transform(tp.bronze_partition_columns)
    assert result.columns == ["write_timestamp", "action", "charge_point_id", "year", "month", "day", "hour"]
    assert h.rows(result.drop("action", "charge_point_id")) == [
        (datetime(2023, 1, 1, 9), 2023, 1, 1, 9),
        (datetime(2023, 1, 1, 10), 2023, 1, 1, 10),
        (datetime(2023, 1, 1, 10, 30), 2023, 1, 1, 10),
    ]


@pytest.mark.parametrize(
    "operator, parts",
    [
        (tp.lake_partition_columns, ["year", "month", "day", "hour", "minute"]),
        (tp.event_log_partition_columns, ["year", "month", "day"]),
    ],
)
def test_lake_parts_keep_the_text(spark, operator, parts):
    result = lake_rows(spark).transform(operator)
    assert result.schema == T.StructType(
        LAKE_MESSAGE.fields + [T.StructField(part, T.IntegerType(), True) for part in parts]
    )
    assert h.rows(result.select(*parts)) == [(2023, 1, 1, 9, 0)[: len(parts)], (2023, 1, 1, 9, 5)[: len(parts)]]


def test_parts_of_a_bad_time_are_null(spark):
    df = spark.createDataFrame([("nope",)], "write_timestamp string").transform(tp.lake_partition_columns)
    assert tuple(df.first())[1:] == (None,) * 5


def test_event_time_is_appended(spark):
    df = spark.createDataFrame([("a", "2023-05-06T07:08:09.000123+00:00")], "message_id string, write_timestamp string")
    result = df.transform(tp.with_event_time)
    assert result.schema == T.StructType(df.schema.fields + [T.StructField("converted_timestamp", T.TimestampType())])
    assert result.first().converted_timestamp == datetime(2023, 5, 6, 7, 8, 9, 123)


@pytest.mark.parametrize(
    "at",
    [
        h.utc(2023, 1, 1, 9, 5),
        h.utc(2023, 1, 1, 9, 5, 59),
        datetime(2023, 1, 1, 9, 5, 30),
        datetime(2023, 1, 1, 11, 5, tzinfo=timezone(timedelta(hours=2))),
    ],
)
def test_time_slice_is_the_minute_around_a_time(spark, at):
    df = lake_rows(spark)
    result = df.transform(read_time_slice, at)
    assert result.schema == LAKE_MESSAGE
    assert [r.write_timestamp for r in result.collect()] == ["2023-01-01T09:05:00+00:00"]


def test_time_slice_edges(spark):
    texts = ["08:59:59.999999", "09:00:00", "09:00:59.999999", "09:01:00"]
    df = spark.createDataFrame([(f"2023-01-01T{t}+00:00",) for t in texts], "write_timestamp string")
    found = df.transform(read_time_slice, h.utc(2023, 1, 1, 9)).collect()
    assert [r[0][11:26] for r in found] == ["09:00:00+00:00", "09:00:59.999999"]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_slice_of_typed_columns_is_pushed_to_the_scan(spark, out, kind):
    df = lake_rows(spark).transform(tp.with_event_time, target="at")
    df.withColumn("at", df["at"].cast(kind)).write.parquet(out)
    result = spark.read.parquet(out).transform(read_time_slice, h.utc(2023, 1, 1, 9, 5), "at", "minute")
    assert result.count() == 1
    assert "GreaterThanOrEqual(at" in h.physical(result)


def test_time_slice_prunes_partitions(spark, out):
    lake_rows(spark).transform(tp.lake_partition_columns).write.partitionBy(*tp.parts_to("minute")).parquet(out)
    result = spark.read.parquet(out).transform(read_time_slice, h.utc(2023, 1, 1, 9, 5))
    assert result.count() == 1
    text = h.physical(result)
    filters = text[text.index("PartitionFilters: [") :].split("]")[0]
    assert all(f"({part}#" in filters for part in tp.parts_to("minute"))


def test_half_a_time_is_no_time(spark):
    full = ["2023-01-02T03:04:05Z", "2023-01-02T03:04:05.000006+00:00", "2023-01-02T03:04:05.000+0000", "2023-01-02 03:04:05"]
    half = ["12:30", "T09:00", "2023", "2023-01", "2023-01-02", "2023-01-02T03", "2023-01-02T03:04", "", "soon", "2023-13-02T03:04:05Z"]
    df = spark.createDataFrame([(text,) for text in [*full, *half, None]], "write_timestamp string")
    found = df.transform(tp.with_event_time).collect()
    assert all(row.converted_timestamp is not None for row in found[: len(full)])
    assert all(row.converted_timestamp is None for row in found[len(full) :])
    typed = spark.sql("select timestamp'2023-01-02 03:04:05' write_timestamp")
    assert typed.transform(tp.with_event_time).first().converted_timestamp is not None
