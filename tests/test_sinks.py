"""Written layouts: directories, file counts, hot partitions, read-back."""

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from wattline.operators.timeparts import bronze_partition_columns, parts_to
from wattline.plans import lake
from wattline.plans.bronze import write_bronze
from wattline.schemas import LAKE_MESSAGE, MESSAGE
from wattline.session import shared_folder
from wattline.sinks.tables import lake_format, write_event_log, write_log_partitioned, write_table
from wattline.sources.listing import exists, is_committed, layout_report, list_children, list_output, list_tree
from wattline.sources.tables import read_last_minute, read_message_log, read_parquet


def log(spark, times, device="d"):
    return spark.createDataFrame(
        [(f"m{i}", 2, f"{device}{i % 2}", "ab"[i % 2], t, '{"k": "a, \\"b\\""}') for i, t in enumerate(times)], MESSAGE
    )


def names(spark, path):
    return [r.name for r in list_output(spark, path).collect() if not r.name.startswith(".")]


HOURS = [f"2023-{month}-0{day}T{hour:02d}:15:00Z" for month in ("01", "02") for day in (1, 2) for hour in (8, 9, 23)]


@pytest.mark.parametrize("one_file", [False, True])
def test_bronze_layout(spark, out, one_file):
    df = log(spark, HOURS * 5)
    write_bronze(df, out, one_file=one_file)
    assert [n for n in names(spark, out) if n != "_SUCCESS"] == ["year=2023/"]
    assert names(spark, f"{out}/year=2023") == ["month=1/", "month=2/"]
    assert names(spark, f"{out}/year=2023/month=1") == ["day=1/", "day=2/"]
    assert names(spark, f"{out}/year=2023/month=1/day=1") == ["hour=23/", "hour=8/", "hour=9/"]
    leaf = names(spark, f"{out}/year=2023/month=1/day=1/hour=8")
    assert len(leaf) == 1 and leaf[0].endswith(".snappy.parquet")
    assert {r.files for r in layout_report(spark, out).collect()} == {1}
    assert is_committed(spark, out)
    assert spark.read.parquet(out).count() == len(HOURS) * 5


def test_hot_hour_is_split_and_stays_whole(spark, out):
    """A third and more of all rows in one hour: several tasks write it, nothing is lost."""
    hot = spark.range(60000).select(
        F.concat(F.lit("m"), "id").alias("message_id"),
        F.lit(2).alias("message_type"),
        F.lit("d").alias("charge_point_id"),
        F.lit("a").alias("action"),
        F.when(F.col("id") % 3 > 0, "2023-01-01T08:00:00Z").otherwise("2023-01-01T09:00:00Z").alias("write_timestamp"),
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_log_partitioned(hot.transform(bronze_partition_columns), out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    report = {r.leaf[-6:]: r.files for r in layout_report(spark, out).collect()}
    assert report["hour=8"] > 1
    back = spark.read.parquet(out)
    assert back.count() == 60000 and back.select("message_id").distinct().count() == 60000


def test_sort_within_files_serves_the_writer_too(spark):
    df = log(spark, HOURS).transform(bronze_partition_columns)
    parts = parts_to("hour")
    placed = df.hint("rebalance", *parts).sortWithinPartitions(*parts, "action", "message_type")
    assert h.physical(placed).count("Sort [") == 1


def test_table_is_one_file_with_marker(spark, out):
    df = log(spark, HOURS).repartition(4)
    write_table(df, out)
    found = names(spark, out)
    assert len([n for n in found if n.endswith(".snappy.parquet")]) == 1
    assert found.count("_SUCCESS") == 1
    write_table(df, out, files=3)
    assert len([n for n in names(spark, out) if n.endswith(".snappy.parquet")]) == 3
    assert h.rows(read_parquet(spark, out)) == h.rows(df)


def test_one_file_is_joined_from_what_many_tasks_wrote(spark, out):
    df = spark.range(0, 4000, 1, 4).selectExpr("id", "IF(id % 3 > 0, CAST(id AS STRING), null) AS text", "array(id, null) AS ids")
    tasks = df.select(F.spark_partition_id().alias("task"), "*")
    write_table(tasks, out, files=1, in_place=True)
    file, = [n for n in names(spark, out) if n.endswith(".snappy.parquet")]
    assert pq.ParquetFile(f"{out}/{file}").num_row_groups == 4  # one of each task
    back = spark.read.parquet(out)
    assert back.schema == spark.read.schema(tasks.schema).parquet(out).schema
    assert h.rows(back) == h.rows(tasks) and back.select("task").distinct().count() == 4
    assert h.rows(back.filter("id = 3999")) == h.rows(tasks.filter("id = 3999"))
    assert is_committed(spark, out) and not [n for n in names(spark, out[: out.rindex("/")]) if n.startswith("_")]


def test_one_file_is_written_in_every_mode(spark, out):
    one, other = spark.range(5), spark.range(5, 8)
    write_table(one, out, files=1, mode="error")
    with pytest.raises(Exception):
        write_table(other, out, files=1, mode="error")
    write_table(other, out, files=1, mode="ignore")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    write_table(other, out, files=1, mode="append")
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(8))
    write_table(other, out, files=1)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [5, 6, 7]
    write_table(one.limit(0), out, files=1)
    assert spark.read.parquet(out).count() == 0 and names(spark, out).count("_SUCCESS") == 1
    assert len([n for n in names(spark, out) if n.endswith(".parquet")]) == 1


@pytest.mark.parametrize("format", ["parquet", "orc", "json", "csv"])
def test_log_formats(spark, out, format):
    df = log(spark, HOURS)
    df.write.format(format).options(**({"header": "true", "escape": '"'} if format == "csv" else {})).save(out)
    result = read_message_log(spark, out, format)
    assert result.schema == MESSAGE
    assert h.rows(result) == h.rows(df)


def lake_rows(spark, *times):
    return spark.createDataFrame(
        [(f"m{i}", 2, f"d{i % 2}", "Heartbeat", t, "{}", i) for i, t in enumerate(times)], LAKE_MESSAGE
    )


def test_lake_minutes(spark, out):
    lake.append_bronze(lake_rows(spark, "2023-01-01T09:00:00+00:00", "2023-01-01T09:05:10+00:00"), f"{out}/lake")
    lake.append_bronze(lake_rows(spark, "2023-01-01T09:05:50+00:00"), f"{out}/lake")
    assert names(spark, f"{out}/lake/year=2023/month=1/day=1/hour=9") == ["minute=0/", "minute=5/"]

    now = h.utc(2023, 1, 1, 9, 6, 30)
    arrived = read_last_minute(spark, f"{out}/lake", now)
    assert arrived.columns == LAKE_MESSAGE.names + parts_to("minute")
    assert sorted(r.write_timestamp[17:19] for r in arrived.collect()) == ["10", "50"]
    assert len(arrived.inputFiles()) == 2
    nothing = read_last_minute(spark, f"{out}/lake", h.utc(2023, 1, 1, 12))
    assert nothing.columns == arrived.columns and nothing.count() == 0

    lake.run_minute(spark, f"{out}/lake", f"{out}/log", now)
    for device in ("d0", "d1"):
        path = f"{out}/log/charge_point_id={device}/year=2023/month=1/day=1"
        assert exists(spark, path) == (device == "d0") or list_output(spark, path).count() > 0
    assert spark.read.parquet(f"{out}/log").count() == 2


def test_last_minute_of_a_table_with_day_directories(spark, out):
    df = lake_rows(spark, "2023-01-01T09:00:00+00:00", "2023-01-01T09:05:10+00:00")
    lake.append_bronze(df, out, to="day")
    assert read_last_minute(spark, out, h.utc(2023, 1, 1, 9, 6), to="day").count() == 1
    assert read_last_minute(spark, out, datetime(2023, 1, 2, 12), to="day", unit="day").count() == 2


def test_event_log_layout(spark, out):
    df = lake_rows(spark, *["2023-01-01T09:00:00+00:00"] * 6)
    write_event_log(df.transform(lake.event_log_partition_columns), out)
    assert {r.leaf: r.files for r in layout_report(spark, out).collect()} == {
        f"charge_point_id=d{i}/year=2023/month=1/day=1": 1 for i in (0, 1)
    }
    assert list_tree(spark, out).filter(F.col("name").endswith(".snappy.parquet") & (F.col("size") > 0)).count() == 2


def test_event_log_stream_takes_every_file_once(spark, out):
    def run():
        lake.stream_event_log(spark, f"{out}/lake", f"{out}/log", f"{out}/checkpoint").awaitTermination()
        return read_parquet(spark, f"{out}/log").count()

    lake.append_bronze(lake_rows(spark, "2023-01-01T09:00:00+00:00", "2023-01-01T09:05:10+00:00"), f"{out}/lake")
    assert run() == 2
    assert run() == 2
    lake.append_bronze(lake_rows(spark, "2023-01-02T09:05:50+00:00"), f"{out}/lake")
    assert run() == 3
    assert names(spark, f"{out}/log/charge_point_id=d0/year=2023/month=1") == ["day=1/", "day=2/"]


def test_lake_format_without_the_package(spark):
    assert lake_format(spark) == "parquet"


def test_shared_folder_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    assert base is None or first.startswith(base)


def test_filter_on_a_kind_skips_row_groups_of_the_bronze_log(spark, out):
    df = spark.range(60000).select(
        F.concat(F.lit("m"), "id").alias("message_id"),
        F.lit(2).alias("message_type"),
        F.lit("d").alias("charge_point_id"),
        F.when(F.col("id") % 10 == 0, "StartTransaction").otherwise("MeterValues").alias("action"),
        F.lit("2023-01-01T08:00:00Z").alias("write_timestamp"),
        F.sha2(F.col("id").cast("string"), 512).alias("body"),
    )
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(256 * 1024))
    try:
        write_bronze(df, out)
    finally:
        hadoop.unset("parquet.block.size")
    starts = spark.read.parquet(out).filter("action = 'StartTransaction'")
    assert starts.count() == 6000

    def read(table):
        plan = table._jdf.queryExecution().executedPlan()
        table._jdf.queryExecution().toRdd().count()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    assert read(starts.select("body")) < 20000


def test_missing_lake_is_an_error(spark, out):
    with pytest.raises(FileNotFoundError):
        read_last_minute(spark, f"{out}/nowhere", h.utc(2023, 1, 1, 9))


def test_stream_adds_one_file_per_device_and_day(spark, out):
    rows = [(f"m{i}", 2, f"d{i % 20}", "Heartbeat", "2023-01-01T09:00:00+00:00", "{}", i) for i in range(400)]
    df = spark.createDataFrame(rows, LAKE_MESSAGE).repartition(4)
    df.write.parquet(f"{out}/lake")
    lake.stream_event_log(spark, f"{out}/lake", f"{out}/log", f"{out}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{out}/log").count() == 400
    assert {r.files for r in layout_report(spark, f"{out}/log").collect()} == {1}
    assert layout_report(spark, f"{out}/log").count() == 20


def test_leaves_of_repeated_names_stay_apart(spark, out):
    for x in (1, 2):
        spark.range(1).coalesce(1).write.parquet(f"{out}/log/x={x}/log/y=1")
    assert sorted(r.leaf for r in layout_report(spark, f"{out}/log").collect()) == ["x=1/log/y=1", "x=2/log/y=1"]
    assert h.rows(list_children(spark, f"{out}/log").select("name", "files")) == [("x=1/", 1), ("x=2/", 1)]
