"""Status counts on batches and streams, late reports, and the message stream sources."""

import json
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import helpers as h
from wattline.operators.checks import audit, data_files
from wattline.operators.status import status_counts
from wattline.schemas import STREAM_MESSAGE
from wattline.sources.listing import list_output
from wattline.sources.streams import read_message_stream
from wattline.sources.tables import read_parquet
from wattline.streaming.status import count_statuses, write_stream

DEVICE = "plug-7"
COUNTS = T.StructType(
    [
        T.StructField("charge_point_id", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField(
            "window",
            T.StructType([T.StructField("start", T.TimestampType(), True), T.StructField("end", T.TimestampType(), True)]),
            False,
        ),
        T.StructField("count(status)", T.LongType(), False),
    ]
)


def report(value, at, status="Reserved", action="StatusNotification", kind=2):
    body = json.dumps({"connector_id": 1, "status": status, "timestamp": f"{at}.000+0000"})
    return (value, DEVICE, action, kind, body)


def messages(spark, *rows):
    return spark.createDataFrame(rows, STREAM_MESSAGE)


def test_schema_and_windows_of_a_batch(spark):
    df = spark.createDataFrame(
        [(DEVICE, "Reserved", datetime(2023, 1, 1, 9, 25)), (DEVICE, "Reserved", datetime(2022, 1, 1, 9, 25))],
        "charge_point_id string, status string, timestamp timestamp",
    )
    result = df.transform(status_counts)
    assert result.schema == COUNTS
    assert h.rows(result.select("window.start", "window.end", "count(status)")) == [
        (datetime(2022, 1, 1, 9, 25), datetime(2022, 1, 1, 9, 30), 1),
        (datetime(2023, 1, 1, 9, 25), datetime(2023, 1, 1, 9, 30), 1),
    ]


def test_missing_status_and_window_edges(spark):
    df = spark.createDataFrame(
        [
            ("1", None, datetime(2023, 1, 1, 9, 4, 59)),
            ("1", "A", datetime(2023, 1, 1, 9, 4, 59)),
            ("1", "A", datetime(2023, 1, 1, 9, 5)),
            ("1", "A", None),
        ],
        "charge_point_id string, status string, timestamp timestamp",
    )
    result = df.transform(status_counts).select("status", F.minute("window.start"), "count(status)")
    assert h.rows(result) == [(None, 0, 0), ("A", 0, 1), ("A", 5, 1)]


def test_zoneless_times(spark):
    df = spark.sql("select '1' charge_point_id, 'A' status, timestamp_ntz'2023-01-01 09:01:00' timestamp")
    assert df.transform(status_counts).schema["window"] == COUNTS["window"]


def test_partial_counts_before_the_shuffle(spark):
    text = h.physical(messages(spark, report(0, "2023-01-01T09:00:00")).transform(count_statuses))
    assert "partial_count" in text[text.index("Exchange") :]


def run(spark, out):
    stream = read_message_stream(spark, f"{out}/in").transform(count_statuses)
    query = write_stream(stream, f"{out}/counts", f"{out}/checkpoint", files=1)
    query.awaitTermination()
    return query


def counts(spark, out):
    result = read_parquet(spark, f"{out}/counts")
    assert result.columns == ["charge_point_id", "status", "window", "count(status)"]
    return h.rows(result.select("status", "window.start", "count(status)"))


def test_stream_to_files_drops_what_comes_too_late(spark, out):
    spark.createDataFrame([], STREAM_MESSAGE).write.parquet(f"{out}/in")
    first = messages(
        spark,
        report(0, "2023-01-01T09:26:00"),
        report(1, "2023-01-01T09:29:00"),
        report(2, "2023-01-01T09:26:00", "Faulted"),
        report(3, "2023-01-01T09:26:00", action="Heartbeat"),
        report(4, "2023-01-01T09:26:00", kind=3),
        report(5, "2023-01-01T09:45:00"),
    )
    first.write.mode("append").parquet(f"{out}/in")
    run(spark, out)
    closed = [("Faulted", datetime(2023, 1, 1, 9, 25), 1), ("Reserved", datetime(2023, 1, 1, 9, 25), 2)]
    assert counts(spark, out) == closed

    late = messages(
        spark, report(6, "2022-01-01T09:25:00"), report(7, "2023-01-01T09:46:00"), report(8, "2023-01-01T10:30:00")
    )
    late.write.mode("append").parquet(f"{out}/in")
    query = run(spark, out)
    assert counts(spark, out) == sorted(closed + [("Reserved", datetime(2023, 1, 1, 9, 45), 2)])
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1
    layout = list_output(spark, f"{out}/counts").transform(audit, data_files(minimum=1))
    assert layout.first().passed


def test_stream_equals_batch_on_closed_windows(spark, out):
    rows = [report(i, f"2023-01-01T{9 + i // 60:02d}:{i % 60:02d}:00", "AB"[i % 3 % 2]) for i in range(180)]
    df = messages(spark, *rows)
    df.write.parquet(f"{out}/in")
    run(spark, out)
    batch = df.transform(count_statuses).filter("window.end <= timestamp'2023-01-01 11:49:00'")
    assert counts(spark, out) == h.rows(batch.select("status", "window.start", "count(status)"))


def test_message_stream_passes_rows_through(spark, out):
    df = messages(spark, (0, "plug-8", "StatusNotification", 2, "123"), (1, None, None, None, None))
    df.write.json(f"{out}/in")
    stream = read_message_stream(spark, f"{out}/in", "json")
    assert stream.isStreaming and stream.schema == STREAM_MESSAGE
    write_stream(stream, f"{out}/copy", f"{out}/checkpoint").awaitTermination()
    assert h.rows(read_parquet(spark, f"{out}/copy", STREAM_MESSAGE)) == h.rows(df)
