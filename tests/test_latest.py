from datetime import datetime

from pyspark.sql import functions as F

from tests import helpers as h
from wattline.operators.latest import drop_helpers, latest_per_key
from wattline.operators.order import report_order, top_k, top_k_by_key
from wattline.operators.timeparts import with_event_time
from wattline.plans.last_seen import last_seen_report
from wattline.schemas import MESSAGE


def heartbeats(spark):
    times = [("east", "04:10"), ("east", "04:55"), ("west", "05:01"), ("west", "05:20")]
    return spark.createDataFrame(
        [(device, f"2023-03-04T{t}:09.000071+00:00", "Heartbeat", "{}") for device, t in times],
        "charge_point_id string, write_timestamp string, action string, body string",
    ).transform(with_event_time)


def test_newest_row_of_each_device(spark):
    result = heartbeats(spark).transform(latest_per_key)
    assert result.columns == [
        "charge_point_id", "write_timestamp", "action", "body", "converted_timestamp", "rn",
    ]
    assert h.rows(result.select("charge_point_id", "converted_timestamp", "rn")) == [
        ("east", datetime(2023, 3, 4, 4, 55, 9, 71), 1),
        ("west", datetime(2023, 3, 4, 5, 20, 9, 71), 1),
    ]
    clean = result.transform(drop_helpers)
    assert clean.columns == ["charge_point_id", "action", "body", "converted_timestamp"]
    assert clean.transform(drop_helpers).columns == clean.columns


def test_rows_are_cut_before_the_shuffle(spark):
    text = h.physical(heartbeats(spark).transform(latest_per_key))
    assert "Partial" in text[text.index("Exchange") :] and "WindowGroupLimit" in text[text.index("Exchange") :]


def test_ties_and_missing_times(spark):
    df = spark.createDataFrame(
        [("1", "a", None), ("1", "b", datetime(2023, 1, 1)), ("1", "c", datetime(2023, 1, 1)), ("2", "d", None)],
        "charge_point_id string, message_id string, converted_timestamp timestamp",
    )
    result = df.transform(latest_per_key)
    assert h.rows(result.select("charge_point_id", "message_id")) == [("1", "c"), ("2", "d")]


def test_last_seen_report(spark):
    rows = [
        (f"{device}-{n}", 2, device, "Heartbeat", f"2023-01-06T23:{n:02d}:07.000005+00:00", "{}")
        for device in ("b", "a", "c")
        for n in range(5)
    ]
    report = spark.createDataFrame(rows, MESSAGE).transform(last_seen_report)
    assert report.columns == [
        "message_id", "message_type", "charge_point_id", "action", "body", "converted_timestamp",
    ]
    assert [(r.charge_point_id, r.message_id) for r in report.collect()] == [("a", "a-4"), ("b", "b-4"), ("c", "c-4")]


def test_top_k_by_column_nested_field_and_derived_key(spark):
    df = spark.createDataFrame(
        [(str(i), (10 - i,)) for i in range(10)], "id string, new_body struct<transaction_id: int>"
    )
    assert [r.id for r in df.transform(top_k, 3, "id").collect()] == ["0", "1", "2"]
    nested = df.transform(top_k, 3, "new_body.transaction_id")
    assert [r.id for r in nested.collect()] == ["9", "8", "7"]
    assert "TakeOrderedAndProject" in h.physical(nested)
    derived = df.transform(top_k_by_key, 2, -F.col("id").cast("int"))
    assert derived.columns == df.columns
    assert [r.id for r in derived.collect()] == ["9", "8"]
    assert [r.id for r in df.transform(report_order, "id").collect()] == [str(i) for i in range(10)]
