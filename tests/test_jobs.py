"""Whole jobs on a small log with open, unmatched, repeated and dirty messages."""

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import helpers as h
from wattline import schemas
from wattline.operators.checks import audit, committed, data_files, schema_differences
from wattline.operators.messages import messages, reshape_meter_values, unpack_json
from wattline.plans import gold, silver
from wattline.sources.listing import is_committed, list_output, list_tree
from wattline.schemas import MESSAGE, SESSION_SAMPLES
from wattline.sources.tables import read_parquet
from wattline.streaming.status import count_statuses

WRITTEN = "2023-01-01T09:00:00.000000+00:00"


def message(message_id, kind, action, body):
    return (message_id, kind, "plug-1", action, WRITTEN, body if body is None else json.dumps(body))


def session(tx, start, stop, wh, samples):
    """A closed session: request, response, stop and one meter message per sample."""
    request = {"connector_id": 1, "id_tag": "t", "meter_start": 0, "timestamp": start, "reservation_id": None}
    response = {"transaction_id": tx, "id_tag_info": {"status": "Accepted", "parent_id_tag": "t", "expiry_date": None}}
    ended = {"meter_stop": wh, "timestamp": stop, "transaction_id": tx, "reason": None, "id_tag": "t", "transaction_data": None}
    rows = [
        message(f"start{tx}", 2, "StartTransaction", request),
        message(f"start{tx}", 3, "StartTransaction", response),
        message(f"stop{tx}", 2, "StopTransaction", ended),
    ]
    for i, (at, value) in enumerate(samples):
        wire = [h.sample(value, "Power.Active.Import", None), h.sample("0", "Power.Active.Import", "L1"), h.sample("0", "Voltage", None)]
        body = h.meter_body((at, wire), transaction_id=tx)
        rows.append((f"meter{tx}-{i}", 2, "plug-1", "MeterValues", WRITTEN, body))
    return rows


def log(spark):
    rows = [
        *session(1, "2023-01-01T08:00:00+00:00", "2023-01-01T09:00:00+00:00", 1000,
                 [(f"2023-01-01T08:{m:02d}:00+00:00", v) for m, v in ((0, "7.5"), (15, "0.0"), (20, "0"), (30, "0.00"), (40, "3"))]),
        *session(2, "2023-01-01T10:43:09.900215+00:00", "2023-01-01T18:31:34.833396+00:00", 95306,
                 [("2023-01-01T11:00:00+00:00", "5.0")]),
        *session(3, "2023-01-01T23:00:00+00:00", "2023-01-02T01:00:00+00:00", 10, [("2023-01-01T23:30:00+00:00", "0"), ("2023-01-02T00:30:00+00:00", "0")]),
        *session(4, "2023-01-01T08:00:00+00:00", "x", 0, [])[:2],
        message("stop9", 2, "StopTransaction", {"meter_stop": 1, "timestamp": WRITTEN, "transaction_id": 9}),
        message("stop1", 3, "StopTransaction", {"id_tag_info": None}),
        message("hb", 2, "Heartbeat", {}),
        message("nobody", 2, "MeterValues", None),
        ("broken", 2, "plug-1", "StopTransaction", WRITTEN, "{oops"),
    ]
    return spark.createDataFrame(rows, schemas.MESSAGE)


def time(*parts):
    return datetime(2023, 1, *parts)


SPANS = {
    1: (time(1, 8), time(1, 9), 1.0),
    2: (time(1, 10, 43, 9, 900215), time(1, 18, 31, 34, 833396), 7.81),
    3: (time(1, 23), time(2, 1), 2.0),
}
PARKING = {1: 0.25, 2: None, 3: 1.0}


def test_silver_tables(spark, out):
    df = log(spark)
    silver.write_silver(df, out, files=1)
    for name, table in silver.silver_tables(df).items():
        layout = list_output(spark, f"{out}/{name}").transform(audit, data_files(exact=1), committed())
        assert [r.passed for r in layout.collect()] == [True, True]
        assert is_committed(spark, f"{out}/{name}")
        back = read_parquet(spark, f"{out}/{name}")
        assert schema_differences(back.schema, table.schema) == []
        assert h.rows(back) == h.rows(table)
    counts = {name: table.count() for name, table in silver.silver_tables(df).items()}
    assert counts == {
        "StartTransactionRequest": 4,
        "StartTransactionResponse": 4,
        "StopTransactionRequest": 5,
        "MeterValuesRequest": 24,
    }


def test_small_silver_tables_are_brought_together_and_samples_stay(spark, out):
    df = log(spark).repartition(4)
    silver.write_silver(df, out)
    files = {n: list_tree(spark, f"{out}/{n}").count() for n in silver.silver_tables(df)}
    assert {n: f for n, f in files.items() if n != "MeterValuesRequest"} == {
        "StartTransactionRequest": 1, "StartTransactionResponse": 1, "StopTransactionRequest": 1,
    }
    assert files["MeterValuesRequest"] > 1
    assert read_parquet(spark, f"{out}/MeterValuesRequest").count() == 24


def test_records_from_silver(spark, out):
    records = gold.charge_detail_records_from_silver(silver.silver_tables(log(spark)))
    assert records.columns == schemas.SESSION.names + ["total_time", "total_energy", "total_parking_time"]
    found = {r.transaction_id: r for r in records.collect()}
    assert {k: (r.start_timestamp, r.stop_timestamp, r.total_time) for k, r in found.items()} == SPANS
    assert {k: r.total_energy for k, r in found.items()} == {1: 1.0, 2: 95.31, 3: 0.01}
    assert {k: r.total_parking_time for k, r in found.items()} == PARKING
    gold.write_gold(records, out, files=1)
    files = [r.name for r in list_output(spark, f"{out}/cdr").collect()]
    assert len([n for n in files if n.endswith(".snappy.parquet")]) == 1 and files.count("_SUCCESS") == 1


@pytest.mark.parametrize("typed", [True, False])
def test_records_from_the_raw_log(spark, typed):
    records = gold.charge_detail_records_from_log(log(spark), typed=typed)
    assert schema_differences(records.schema, schemas.CDR) == []
    found = {r.transaction_id: r for r in records.collect()}
    assert {k: (r.start_timestamp, r.stop_timestamp, r.total_time) for k, r in found.items()} == SPANS
    assert {k: r.total_energy for k, r in found.items()} == {1: 1000.0, 2: 95306.0, 3: 10.0}
    assert {k: r.total_parking_time for k, r in found.items()} == PARKING


def test_repeated_messages_count_once_if_asked(spark):
    df = log(spark)
    twice = df.unionByName(df)
    expected = h.rows(gold.charge_detail_records_from_log(df))
    assert h.rows(gold.charge_detail_records_from_log(twice, once=True)) == expected
    assert gold.charge_detail_records_from_log(twice).count() == 8 * len(expected)
    tables = silver.silver_tables(twice)
    records = gold.charge_detail_records_from_silver(tables, once=True)
    assert h.rows(records) == h.rows(gold.charge_detail_records_from_silver(silver.silver_tables(df)))


def test_parking_never_exceeds_the_session(spark):
    records = gold.charge_detail_records_from_silver(silver.silver_tables(log(spark)))
    assert records.filter(F.col("total_parking_time") > F.col("total_time")).count() == 0


def test_jobs_need_no_python_workers_and_parse_each_message_once(spark):
    text = h.physical(gold.charge_detail_records_from_log(log(spark)))
    assert "Python" not in text and "Pandas" not in text
    assert text.count("from_json(") == 4


def test_silver_reads_only_its_row_groups_of_a_bronze_log(spark, out):
    from wattline.plans.bronze import write_bronze

    write_bronze(log(spark), out)
    table = silver.stop_transaction_requests(spark.read.parquet(out))
    text = h.physical(table)
    assert "EqualTo(action,StopTransaction)" in text and "EqualTo(message_type,2)" in text


def test_jobs_parse_only_what_they_use(spark):
    log = spark.createDataFrame([], MESSAGE)
    plan = h.physical(gold.charge_detail_records_from_log(log))
    for unused in ("connector_id", "id_tag", "reservation_id", "reason", "transaction_data", "vendor_id", "unit"):
        assert unused not in plan
    stream = h.physical(log.transform(count_statuses))
    assert "error_code" not in stream and "StructField(status" in stream
    # A reading's time is parsed by the explode that makes it, and nowhere else.
    samples = log.transform(messages, "MeterValues", 2).transform(unpack_json, SESSION_SAMPLES)
    text = h.physical(samples.transform(reshape_meter_values).filter("timestamp IS NOT NULL"))
    parsing = [line for line in text.splitlines() if re.search(r"reading#\d+\.timestamp", line)]
    assert len(parsing) == 1 and "Generate" in parsing[0]
