"""Tables that are kept up to date, checked or sorted out while they are written."""

import json
import os
import random
from datetime import datetime, timedelta
from itertools import permutations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import helpers as h
from wattline import bindings
from wattline.operators import checks, variant
from wattline.operators.idle import total_parking_time
from wattline.operators.quarantine import read_split, unpack_checked, write_split
from wattline.operators.sessions import close_session
from wattline.operators.timeparts import event_log_partition_columns
from wattline.plans import catalog, last_seen, parking, silver, upkeep
from wattline.schemas import LAKE_MESSAGE, MESSAGE, START_REQUEST, STOP_REQUEST, STREAM_MESSAGE
from wattline.sinks.buckets import bucketed_sessions, records_from_buckets, write_bucketed
from wattline.sinks.tables import append_lake_table
from wattline.sinks.versions import commits, read_parts, replace_parts, vacuum, versions
from wattline.sinks.zones import append_zoned, files_of_slice, note_zones, read_zoned_slice
from wattline.sources.listing import exists
from wattline.sources.streams import read_message_stream
from wattline.streaming.progress import ProgressLog
from wattline.streaming.status import count_statuses, write_stream
from wattline.streaming.upsert import open_windows, read_counts, upsert_counts, upsert_stream

FOLDER = "/root/testdata/sf0.001"
KEYS = ["charge_point_id", "status", "window"]
NUMBERED = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.DateType())])


# --- versions ----------------------------------------------------------------


def numbered(spark, *rows):
    return spark.createDataFrame([(k, v, datetime(2024, 1, day).date()) for k, v, day in rows], NUMBERED)


def state(spark, out, **options):
    return h.rows(read_parts(spark, out, NUMBERED, ["day"], **options).select("k", "v"))


def test_parts_are_replaced_one_by_one(spark, out):
    assert versions(spark, out) == [] and state(spark, out) == []
    replace_parts(numbered(spark, (1, "a", 1), (2, "b", 2)), out, 0, ["day"])
    replace_parts(numbered(spark, (3, "c", 2), (4, "d", 3)), out, 1, ["day"])
    assert versions(spark, out) == [0, 1]
    assert state(spark, out) == [(1, "a"), (3, "c"), (4, "d")]
    assert state(spark, out, only=numbered(spark, (0, "", 2), (0, "", 9))) == [(3, "c")]


def test_a_committed_version_is_not_made_again(spark, out):
    replace_parts(numbered(spark, (1, "a", 1)), out, 7, ["day"])
    replace_parts(numbered(spark, (1, "other", 1)), out, 7, ["day"])
    assert state(spark, out) == [(1, "a")]


def test_a_change_without_commit_is_not_seen_and_made_anew(spark, out):
    replace_parts(numbered(spark, (1, "a", 1)), out, 0, ["day"])
    numbered(spark, (1, "half", 1)).write.partitionBy("day").parquet(f"{out}/data/version=1")
    assert state(spark, out) == [(1, "a")]
    replace_parts(numbered(spark, (1, "whole", 1)), out, 1, ["day"])
    assert state(spark, out) == [(1, "whole")]


def test_vacuum_leaves_the_newest_state(spark, out):
    for number in range(3):
        replace_parts(numbered(spark, (number, "x", 1), (number, "y", 2 + number)), out, number, ["day"])
    numbered(spark, (9, "lost", 1)).write.parquet(f"{out}/data/version=8")
    before = state(spark, out)
    gone = vacuum(spark, out, NUMBERED, ["day"])
    assert gone == ["version=0/day=2024-01-01", "version=1/day=2024-01-01", "version=8"]
    assert state(spark, out) == before and not exists(spark, f"{out}/data/version=8")


def test_a_table_of_one_part_and_notes(spark, out):
    notes = spark.createDataFrame([("f1",), ("f2",)], "name string")
    replace_parts(spark.range(3), out, 0, [], notes=notes)
    replace_parts(spark.range(2), out, 1, [], notes=notes.limit(1))
    assert read_parts(spark, out, spark.range(1).schema, []).count() == 2
    assert h.rows(commits(spark, out, "name string").groupBy("version").count()) == [(0, 2), (1, 1)]


# --- streams -----------------------------------------------------------------


def report(value, at, status="Reserved", device="plug-7"):
    body = json.dumps({"connector_id": 1, "status": status, "timestamp": f"2023-01-01T{at}.000+0000"})
    return (value, device, "StatusNotification", 2, body)


def arrive(spark, out, *rows):
    spark.createDataFrame(rows, STREAM_MESSAGE).coalesce(1).write.mode("append").parquet(f"{out}/in")
    return count_statuses(read_message_stream(spark, f"{out}/in"))


def flat(df):
    return h.rows(df.select("status", F.date_format("window.start", "HH:mm"), "count(status)"))


def test_upserted_counts_have_open_windows_and_newer_counts(spark, out):
    run = lambda *rows: upsert_stream(arrive(spark, out, *rows), f"{out}/t", f"{out}/c", KEYS).awaitTermination()
    run(report(0, "09:01:00"), report(1, "09:02:00"), report(2, "09:59:00", "Free"))
    schema = arrive(spark, out).schema
    assert flat(read_counts(spark, f"{out}/t", schema)) == [("Free", "09:55", 1), ("Reserved", "09:00", 2)]
    run(report(3, "09:58:00", "Free"), report(4, "10:01:00"))
    want = [("Free", "09:55", 2), ("Reserved", "09:00", 2), ("Reserved", "10:00", 1)]
    assert flat(read_counts(spark, f"{out}/t", schema)) == want
    assert read_counts(spark, f"{out}/t", schema).columns == [*KEYS, "count(status)"]


def test_a_batch_that_is_repeated_changes_nothing(spark, out):
    rows = spark.createDataFrame([report(0, "09:01:00"), report(1, "09:02:00")], STREAM_MESSAGE).transform(count_statuses)
    more = spark.createDataFrame([report(i, "09:03:00") for i in range(5)], STREAM_MESSAGE).transform(count_statuses)
    for batch, counts in ((0, rows), (1, more), (1, more), (1, rows), (0, more)):
        upsert_counts(counts, out, batch, KEYS)
    assert flat(read_counts(spark, out, rows.schema)) == [("Reserved", "09:00", 5)]


def test_hours_that_did_not_change_are_not_written(spark, out):
    counts = lambda *rows: spark.createDataFrame(rows, STREAM_MESSAGE).transform(count_statuses)
    upsert_counts(counts(report(0, "09:01:00"), report(1, "10:02:00")), out, 0, KEYS)
    upsert_counts(counts(report(2, "10:03:00")), out, 1, KEYS)
    written = commits(spark, out, "window_part string")
    assert h.rows(written.select("version", "window_part")) == [(0, "2023-01-01-09"), (0, "2023-01-01-10"), (1, "2023-01-01-10")]


def test_written_and_open_windows_are_all_windows(spark, out):
    rows = [report(i, f"{9 + i // 4:02d}:{i % 4 * 15:02d}:00", "Free" if i % 3 else "Busy") for i in range(14)]
    counts = arrive(spark, out, *rows)
    write_stream(counts, f"{out}/t", f"{out}/c").awaitTermination()
    closed, still_open = spark.read.schema(counts.schema).parquet(f"{out}/t"), open_windows(spark, f"{out}/c")
    assert closed.count() and still_open.count()
    both = closed.unionByName(still_open)
    assert flat(both) == flat(spark.createDataFrame(rows, STREAM_MESSAGE).transform(count_statuses))


@pytest.mark.parametrize("written", [False, True])
def test_batches_as_rows(spark, out, written):
    with ProgressLog(spark, path=f"{out}/log" if written else None, every=2) as log:
        for rows in ([report(0, "09:01:00"), report(1, "11:00:00")], [report(2, "09:02:00"), report(3, "11:01:00"), report(4, "09:03:00", "Late")]):
            write_stream(arrive(spark, out, *rows), f"{out}/t", f"{out}/c").awaitTermination()
        found = log.rows().collect()
    assert len({row["batch"] for row in found}) == len(found) >= 2
    assert sum(row["input_rows"] for row in found) == 5
    assert sum(row["dropped_rows"] for row in found) == 2  # two groups of reports: Reserved and Late, both of 09:00
    assert all(row["started"] and row["processed_rate"] >= 0 for row in found)


def test_progress_of_named_streams_only(spark, out):
    with ProgressLog(spark, name="other") as log:
        write_stream(arrive(spark, out, report(0, "09:01:00")), f"{out}/t", f"{out}/c").awaitTermination()
        assert log.rows().count() == 0


# --- checks while writing ----------------------------------------------------


def stops(n):
    body = {"meter_stop": 5, "timestamp": "2023-01-01T09:00:00Z", "transaction_id": 1, "reason": None, "id_tag": "t", "transaction_data": None}
    return [(f"m{i}", 2, "plug-1", "StopTransaction", "2023-01-01T09:00:00Z", json.dumps({**body, "transaction_id": i})) for i in range(n)]


def test_checks_while_writing_are_those_of_an_audit(spark, out):
    log = spark.createDataFrame([*stops(20), ("b", 2, "plug-1", "StopTransaction", "x", "{oops")], MESSAGE).repartition(3)
    wanted = [checks.row_count(exact=21), checks.nulls("timestamp"), checks.domain("id_tag", ["t", "u"]), checks.nulls("reason", at_most=30)]
    found = silver.write_silver(log, out, checks={"StopTransactionRequest": wanted})
    want = silver.stop_transaction_requests(log).transform(checks.audit, *wanted)
    assert h.rows(found.drop("name")) == h.rows(want) and found.schema.names == ["name", *want.columns]
    assert silver.write_silver(log, f"{out}-plain") is None


def test_checks_cost_no_job_of_their_own(spark, out):
    log = spark.createDataFrame(stops(20), MESSAGE)
    tracker, counts = spark.sparkContext.statusTracker(), []
    for number, wanted in enumerate((None, {"StopTransactionRequest": [checks.row_count(minimum=1), checks.nulls("timestamp")]})):
        group = f"{out}-{number}"
        spark.sparkContext.setJobGroup(group, group)
        silver.write_silver(log, f"{out}-{number}", checks=wanted)
        counts.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] > 0


def test_a_watch_over_no_rows(spark, out):
    watch = checks.Watch(checks.row_count(minimum=1))
    watch.on(spark.range(0)).write.parquet(out)
    assert h.rows(watch.rows()) == [("row_count", 0, False)]


# --- quarantine and variants -------------------------------------------------


def bodies(spark, *texts):
    return spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "n int, body string")


def test_bad_bodies_keep_their_text_and_get_a_reason(spark, out):
    good = h.START_REQUEST_BODY
    bad = [None, "", "{oops", "[1]", "7", "nonsense", good[:-10], good.replace('"meter_start": 0', '"meter_start": "none"'), '"text"']
    rows = bodies(spark, good, "{}", '{"other": 1}', *bad).transform(unpack_checked, START_REQUEST)
    write_split(rows, out)
    kept = read_split(spark, out, rows.schema).collect()
    assert [row["n"] for row in kept] == [0, 1, 2] and kept[0]["new_body"]["connector_id"] == 1
    assert all(row["body"] is None and row["reason"] is None for row in kept)
    aside = read_split(spark, out, rows.schema, good=False).collect()
    assert {row["n"]: row["body"] for row in aside} == dict(enumerate(bad, 3))
    reasons = {row["body"]: row["reason"] for row in aside}
    assert reasons[None] == "missing" and reasons[bad[7]] == "untyped"
    assert {reasons[text] for text in bad[1:7]} == {"malformed"}
    assert all(row["new_body"] is None for row in aside)


def test_each_body_is_parsed_once(spark, out):
    bodies(spark, h.START_REQUEST_BODY).write.parquet(out)
    rows = spark.read.parquet(out).transform(unpack_checked, START_REQUEST).filter("new_body.connector_id > 0 AND reason IS NULL")
    assert h.physical(rows).count("from_json") == 1


def test_variants_keep_what_no_schema_declares(spark):
    texts = ['{"a": {"b": [1, {"c": "x"}]}, "n": 1.5}', '{"a": 3}', "{oops", None]
    rows = bodies(spark, *texts).transform(variant.with_variant)
    found = rows.transform(variant.at_paths, {"c": ("$.a.b[1].c", "string"), "n": ("$.n", "double"), "wrong": ("$.a", "int")}).orderBy("n")
    got = {(row["c"], row["n"], row["wrong"]) for row in found.collect()}
    assert got == {("x", 1.5, None), (None, None, 3), (None, None, None)}
    extra = rows.transform(variant.undeclared, F.array(F.lit("a"))).select("undeclared").collect()
    assert [row[0] for row in extra] == [["n"]]
    schema = rows.filter("any_body IS NOT NULL").transform(variant.inferred_schema).first()[0]
    assert "a: VARIANT" in schema and "n: DECIMAL" in schema


def test_undeclared_keys_are_listed_once_and_without_text(spark, out):
    bodies(spark, '{"b": 1, "a": {"c": 2}}', "[1]", "3").write.parquet(out)
    rows = spark.read.parquet(out).transform(variant.with_variant).transform(variant.undeclared, F.array(F.lit("a")))
    plan = h.physical(rows)
    assert plan.count("map_keys") + plan.count("json_object_keys") == 1 and "to_json" not in plan
    assert [row["undeclared"] for row in rows.collect()] == [["b"]]


# --- incremental jobs --------------------------------------------------------


def samples(spark, rows):
    return spark.createDataFrame(rows, "transaction_id long, timestamp timestamp, value double")


def drawn(n, seed):
    pick, start = random.Random(seed), datetime(2024, 1, 1, 22)
    times = [start + timedelta(minutes=7 * pick.randrange(60)) for _ in range(n)]
    return [(pick.choice([1, 1, 2, None]), at, pick.choice([0.0, 0.0, 0.0, 3.0, None])) for at in times]


@pytest.mark.parametrize("order", list(permutations(range(3)))[:4])
def test_slices_in_any_order_give_the_time_of_all_samples(spark, out, order):
    rows = drawn(150, 4)
    parts = [rows[0::3], rows[1::3], rows[2::3] + rows[:20]]
    for number, part in enumerate(order):
        parking.update_parking(samples(spark, parts[part]), out, number)
    parking.update_parking(samples(spark, parts[order[0]]), out, 99)  # once more
    want = samples(spark, rows).transform(total_parking_time)
    assert h.rows(parking.parking_so_far(spark, out)) == h.rows(want) and want.count()


def test_a_slice_writes_its_own_days_only(spark, out):
    parking.update_parking(samples(spark, [(1, datetime(2024, 1, d, 5, m), 0.0) for d in (1, 2, 3) for m in (0, 30)]), out, 0)
    parking.update_parking(samples(spark, [(1, datetime(2024, 1, 2, 5, 15), 2.0)]), out, 1)
    assert h.rows(commits(spark, f"{out}/instants", "part string").filter("version = 1").select("part")) == [("2024-01-02",)]
    # Idle from the 1st, 5:00, to the 2nd, 5:00, and from the 2nd, 5:30, on.
    assert h.rows(parking.parking_so_far(spark, out)) == [(1, 48.0)]


def test_other_ideas_of_idle(spark, out):
    rows = [row for row in drawn(80, 9) if row[0]]
    idle = F.coalesce(F.col("value") < 4, F.lit(True))
    for number in range(2):
        parking.update_parking(samples(spark, rows[number::2]), out, number, idle=idle, no_session=[2])
    want = samples(spark, rows).transform(total_parking_time, idle=idle, no_session=[2])
    assert h.rows(parking.parking_so_far(spark, out)) == h.rows(want)


def message(number, device, at):
    return (f"m{number}", 2, device, "Heartbeat", f"2023-01-0{1 + number % 3}T{at}+00:00", "{}", 0)


def test_updates_read_new_files_only_and_equal_the_whole_report(spark, out):
    rows = [message(i, f"plug-{i % 5}", f"{i % 24:02d}:00:00") for i in range(60)]
    read = []
    for order in range(3):
        part = spark.createDataFrame(rows[2 - order :: 3], LAKE_MESSAGE).transform(event_log_partition_columns)
        append_lake_table(part, f"{out}/lake", to="day")
        read.append({tuple(row) for row in last_seen.update_last_seen(spark, f"{out}/lake", f"{out}/state").collect()})
    assert all(read) and not (read[0] & read[1] or read[1] & read[2] or read[0] & read[2])
    assert last_seen.update_last_seen(spark, f"{out}/lake", f"{out}/state").count() == 0
    assert versions(spark, f"{out}/state") == [0, 1, 2]
    want = spark.createDataFrame(rows, LAKE_MESSAGE).transform(last_seen.last_seen_report)
    assert [tuple(row) for row in last_seen.last_seen_so_far(spark, f"{out}/state").collect()] == [tuple(row) for row in want.collect()]


def test_an_update_opens_no_old_file(spark, out):
    part = lambda rows: spark.createDataFrame(rows, LAKE_MESSAGE).transform(event_log_partition_columns)
    append_lake_table(part([message(0, "a", "01:00:00")]), f"{out}/lake", to="day")
    last_seen.update_last_seen(spark, f"{out}/lake", f"{out}/state")
    append_lake_table(part([message(1, "a", "02:00:00")]), f"{out}/lake", to="day")
    files = last_seen.new_files(spark, f"{out}/lake", f"{out}/state")
    opened = last_seen.read_files(spark, f"{out}/lake", files, LAKE_MESSAGE).inputFiles()
    assert len(opened) == files.count() == 1 and "day=2" in opened[0]


# --- layouts -----------------------------------------------------------------


def test_joins_of_buckets_need_no_exchange(spark, out):
    tables = silver.silver_tables(spark.createDataFrame(stops(30), MESSAGE))
    names = ("StartTransactionRequest", "StartTransactionResponse", "StopTransactionRequest")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sides = bucketed_sessions(*(tables[name] for name in names), out, f"t{abs(hash(out)) % 10**9}", 4)
        closed = sides["stops"].transform(close_session, sides["starts"])
        assert "SortMergeJoin" in h.physical(closed) and "Exchange" not in h.physical(closed)
        parked = spark.createDataFrame([], "transaction_id int, total_parking_time double")
        assert records_from_buckets(sides, parked).count() == 0
        one = write_bucketed(spark.range(50), f"n{abs(hash(out)) % 10**9}", f"{out}/n", ["id"], 4)
        both = one.join(one.withColumnRenamed("id", "i"), F.col("id") == F.col("i"))
        assert both.count() == 50 and "Exchange" not in h.physical(both)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


TIMED = T.StructType([T.StructField("n", T.LongType()), T.StructField("at", T.TimestampType())])


def timed(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("n"), F.timestamp_seconds(F.col("id") * 600).alias("at"))


def test_a_slice_opens_files_that_can_hold_it(spark, out):
    append_zoned(timed(spark, 0, 1440), out, "at", files=10)  # ten days
    day = datetime(1970, 1, 4, 12)
    opened = files_of_slice(spark, out, day, "day")
    assert 0 < len(opened) <= 3
    rows = read_zoned_slice(spark, out, day, TIMED, "at", "day")
    assert sorted(row["n"] for row in rows.collect()) == list(range(3 * 144, 4 * 144))
    assert len(rows.inputFiles()) == len(opened)


def test_late_rows_are_found_in_their_new_files(spark, out):
    append_zoned(timed(spark, 0, 1440).filter("n % 7 > 0"), out, "at", files=10)
    append_zoned(timed(spark, 0, 1440).filter("n % 7 = 0"), out, "at", files=2)
    rows = read_zoned_slice(spark, out, datetime(1970, 1, 4), TIMED, "at", "day")
    assert sorted(row["n"] for row in rows.collect()) == list(range(3 * 144, 4 * 144))
    assert len(rows.inputFiles()) < 12


def test_files_without_notes_are_opened(spark, out):
    append_zoned(timed(spark, 0, 144), out, "at", files=1)
    timed(spark, 400, 410).write.mode("append").parquet(out)
    assert read_zoned_slice(spark, out, datetime(1970, 1, 3), TIMED, "at", "day").count() == 10
    note_zones(spark, out, "at")
    assert len(files_of_slice(spark, out, datetime(1970, 1, 1), "day")) == 1
    assert read_zoned_slice(spark, out, datetime(1980, 1, 1), TIMED, "at", "day").count() == 0


def test_rows_without_a_time(spark, out):
    rows = spark.createDataFrame([(1, None), (2, datetime(1970, 1, 1, 5))], TIMED)
    append_zoned(rows, out, "at", files=1)
    assert [row["n"] for row in read_zoned_slice(spark, out, datetime(1970, 1, 1), TIMED, "at", "day").collect()] == [2]


def test_stop_bodies_that_lost_a_type(spark):
    text = json.dumps({"meter_stop": "many", "transaction_id": 4})
    found = bodies(spark, text).transform(unpack_checked, STOP_REQUEST).first()
    assert found["reason"] == "untyped" and found["body"] == text


# --- meter messages of the test tables ---------------------------------------


def test_meter_bodies_are_put_together_as_text(spark):
    line = "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    rows = [(7, 1, 3, 40.0, 8.5, 0.0, None, datetime(1996, 8, 6)), (None, None, None, None, None, None, None, None)]
    lines = spark.createDataFrame(rows, line)
    found = bindings.meter_values(lines)
    assert "to_json" not in h.physical(found)
    end = '"location":"Outlet","unit":'

    def reading(time, power, voltage, phase):
        start = '"context":"Sample.Periodic","format":"Raw","measurand":'
        return (
            f'{{"timestamp":{time},"sampled_value":[{{"value":{power},{start}"Power.Active.Import","phase":null,{end}"W"}},'
            f'{{"value":{voltage},{start}"Voltage","phase":"L1-N",{end}"V"}},{{"value":{phase},{start}"Power.Active.Import","phase":"L1",{end}"W"}}]}}'
        )

    times = [f'"1996-08-06T{hour}:00:00.000000+00:00"' for hour in ("00", "06")]
    full, empty = (row["body"] for row in found.collect())
    both = ",".join(reading(time, '"0.0"', '"8.5"', "null") for time in times)
    assert full == f'{{"connector_id":1,"meter_value":[{both}],"transaction_id":7}}'
    both = ",".join([reading("null", "null", "null", "null")] * 2)
    assert empty == f'{{"connector_id":null,"meter_value":[{both}],"transaction_id":null}}'


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_slices_of_samples_parse_no_body_again(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(upkeep.parking, "update_parking", lambda samples, *_, **__: plans.append(h.physical(samples)))
    monkeypatch.setattr(upkeep.parking, "parking_so_far", lambda session, _: session.range(1))
    catalog.QUERIES["parking_incremental"](spark, FOLDER)
    assert len(plans) == 3 and not any("from_json" in plan for plan in plans)
