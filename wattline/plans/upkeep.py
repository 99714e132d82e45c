"""Queries over tables that are kept up to date, checked or sorted out while they are written."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from wattline import bindings
from wattline.operators import checks, variant
from wattline.operators.idle import total_parking_time
from wattline.operators.messages import reshape_meter_values, unpack_json
from wattline.operators.quarantine import read_split, unpack_checked, write_split
from wattline.operators.timeparts import event_log_partition_columns, with_event_time
from wattline.plans import last_seen, parking, silver
from wattline.plans.catalog import (
    COUNTS_SQL,
    EVENTS_SQL,
    LATEST_SQL,
    METER,
    METER_VALUES_WIDE,
    PARKING,
    PROPS,
    SESSION_SAMPLES_WIDE,
    SQL,
    START,
    STATUS,
    STOP,
    Tables,
    _flat_window,
    query,
)
from wattline.schemas import MESSAGE, REQUEST
from wattline.sinks.buckets import bucketed_sessions, records_from_buckets
from wattline.sinks.tables import append_lake_table, write_table
from wattline.sinks.zones import append_zoned, read_zoned_slice
from wattline.sources import streams
from wattline.sources.tables import read_parquet
from wattline.streaming.progress import ProgressLog
from wattline.streaming.status import count_statuses, write_stream
from wattline.streaming.upsert import open_windows, read_counts, upsert_stream

CUT = "2024-01-10"
COUNT_KEYS = ["charge_point_id", "status", "window"]


# --- streams -----------------------------------------------------------------


def _arriving(t: Tables, out: str, rows: DataFrame) -> DataFrame:
    """Counts of the status reports in a folder, after those of ``rows`` have come in."""
    bindings.status_notifications(rows).write.mode("append").parquet(f"{out}/in")
    return count_statuses(streams.read_message_stream(t.spark, f"{out}/in", schema=MESSAGE))


@query(COUNTS_SQL)
def status_counts_upserted(t: Tables) -> DataFrame:
    """A table in update mode has the open windows as well; the second run goes on where the first one ended."""
    out, cut = t.scratch("status-upserted"), F.lit(CUT).cast("timestamp_ntz")
    for part in (F.col("ts") < cut, F.col("ts") >= cut):
        counts = _arriving(t, out, t["events"].filter(part))
        upsert_stream(counts, f"{out}/counts", f"{out}/checkpoint", COUNT_KEYS, to="month").awaitTermination()
    return read_counts(t.spark, f"{out}/counts", counts.schema).transform(_flat_window)


@query(f"SELECT *, window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events) AS closed FROM ({COUNTS_SQL})")
def status_counts_open(t: Tables) -> DataFrame:
    """Windows that a stopped stream has written, and those that are still in its state."""
    out = t.scratch("status-open")
    counts = _arriving(t, out, t["events"])
    write_stream(counts, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    closed = read_parquet(t.spark, f"{out}/counts", counts.schema).transform(_flat_window)
    still_open = open_windows(t.spark, f"{out}/checkpoint").transform(_flat_window)
    return closed.withColumn("closed", F.lit(True)).unionByName(still_open.withColumn("closed", F.lit(False)))


@query(f"""
SELECT true AS once_each, CAST((SELECT count(*) FROM events) AS BIGINT) AS input_rows,
       CAST((SELECT count(*) FROM ({COUNTS_SQL})
        WHERE window_end <= TIMESTAMP '{CUT} 00:00:00') AS BIGINT) AS dropped_rows""")
def stream_progress(t: Tables) -> DataFrame:
    """Batches as rows: reports of the first days come after the others, and all their windows are dropped."""
    out, cut = t.scratch("status-progress"), F.lit(CUT).cast("timestamp_ntz")
    with ProgressLog(t.spark) as log:
        for part in (F.col("ts") >= cut, F.col("ts") < cut):
            counts = _arriving(t, out, t["events"].filter(part))
            run = write_stream(counts, f"{out}/counts", f"{out}/checkpoint")
            run.awaitTermination()
        batches = log.rows().filter(F.col("query").isNull())
    return batches.agg(
        (F.count_distinct("batch") == F.count("batch")).alias("once_each"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("dropped_rows").alias("dropped_rows"),
    )


# --- checks while writing, quarantine, undeclared keys -----------------------


@query("""
WITH stops AS (SELECT count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)),
power AS (SELECT 6 * count(*) AS n FROM lineitem)
SELECT 'StopTransactionRequest' AS name, 'row_count' AS "check", n AS observed, n >= 1 AS passed FROM stops
UNION ALL SELECT 'StopTransactionRequest', 'nulls(reason)', n, n = 0 FROM stops
UNION ALL SELECT 'StopTransactionRequest', 'nulls(timestamp)', 0, true FROM stops
UNION ALL SELECT 'MeterValuesRequest', 'row_count', n, n >= 1 FROM power
UNION ALL SELECT 'MeterValuesRequest', 'domain(measurand)', 0, n > 0 FROM power
UNION ALL SELECT 'MeterValuesRequest', 'nulls(value)', 0, true FROM power""")
def silver_checked(t: Tables) -> DataFrame:
    """Checks made by the tasks that write the silver tables; one of them fails, as stops give no reason."""
    found = silver.write_silver(
        t.log(START, STOP, METER),
        t.scratch("silver"),
        wide_ids=True,
        checks={
            "StopTransactionRequest": [checks.row_count(minimum=1), checks.nulls("reason"), checks.nulls("timestamp")],
            "MeterValuesRequest": [
                checks.row_count(minimum=1),
                checks.domain("measurand", ["Power.Active.Import", "Voltage"]),
                checks.nulls("value"),
            ],
        },
    )
    return found


DAMAGED = """
SELECT event_id, CASE event_id % 5 WHEN 1 THEN substr(props, 1, 5) WHEN 2 THEN '{"k": "none"}' WHEN 3 THEN NULL WHEN 4 THEN 'k' ELSE props END AS body
FROM events"""


@query(f"""
SELECT CAST(event_id AS VARCHAR) AS message_id,
       CASE WHEN event_id % 5 = 0 THEN CAST(json_extract(body, '$.k') AS INTEGER) END AS k,
       CASE WHEN event_id % 5 > 0 THEN body END AS body,
       CASE event_id % 5 WHEN 1 THEN 'malformed' WHEN 2 THEN 'untyped' WHEN 3 THEN 'missing' WHEN 4 THEN 'malformed' END AS reason,
       event_id % 5 = 0 AS good
FROM ({DAMAGED})""")
def bodies_quarantined(t: Tables) -> DataFrame:
    """Damaged bodies go to a directory of their own, with their text and a reason."""
    out, number = t.scratch("quarantine"), F.col("message_id").cast("long") % 5
    body = (
        F.when(number == 1, F.substring("body", 1, 5))
        .when(number == 2, '{"k": "none"}')
        .when(number == 3, F.lit(None))
        .when(number == 4, "k")
        .otherwise(F.col("body"))
    )
    rows = t.events.withColumn("body", body).transform(unpack_checked, PROPS)
    write_split(rows, out)
    sides = [read_split(t.spark, out, rows.schema, good).withColumn("good", F.lit(good)) for good in (True, False)]
    return sides[0].unionByName(sides[1]).select("message_id", "new_body.k", "body", "reason", "good")


@query("""
SELECT 'meter-' || l_orderkey || '-' || l_linenumber AS message_id, l_orderkey AS transaction_id,
       'Outlet' AS location, 3 AS samples, CAST(l_extendedprice AS DOUBLE) AS voltage
FROM lineitem""")
def variant_paths(t: Tables) -> DataFrame:
    """Values by path, among them a key that the declared schema does not have."""
    sample = "$.meter_value[0].sampled_value"
    rows = t.kind(METER, REQUEST).transform(variant.with_variant)
    found = rows.transform(
        variant.at_paths,
        {
            "transaction_id": ("$.transaction_id", "bigint"),
            "location": (f"{sample}[1].location", "string"),
            "voltage": (f"{sample}[1].value", "double"),
            "all": (sample, "array<variant>"),
        },
    )
    return found.select("message_id", "transaction_id", "location", F.size("all").alias("samples"), "voltage")


@query("""
SELECT 'StatusNotification' AS action,
       'OBJECT<connector_id: BIGINT, error_code: STRING, info: BIGINT, status: STRING, timestamp: STRING, vendor_error_code: VOID, vendor_id: VOID>' AS schema
FROM events HAVING count(*) > 0""")
def variant_schema(t: Tables) -> DataFrame:
    """The schema that all bodies of an action share, found rather than declared."""
    return t.kind(STATUS, REQUEST).transform(variant.with_variant).transform(variant.inferred_schema, "action")


@query("""
SELECT 'meter-' || l_orderkey || '-' || l_linenumber AS message_id, CAST(6 * count(*) AS INTEGER) AS entries, 'location' AS undeclared
FROM lineitem GROUP BY ALL""")
def variant_undeclared(t: Tables) -> DataFrame:
    """Keys of sampled values that no schema declares."""
    declared = METER_VALUES_WIDE["meter_value"].dataType.elementType["sampled_value"].dataType.elementType.names
    rows = t.kind(METER, REQUEST).transform(variant.with_variant)
    readings = rows.transform(variant.entries_at, "$.meter_value", ["message_id"])
    values = readings.transform(variant.entries_at, "$.sampled_value", ["message_id"], source="entry", target="value")
    found = values.transform(variant.undeclared, F.lit(declared), "value")
    return found.groupBy("message_id").agg(
        F.count(F.lit(1)).cast("int").alias("entries"), F.max(F.array_join("undeclared", ",")).alias("undeclared")
    )


# --- incremental jobs --------------------------------------------------------


@query(f"WITH {PARKING} SELECT * FROM parking")
def parking_incremental(t: Tables) -> DataFrame:
    """Samples come in two slices that interleave within sessions and hours, and one of them comes twice."""
    state, out = t.scratch("parking"), t.scratch("samples")
    power = reshape_meter_values(t.kind(METER, REQUEST).transform(unpack_json, SESSION_SAMPLES_WIDE))
    # The three slices are read from a table of samples, so each body is formed and parsed once.
    write_table(power, out, in_place=True)
    power = read_parquet(t.spark, out, power.schema)
    later = F.hour("timestamp") >= 3
    for number, part in enumerate((later, ~later, later)):
        parking.update_parking(power.filter(part), state, number, to="year")
    return parking.parking_so_far(t.spark, state)


@query(f"""
SELECT CAST(event_id AS VARCHAR) AS message_id, 2 AS message_type, CAST(user_id AS VARCHAR) AS charge_point_id,
       event_type AS action, props AS body, ts AS converted_timestamp {LATEST_SQL}""")
def last_seen_incremental(t: Tables) -> DataFrame:
    """The lake grows three times, once with late rows; each update opens the new files only."""
    out, number = t.scratch("last-seen"), F.col("message_id").cast("long")
    first = F.to_date("write_timestamp") < F.lit(CUT)
    parts = (first & (number % 2 == 0), ~first, first & (number % 2 == 1))
    for part in parts:
        append_lake_table(t.events.filter(part).transform(event_log_partition_columns), f"{out}/lake", to="day")
        last_seen.update_last_seen(t.spark, f"{out}/lake", f"{out}/state", schema=MESSAGE)
    return last_seen.last_seen_so_far(t.spark, f"{out}/state", schema=MESSAGE)


# --- layouts that spare work -------------------------------------------------


@query(SQL["cdr"])
def cdr_bucketed(t: Tables) -> DataFrame:
    """Sessions from tables bucketed by device and message, and by transaction."""
    out, tables = t.scratch("buckets"), silver.silver_tables(t.log(), wide_ids=True)
    sides = ("StartTransactionRequest", "StartTransactionResponse", "StopTransactionRequest")
    sessions = bucketed_sessions(*(tables[name] for name in sides), out, f"b{out.rsplit('-', 1)[-1]}", 8)
    power = t.kind(METER, REQUEST).transform(unpack_json, SESSION_SAMPLES_WIDE).transform(reshape_meter_values)
    return records_from_buckets(sessions, power.transform(total_parking_time))


@query(f"""
SELECT message_id, message_type, charge_point_id, action, body, ts AS write_timestamp
FROM ({EVENTS_SQL}, ts FROM events) WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00'""")
def zoned_slice(t: Tables) -> DataFrame:
    """A day out of a table without date directories, a tenth of whose rows came late."""
    out, late = t.scratch("zones"), F.col("message_id").cast("long") % 10 == 0
    rows = t.events.transform(with_event_time, target="write_timestamp")
    for part in (~late, late):
        append_zoned(rows.filter(part), out)
    fields = [StructField(field.name, rows.schema[field.name].dataType) for field in MESSAGE.fields]
    return read_zoned_slice(t.spark, out, datetime(2024, 1, 15, 9), StructType(fields), unit="day")
