"""Queries over the test tables, one per operator or job, each with its SQL counterpart.

Results hold zone-less timestamps, so that both engines return the same type.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from wattline import bindings
from wattline.operators import checks, order
from wattline.operators.idle import total_parking_time
from wattline.operators.latest import drop_helpers, latest_per_key
from wattline.operators.messages import (
    actions,
    cast_session_timestamps,
    cast_timestamps,
    flatten,
    flatten_samples,
    messages,
    power_samples,
    reshape_meter_values,
    select_status,
    unpack_json,
)
from wattline.operators.sessions import (
    attach_parking,
    close_session,
    drop_meters,
    match_start,
    total_energy,
    total_time,
)
from wattline.operators.status import status_counts
from wattline.operators.timeparts import (
    bronze_partition_columns,
    event_log_partition_columns,
    lake_partition_columns,
    parts_to,
    with_event_time,
)
from wattline.plans import bronze, gold, lake, last_seen, silver
from wattline.schemas import (
    MESSAGE,
    METER_SAMPLES,
    METER_VALUES,
    REQUEST,
    RESPONSE,
    SESSION_SAMPLES,
    START_REQUEST,
    START_RESPONSE,
    STATUS_NOTIFICATION,
    STATUS_REPORT,
    STOP_REQUEST,
    STREAM_MESSAGE,
    with_wide_ids,
)
from wattline.session import shared_folder, use_utc
from wattline.sinks.tables import append_lake_table, write_event_log, write_table
from wattline.sources import listing, streams
from wattline.sources.tables import read_last_minute, read_message_log, read_parquet, read_time_slice
from wattline.streaming.status import count_statuses, write_stream


class Tables:
    """The test tables, and the parts of the charging log that a query needs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        # Set by a caller that knows its tables to be small files, such as the benchmark.
        tasks = spark.conf.get("wattline.bindings.tasks", None)
        self.tasks = None if tasks is None else int(tasks)
        self._cache: dict = {}

    def _once(self, key, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = build()
        return self._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        return self._once(name, lambda: bindings.table(self.spark, self.folder, name))

    def log(self, *actions: str) -> DataFrame:
        """The raw log, of all actions unless some are named."""
        return self._once(
            actions,
            lambda: bindings.charging_log(
                self["orders"], self["lineitem"], self["events"], actions or bindings.ACTIONS, self.tasks
            ),
        )

    @property
    def events(self) -> DataFrame:
        return bindings.event_messages(self["events"])

    def kind(self, action: str, message_type: int) -> DataFrame:
        return self.log(action).transform(messages, action, message_type)

    def scratch(self, label: str) -> str:
        return shared_folder(self.spark, label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _zoneless(build(Tables(use_utc(spark), folder)))

        QUERIES[build.__name__] = run
        SQL[build.__name__] = sql
        return build

    return register


def _zoneless(df: DataFrame) -> DataFrame:
    zoned = [field.name for field in df.schema.fields if isinstance(field.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


START_RESPONSE_WIDE = with_wide_ids(START_RESPONSE)
STOP_REQUEST_WIDE = with_wide_ids(STOP_REQUEST)
METER_VALUES_WIDE = with_wide_ids(METER_VALUES)
# Jobs on samples declare what they use of a message.
METER_SAMPLES_WIDE, SESSION_SAMPLES_WIDE = with_wide_ids(METER_SAMPLES), with_wide_ids(SESSION_SAMPLES)
PROPS = StructType([StructField("k", IntegerType(), True)])
START, STOP, METER, STATUS = bindings.ACTIONS
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
IDLE_BELOW = 5

# --- the charging log in SQL -------------------------------------------------

ISO = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"

FACTS = """
facts AS (
  SELECT o.*, first_ship, last_ship, low, high
  FROM orders o LEFT JOIN (
    SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
           CAST(floor(min(l_extendedprice)) AS INTEGER) AS low,
           CAST(floor(max(l_extendedprice)) AS INTEGER) AS high
    FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
)"""

STARTS = FACTS + """,
starts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS charge_point_id, o_orderkey AS transaction_id,
         coalesce(low, 0) AS meter_start,
         least(o_orderdate, coalesce(first_ship, o_orderdate)) AS start_timestamp
  FROM facts
)"""

SESSIONS = STARTS + """,
sessions AS (
  SELECT s.charge_point_id, s.transaction_id, s.meter_start, f.high AS meter_stop,
         s.start_timestamp, f.last_ship + INTERVAL 12 HOUR AS stop_timestamp
  FROM starts s JOIN facts f ON s.transaction_id = f.o_orderkey WHERE f.last_ship IS NOT NULL
)"""

SAMPLES = """
readings AS (
  SELECT *, l_shipdate AS moment FROM lineitem
  UNION ALL SELECT *, l_shipdate + INTERVAL 6 HOUR AS moment FROM lineitem
),
samples AS (
  SELECT 'meter-' || l_orderkey || '-' || l_linenumber AS message_id, 2 AS message_type,
         CAST(l_suppkey AS VARCHAR) AS charge_point_id, 'MeterValues' AS action,
         strftime(l_shipdate + INTERVAL 6 HOUR, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS write_timestamp,
         l_orderkey AS transaction_id, l_linenumber AS connector_id, moment AS timestamp,
         s.measurand, s.phase, s.value
  FROM readings, LATERAL (VALUES
    ('Power.Active.Import', NULL, CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity END),
    ('Voltage', 'L1-N', l_extendedprice),
    ('Power.Active.Import', 'L1', l_tax)) AS s(measurand, phase, value)
)"""


def hours_sql(micros: str) -> str:
    return f"CAST(round(CAST(({micros}) / 3600000000.0 AS DECIMAL(38, 9)), 2) AS DOUBLE)"


def runs_sql(source: str, key: str, at: str, value: str, idle: str, target: str) -> str:
    """Gaps and islands: a run number from the changes of the idle flag, then each run's ends."""
    return f"""
flags AS (
  SELECT {key} AS k, {at} AS moment, {value} AS v, ({idle}) AS idle FROM {source}
),
changes AS (
  SELECT *, CASE WHEN idle IS DISTINCT FROM lag(idle) OVER (PARTITION BY k ORDER BY moment, v)
            THEN 1 ELSE 0 END AS change
  FROM flags
),
numbered AS (
  SELECT *, sum(change) OVER (PARTITION BY k ORDER BY moment, v ROWS UNBOUNDED PRECEDING) AS run FROM changes
),
runs AS (
  SELECT k, date_diff('microsecond', min(moment), max(moment)) AS micros FROM numbered WHERE idle GROUP BY k, run
),
parking AS (
  SELECT k AS {key}, {hours_sql("sum(micros)")} AS {target} FROM runs GROUP BY k
)"""


POWER = "power AS (SELECT * FROM samples WHERE measurand = 'Power.Active.Import' AND phase IS NULL)"
PARKING = (
    SAMPLES
    + ",\n"
    + POWER
    + ","
    + runs_sql("power", "transaction_id", "timestamp", "value", "value = 0", "total_parking_time")
)
TOTAL_TIME = hours_sql("date_diff('microsecond', start_timestamp, stop_timestamp)") + " AS total_time"
KWH = "CAST(round(CAST((meter_stop - meter_start) / 1000.0 AS DECIMAL(38, 9)), 2) AS DOUBLE) AS total_energy"
WH = "CAST(meter_stop - meter_start AS DOUBLE) AS total_energy"

EVENTS_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS message_id, 2 AS message_type,
       CAST(user_id AS VARCHAR) AS charge_point_id, event_type AS action,
       strftime(ts, {ISO}) AS write_timestamp, props AS body"""

# --- filters and aggregates --------------------------------------------------


@query(EVENTS_SQL + " FROM events WHERE event_type = 'click'")
def filter_action(t: Tables) -> DataFrame:
    return t.events.transform(actions, "click")


def _envelope(df: DataFrame) -> DataFrame:
    return df.drop("body")


@query(f"""
WITH {FACTS}
SELECT 'start-' || o_orderkey AS message_id, 2 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StartTransaction' AS action,
       strftime(least(o_orderdate, coalesce(first_ship, o_orderdate)), {ISO}) AS write_timestamp
FROM facts""")
def filter_start_request(t: Tables) -> DataFrame:
    return t.kind(START, REQUEST).transform(_envelope)


@query(f"""
SELECT 'start-' || o_orderkey AS message_id, 3 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StartTransaction' AS action, strftime(o_orderdate, {ISO}) AS write_timestamp
FROM orders""")
def filter_start_response(t: Tables) -> DataFrame:
    return t.kind(START, RESPONSE).transform(_envelope)


@query(f"""
WITH {FACTS}
SELECT 'stop-' || o_orderkey AS message_id, 2 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StopTransaction' AS action, strftime(last_ship + INTERVAL 12 HOUR, {ISO}) AS write_timestamp
FROM facts WHERE last_ship IS NOT NULL""")
def filter_stop_request(t: Tables) -> DataFrame:
    return t.kind(STOP, REQUEST).transform(_envelope)


@query(f"""
SELECT 'meter-' || l_orderkey || '-' || l_linenumber AS message_id, 2 AS message_type,
       CAST(l_suppkey AS VARCHAR) AS charge_point_id, 'MeterValues' AS action,
       strftime(l_shipdate + INTERVAL 6 HOUR, {ISO}) AS write_timestamp
FROM lineitem""")
def filter_meter_request(t: Tables) -> DataFrame:
    return t.kind(METER, REQUEST).transform(_envelope)


@query("""
SELECT 'StartTransaction' AS action, 2 AS message_type, count(*) AS messages FROM orders HAVING count(*) > 0
UNION ALL SELECT 'StartTransaction', 3, count(*) FROM orders HAVING count(*) > 0
UNION ALL SELECT 'StopTransaction', 2, count(*) FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) HAVING count(*) > 0
UNION ALL SELECT 'MeterValues', 2, count(*) FROM lineitem HAVING count(*) > 0
UNION ALL SELECT 'StatusNotification', 2, count(*) FROM events HAVING count(*) > 0""")
def count_kinds(t: Tables) -> DataFrame:
    return t.log().groupBy("action", "message_type").agg(F.count(F.lit(1)).alias("messages"))


@query("SELECT DISTINCT event_type AS action FROM events")
def distinct_actions(t: Tables) -> DataFrame:
    return t.events.select("action").distinct()


# --- unpacking ---------------------------------------------------------------


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def unpack_body(t: Tables) -> DataFrame:
    return (
        t["events"].select("event_id", "props").transform(unpack_json, PROPS, "props").select("event_id", "new_body.*")
    )


@query(f"""
WITH {FACTS}
SELECT 'start-' || o_orderkey AS message_id, 1 AS connector_id, 'tag-' || o_custkey AS id_tag,
       coalesce(low, 0) AS meter_start,
       strftime(least(o_orderdate, coalesce(first_ship, o_orderdate)), {ISO}) AS timestamp,
       CAST(NULL AS INTEGER) AS reservation_id
FROM facts""")
def unpack_start_request(t: Tables) -> DataFrame:
    return t.kind(START, REQUEST).transform(unpack_json, START_REQUEST).select("message_id", "new_body.*")


@query("""
SELECT 'start-' || o_orderkey AS message_id, o_orderkey AS transaction_id, o_orderstatus AS status,
       o_orderpriority AS parent_id_tag, CAST(NULL AS VARCHAR) AS expiry_date
FROM orders""")
def unpack_start_response(t: Tables) -> DataFrame:
    return (
        t.kind(START, RESPONSE)
        .transform(unpack_json, START_RESPONSE_WIDE)
        .select("message_id", "new_body.transaction_id", "new_body.id_tag_info.*")
    )


@query(f"""
WITH {FACTS}
SELECT o_orderkey AS transaction_id, high AS meter_stop,
       strftime(last_ship + INTERVAL 12 HOUR, {ISO}) AS timestamp, CAST(NULL AS VARCHAR) AS reason,
       'tag-' || o_custkey AS id_tag, o_orderstatus || ',' || o_orderpriority AS transaction_data
FROM facts WHERE last_ship IS NOT NULL""")
def unpack_stop_request(t: Tables) -> DataFrame:
    return (
        t.kind(STOP, REQUEST)
        .transform(unpack_json, STOP_REQUEST_WIDE)
        .select("new_body.*")
        .withColumn("transaction_data", F.array_join("transaction_data", ","))
    )


@query("""
SELECT 'meter-' || l_orderkey || '-' || l_linenumber AS message_id, l_linenumber AS connector_id,
       l_orderkey AS transaction_id, 2 AS readings, 6 AS samples, false AS has_location
FROM lineitem""")
def unpack_meter_values(t: Tables) -> DataFrame:
    readings = F.col("new_body.meter_value")
    return (
        t.kind(METER, REQUEST)
        .transform(unpack_json, METER_VALUES_WIDE)
        .select(
            "message_id",
            "new_body.connector_id",
            "new_body.transaction_id",
            F.size(readings).alias("readings"),
            F.size(F.flatten(readings["sampled_value"])).alias("samples"),
            F.contains(F.to_json("new_body"), F.lit("location")).alias("has_location"),
        )
    )


@query("""
SELECT CAST(user_id AS VARCHAR) AS charge_point_id, 1 AS connector_id, 'NoError' AS error_code,
       event_type AS status, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+0000') AS timestamp,
       CAST(json_extract(props, '$.k') AS INTEGER) AS info, CAST(NULL AS INTEGER) AS vendor_id,
       CAST(NULL AS INTEGER) AS vendor_error_code
FROM events""")
def unpack_status(t: Tables) -> DataFrame:
    return (
        t.kind(STATUS, REQUEST)
        .transform(unpack_json, STATUS_NOTIFICATION)
        .select("charge_point_id", "new_body.*")
    )


@query("SELECT CAST(user_id AS VARCHAR) AS charge_point_id, event_type AS status, ts AS timestamp FROM events")
def select_statuses(t: Tables) -> DataFrame:
    return (
        t.kind(STATUS, REQUEST).transform(unpack_json, STATUS_NOTIFICATION).transform(select_status)
    )


# --- flattening, casting, exploding ------------------------------------------


@query(f"""
WITH {FACTS}
SELECT 'start-' || o_orderkey AS message_id, 2 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StartTransaction' AS action,
       strftime(least(o_orderdate, coalesce(first_ship, o_orderdate)), {ISO}) AS write_timestamp,
       1 AS connector_id, 'tag-' || o_custkey AS id_tag, coalesce(low, 0) AS meter_start,
       strftime(least(o_orderdate, coalesce(first_ship, o_orderdate)), {ISO}) AS timestamp,
       CAST(NULL AS INTEGER) AS reservation_id
FROM facts""")
def flatten_start_request(t: Tables) -> DataFrame:
    return t.kind(START, REQUEST).transform(unpack_json, START_REQUEST).transform(flatten)


@query(f"""
SELECT 'start-' || o_orderkey AS message_id, 3 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StartTransaction' AS action, strftime(o_orderdate, {ISO}) AS write_timestamp,
       o_orderkey AS transaction_id, o_orderstatus AS id_tag_info_status,
       o_orderpriority AS id_tag_info_parent_id_tag, CAST(NULL AS VARCHAR) AS id_tag_info_expiry_date
FROM orders""")
def flatten_start_response(t: Tables) -> DataFrame:
    return silver.start_transaction_responses(t.log(START), wide_ids=True)


@query(f"""
WITH {FACTS}
SELECT 'stop-' || o_orderkey AS message_id, 2 AS message_type, CAST(o_custkey AS VARCHAR) AS charge_point_id,
       'StopTransaction' AS action, strftime(last_ship + INTERVAL 12 HOUR, {ISO}) AS write_timestamp,
       high AS meter_stop, strftime(last_ship + INTERVAL 12 HOUR, {ISO}) AS timestamp,
       o_orderkey AS transaction_id, CAST(NULL AS VARCHAR) AS reason, 'tag-' || o_custkey AS id_tag,
       o_orderstatus || ',' || o_orderpriority AS transaction_data
FROM facts WHERE last_ship IS NOT NULL""")
def flatten_stop_request(t: Tables) -> DataFrame:
    return (
        t.kind(STOP, REQUEST)
        .transform(unpack_json, STOP_REQUEST_WIDE)
        .transform(flatten)
        .withColumn("transaction_data", F.array_join("transaction_data", ","))
    )


@query(f"""
WITH {FACTS}
SELECT 'start-' || o_orderkey AS message_id, 1 AS connector_id, 'tag-' || o_custkey AS id_tag,
       coalesce(low, 0) AS meter_start, least(o_orderdate, coalesce(first_ship, o_orderdate)) AS timestamp
FROM facts""")
def cast_start_request(t: Tables) -> DataFrame:
    return silver.start_transaction_requests(t.log(START)).select(
        "message_id", "connector_id", "id_tag", "meter_start", "timestamp"
    )


@query(f"""
WITH {FACTS}
SELECT 'stop-' || o_orderkey AS message_id, high AS meter_stop, last_ship + INTERVAL 12 HOUR AS timestamp,
       o_orderkey AS transaction_id, o_orderstatus || ',' || o_orderpriority AS transaction_data
FROM facts WHERE last_ship IS NOT NULL""")
def cast_stop_request(t: Tables) -> DataFrame:
    return silver.stop_transaction_requests(t.log(STOP), wide_ids=True).select(
        "message_id",
        "meter_stop",
        "timestamp",
        "transaction_id",
        F.array_join("transaction_data", ",").alias("transaction_data"),
    )


@query(f"WITH {SESSIONS} SELECT * FROM sessions")
def cast_sessions(t: Tables) -> DataFrame:
    return _text_sessions(t).transform(cast_session_timestamps)


@query(f"SELECT event_id, strftime(ts, {ISO}) AS write_timestamp, ts AS converted_timestamp FROM events")
def event_times(t: Tables) -> DataFrame:
    return t.events.transform(with_event_time).select(
        F.col("message_id").cast("long").alias("event_id"), "write_timestamp", "converted_timestamp"
    )


@query(f"WITH {SAMPLES} SELECT * FROM samples")
def explode_samples(t: Tables) -> DataFrame:
    return t.kind(METER, REQUEST).transform(unpack_json, METER_SAMPLES_WIDE).transform(flatten_samples)


@query(f"""
WITH {SAMPLES}
SELECT * FROM samples WHERE measurand = 'Power.Active.Import' AND phase IS NULL""")
def filter_power_samples(t: Tables) -> DataFrame:
    return silver.meter_values_requests(t.log(METER), wide_ids=True).transform(power_samples)


@query(f"""
WITH {SAMPLES}
SELECT transaction_id, timestamp, measurand, phase, value
FROM samples WHERE measurand = 'Power.Active.Import' AND phase IS NULL""")
def reshape_meters(t: Tables) -> DataFrame:
    return _power(t)


# --- date parts and slices ---------------------------------------------------

PARTS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS message_id, {time} AS write_timestamp, CAST(year(ts) AS INTEGER) AS year,
       CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day{finer}
FROM events"""


@query(PARTS_SQL.format(time="ts", finer=", CAST(hour(ts) AS INTEGER) AS hour"))
def partition_columns_hour(t: Tables) -> DataFrame:
    return (
        t.events.select("message_id", "write_timestamp").transform(bronze_partition_columns)
    )


@query(
    PARTS_SQL.format(
        time=f"strftime(ts, {ISO})",
        finer=", CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute",
    )
)
def partition_columns_minute(t: Tables) -> DataFrame:
    return t.events.select("message_id", "write_timestamp").transform(lake_partition_columns)


@query(PARTS_SQL.format(time=f"strftime(ts, {ISO})", finer=""))
def partition_columns_day(t: Tables) -> DataFrame:
    return t.events.select("message_id", "write_timestamp").transform(event_log_partition_columns)


@query(EVENTS_SQL + " FROM events WHERE date_trunc('minute', ts) = TIMESTAMP '2024-01-01 00:08:00'")
def time_slice(t: Tables) -> DataFrame:
    return t.events.transform(read_time_slice, datetime(2024, 1, 1, 0, 8, 30))


@query("SELECT * FROM events WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00'")
def time_slice_day(t: Tables) -> DataFrame:
    return t["events"].transform(read_time_slice, datetime(2024, 1, 15, 12), "ts", "day")


# --- sessions ----------------------------------------------------------------


def _nested(t: Tables, action: str, message_type: int, schema: StructType) -> DataFrame:
    return t.kind(action, message_type).transform(unpack_json, schema)


def _text_starts(t: Tables) -> DataFrame:
    return _nested(t, START, RESPONSE, START_RESPONSE_WIDE).transform(
        match_start, _nested(t, START, REQUEST, START_REQUEST)
    )


def _text_sessions(t: Tables) -> DataFrame:
    return _nested(t, STOP, REQUEST, STOP_REQUEST_WIDE).transform(close_session, _text_starts(t))


def _starts(t: Tables) -> DataFrame:
    return silver.start_transaction_responses(t.log(START), wide_ids=True).transform(
        match_start, silver.start_transaction_requests(t.log(START))
    )


def _sessions(t: Tables) -> DataFrame:
    return silver.stop_transaction_requests(t.log(STOP), wide_ids=True).transform(close_session, _starts(t))


def _power(t: Tables) -> DataFrame:
    return (
        t.kind(METER, REQUEST).transform(unpack_json, SESSION_SAMPLES_WIDE).transform(reshape_meter_values)
    )


@query(f"WITH {STARTS} SELECT * FROM starts")
def match_starts(t: Tables) -> DataFrame:
    return _starts(t)


@query(f"""
WITH {STARTS}
SELECT charge_point_id, transaction_id, meter_start, strftime(start_timestamp, {ISO}) AS start_timestamp
FROM starts""")
def match_starts_nested(t: Tables) -> DataFrame:
    return _text_starts(t)


@query(f"WITH {SESSIONS} SELECT * FROM sessions")
def close_sessions(t: Tables) -> DataFrame:
    return _sessions(t)


@query(f"""
WITH {SESSIONS}
SELECT charge_point_id, transaction_id, meter_start, meter_stop,
       strftime(start_timestamp, {ISO}) AS start_timestamp, strftime(stop_timestamp, {ISO}) AS stop_timestamp
FROM sessions""")
def close_sessions_nested(t: Tables) -> DataFrame:
    return _text_sessions(t)


@query(f"WITH {SESSIONS} SELECT *, {TOTAL_TIME} FROM sessions")
def session_hours(t: Tables) -> DataFrame:
    return _sessions(t).transform(total_time)


@query(f"""
WITH spans AS (
  SELECT user_id, min(ts) AS start_timestamp, max(ts) AS stop_timestamp FROM events GROUP BY user_id)
SELECT *, {TOTAL_TIME} FROM spans""")
def activity_hours(t: Tables) -> DataFrame:
    """Durations with fractions of a second, on the zone-less times of the table itself."""
    spans = t["events"].groupBy("user_id").agg(
        F.min("ts").alias("start_timestamp"), F.max("ts").alias("stop_timestamp")
    )
    return spans.transform(total_time)


@query(f"WITH {SESSIONS} SELECT *, {KWH} FROM sessions")
def energy_kwh(t: Tables) -> DataFrame:
    return _sessions(t).transform(total_energy)


@query(f"WITH {SESSIONS} SELECT *, {WH} FROM sessions")
def energy_wh(t: Tables) -> DataFrame:
    return _sessions(t).transform(total_energy, unit="Wh")


@query(f"WITH {PARKING} SELECT * FROM parking")
def parking_time(t: Tables) -> DataFrame:
    return _power(t).transform(total_parking_time)


@query("WITH" + runs_sql("events", "user_id", "ts", "value", f"value < {IDLE_BELOW}", "idle_hours") + " SELECT * FROM parking")
def idle_time(t: Tables) -> DataFrame:
    return t["events"].transform(
        total_parking_time, "user_id", "ts", idle=F.col("value") < IDLE_BELOW, target="idle_hours"
    )


@query(f"""
SELECT user_id, {hours_sql("date_diff('microsecond', min(ts), max(ts))")} AS idle_hours
FROM events WHERE value < {IDLE_BELOW} GROUP BY user_id""")
def idle_span(t: Tables) -> DataFrame:
    return t["events"].transform(
        total_parking_time, "user_id", "ts", idle=F.col("value") < IDLE_BELOW, mode="span", target="idle_hours"
    )


@query(f"WITH {SESSIONS}, {PARKING} SELECT * FROM sessions LEFT JOIN parking USING (transaction_id)")
def attach_parking_time(t: Tables) -> DataFrame:
    return _sessions(t).transform(attach_parking, _power(t).transform(total_parking_time))


@query(f"""
WITH {SESSIONS}
SELECT charge_point_id, transaction_id, start_timestamp, stop_timestamp, {TOTAL_TIME}, {WH} FROM sessions""")
def cleanup_columns(t: Tables) -> DataFrame:
    return _sessions(t).transform(total_time).transform(total_energy, unit="Wh").transform(drop_meters)


@query(f"""
WITH {SESSIONS}, {PARKING}
SELECT sessions.*, {TOTAL_TIME}, {KWH}, total_parking_time
FROM sessions LEFT JOIN parking USING (transaction_id)""")
def cdr(t: Tables) -> DataFrame:
    return gold.charge_detail_records_from_silver(silver.silver_tables(t.log(), wide_ids=True))


@query(f"""
WITH {SESSIONS}, {PARKING}
SELECT charge_point_id, transaction_id, start_timestamp, stop_timestamp, {TOTAL_TIME}, {WH}, total_parking_time
FROM sessions LEFT JOIN parking USING (transaction_id)""")
def cdr_from_log(t: Tables) -> DataFrame:
    return gold.charge_detail_records_from_log(t.log(), wide_ids=True)


# --- last seen, status counts, order -----------------------------------------

LATEST_SQL = "FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query(f"SELECT *, CAST(1 AS INTEGER) AS rn {LATEST_SQL}")
def latest_event(t: Tables) -> DataFrame:
    return t["events"].transform(latest_per_key, "user_id", "ts", ("event_id",))


@query(f"SELECT event_id, user_id, event_type, value, props {LATEST_SQL}")
def latest_event_cleaned(t: Tables) -> DataFrame:
    return latest_event(t).transform(drop_helpers, "rn", "ts", "not_there")


@query(f"""
SELECT CAST(event_id AS VARCHAR) AS message_id, 2 AS message_type, CAST(user_id AS VARCHAR) AS charge_point_id,
       event_type AS action, props AS body, ts AS converted_timestamp {LATEST_SQL}""")
def last_seen_report(t: Tables) -> DataFrame:
    return t.events.transform(last_seen.last_seen_report)


COUNTS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS charge_point_id, event_type AS status,
       time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end, count(*) AS "count(status)"
FROM events GROUP BY ALL"""


def _flat_window(df: DataFrame) -> DataFrame:
    return df.select(
        "charge_point_id",
        "status",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "count(status)",
    )


@query(COUNTS_SQL)
def status_counts_5m(t: Tables) -> DataFrame:
    reports = t["events"].select(
        F.col("user_id").cast("string").alias("charge_point_id"),
        F.col("event_type").alias("status"),
        F.col("ts").alias("timestamp"),
    )
    return reports.transform(status_counts).transform(_flat_window)


@query(f"""
SELECT * FROM ({COUNTS_SQL})
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def status_counts_stream(t: Tables) -> DataFrame:
    out = t.scratch("status-counts")
    # A glob, because a stream opens directories only and the table may be a single file.
    arriving = streams.read_message_stream(t.spark, f"{t.folder}/[e]vents.parquet", schema=t["events"].schema)
    counts = count_statuses(bindings.status_notifications(arriving))
    write_stream(counts, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    return read_parquet(t.spark, f"{out}/counts", counts.schema).transform(_flat_window)


@query(f"""
SELECT * FROM ({COUNTS_SQL.replace("FROM events", "FROM (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')")})
WHERE window_end <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def status_counts_late(t: Tables) -> DataFrame:
    """The first days arrive after the others were worked off: their reports come behind the watermark."""
    out = t.scratch("status-late")
    events, cut = t["events"], F.lit("2024-01-10").cast("timestamp_ntz")
    for part in (F.col("ts") >= cut, F.col("ts") < cut):
        bindings.status_notifications(events.filter(part)).write.mode("append").parquet(f"{out}/in")
        counts = count_statuses(streams.read_message_stream(t.spark, f"{out}/in", schema=MESSAGE))
        write_stream(counts, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    return read_parquet(t.spark, f"{out}/counts", counts.schema).transform(_flat_window)


@query(f"WITH {SESSIONS} SELECT * FROM sessions ORDER BY transaction_id LIMIT 3")
def top_k_sessions(t: Tables) -> DataFrame:
    return _sessions(t).transform(order.top_k, 3, "transaction_id")


@query("""
SELECT 'start-' || o_orderkey AS message_id, o_orderkey AS transaction_id FROM orders
ORDER BY o_orderkey LIMIT 3""")
def top_k_nested(t: Tables) -> DataFrame:
    answers = _nested(t, START, RESPONSE, START_RESPONSE_WIDE)
    return answers.transform(order.top_k, 3, "new_body.transaction_id").select(
        "message_id", "new_body.transaction_id"
    )


@query(EVENTS_SQL + " FROM events ORDER BY ts, event_id LIMIT 3")
def top_k_derived(t: Tables) -> DataFrame:
    return t.events.transform(order.top_k_by_key, 3, F.try_to_timestamp("write_timestamp"), "message_id")


@query(f"WITH {SESSIONS} SELECT transaction_id, {TOTAL_TIME} FROM sessions ORDER BY transaction_id")
def sorted_hours(t: Tables) -> DataFrame:
    return session_hours(t).select("transaction_id", "total_time").orderBy("transaction_id")


# --- data contracts ----------------------------------------------------------


@query("""
SELECT 'row_count' AS "check", count(*) AS observed, count(*) >= 1 AS passed FROM events
UNION ALL
SELECT 'domain(action)', count(*) FILTER (event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')),
       count(DISTINCT event_type) = 5
       AND count(*) FILTER (event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')) = 0 FROM events
UNION ALL
SELECT 'domain(message_type)', count(*), false FROM events
UNION ALL
SELECT 'nulls(converted_timestamp)', count(*) FILTER (ts IS NULL), count(*) FILTER (ts IS NULL) = 0 FROM events
UNION ALL
SELECT 'malformed(body)', count(*) FILTER (json_extract(props, '$.k') IS NULL),
       count(*) FILTER (json_extract(props, '$.k') IS NULL) = 0 FROM events""")
def check_events(t: Tables) -> DataFrame:
    """One pass for all checks; the response check fails, as events are requests only."""
    return (
        t.events.transform(with_event_time)
        .transform(unpack_json, PROPS)
        .transform(
            checks.audit,
            checks.row_count(minimum=1),
            checks.domain("action", EVENT_TYPES),
            checks.domain("message_type", [RESPONSE]),
            checks.nulls("converted_timestamp"),
            checks.malformed(PROPS),
        )
    )


@query("""
SELECT 'nulls(converted_timestamp)' AS "check", count(*) FILTER (event_id % 5 > 1) AS observed,
       count(*) FILTER (event_id % 5 > 1) = 0 AS passed
FROM events""")
def check_times(t: Tables) -> DataFrame:
    """Times cut to the clock, the year or the month are no event times, whatever the day of the run."""
    time, number = F.col("write_timestamp"), F.col("message_id").cast("long") % 5
    damaged = (
        F.when(number == 1, F.translate(F.substring(time, 1, 19), "T", " "))
        .when(number == 2, F.substring(time, 12, 8))
        .when(number == 3, F.substring(time, 1, 4))
        .when(number == 4, F.substring(time, 1, 7))
        .otherwise(time)
    )
    events = t.events.withColumn("write_timestamp", damaged).transform(with_event_time)
    return events.transform(checks.audit, checks.nulls("converted_timestamp"))


@query("""
SELECT 'nulls(timestamp)' AS "check", count(*) FILTER (event_id % 3 = 0) AS observed,
       count(*) FILTER (event_id % 3 = 0) = 0 AS passed
FROM events""")
def check_reports(t: Tables) -> DataFrame:
    """Status reports that no window counts, because their time can't be read."""
    body = F.when(F.col("user_event") % 3 == 0, F.regexp_replace("body", "T[0-9:.]*", "")).otherwise(F.col("body"))
    reports = bindings.status_notifications(t["events"]).withColumn(
        "user_event", F.regexp_extract("message_id", "[0-9]+", 0).cast("long")
    )
    read = reports.withColumn("body", body).transform(unpack_json, STATUS_REPORT).transform(select_status)
    return read.transform(checks.audit, checks.nulls("timestamp"))


@query(f"""
WITH {SESSIONS}, {PARKING},
records AS (SELECT * FROM sessions LEFT JOIN parking USING (transaction_id))
SELECT 'row_count' AS "check", count(*) AS observed, true AS passed FROM records
UNION ALL
SELECT 'nulls(total_parking_time)', count(*) FILTER (total_parking_time IS NULL),
       count(*) FILTER (total_parking_time IS NULL) = 0 FROM records""")
def check_records(t: Tables) -> DataFrame:
    return cdr_from_log(t).transform(checks.audit, checks.row_count(minimum=0), checks.nulls("total_parking_time"))


@query(f"""
WITH {SESSIONS},
head AS (SELECT transaction_id, charge_point_id FROM sessions ORDER BY transaction_id LIMIT 3),
golden AS (
  SELECT o_orderkey AS transaction_id, CAST(o_custkey AS VARCHAR) AS charge_point_id FROM orders
  WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 3)
SELECT *, 'missing' AS side FROM (SELECT * FROM golden EXCEPT ALL SELECT * FROM head)
UNION ALL
SELECT *, 'unexpected' AS side FROM (SELECT * FROM head EXCEPT ALL SELECT * FROM golden)""")
def check_sample(t: Tables) -> DataFrame:
    golden = (
        t["orders"]
        .filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").cast("string").alias("charge_point_id"))
        .transform(order.top_k, 3, "transaction_id")
    )
    return _sessions(t).transform(checks.sample_differences, golden, 3, "transaction_id")


# --- written tables ----------------------------------------------------------

HOURS_SQL = """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(hour(ts) AS INTEGER) AS hour, {rest}
FROM events GROUP BY ALL"""


@query(HOURS_SQL.format(rest="count(*) AS messages, count(DISTINCT event_type) AS actions"))
def bronze_log(t: Tables) -> DataFrame:
    fields = [StructField(f.name, TimestampType() if f.name == "write_timestamp" else f.dataType) for f in MESSAGE]
    schema = StructType(fields + [StructField(part, IntegerType()) for part in parts_to("hour")])
    out = t.scratch("bronze")
    bronze.write_bronze(t.events, out)
    return (
        read_message_log(t.spark, out, schema=schema)
        .groupBy(*parts_to("hour"))
        .agg(F.count("message_id").alias("messages"), F.count_distinct("action").alias("actions"))
    )


@query("""
SELECT 'StartTransactionRequest' AS name, count(*) AS messages, count(*) AS rows FROM orders
UNION ALL SELECT 'StartTransactionResponse', count(*), count(*) FROM orders
UNION ALL SELECT 'StopTransactionRequest', count(*), count(*) FROM orders
  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'MeterValuesRequest', count(DISTINCT (l_orderkey, l_linenumber)), 6 * count(*) FROM lineitem""")
def silver_log(t: Tables) -> DataFrame:
    out = t.scratch("silver")
    silver.write_silver(t.log(), out, wide_ids=True)
    counts = [
        read_parquet(t.spark, f"{out}/{name}", table.schema).agg(
            F.lit(name).alias("name"),
            F.count_distinct("message_id").alias("messages"),
            F.count(F.lit(1)).alias("rows"),
        )
        for name, table in silver.silver_tables(t.log(), wide_ids=True).items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query(SQL["cdr"])
def gold_log(t: Tables) -> DataFrame:
    """The job in the large: silver tables written, read back, joined, written, read back."""
    out = t.scratch("gold")
    tables = silver.silver_tables(t.log(), wide_ids=True)
    silver.write_silver(t.log(), out, wide_ids=True)
    written = {name: read_parquet(t.spark, f"{out}/{name}", table.schema) for name, table in tables.items()}
    records = gold.charge_detail_records_from_silver(written)
    gold.write_gold(records, out)
    return read_parquet(t.spark, f"{out}/cdr", records.schema)


@query(EVENTS_SQL + " FROM events")
def table_round_trip(t: Tables) -> DataFrame:
    out = t.scratch("events")
    write_table(t.events, out)
    return read_message_log(t.spark, out)


LAKE_SQL = EVENTS_SQL + """,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
FROM events"""


def _lake(t: Tables) -> str:
    out = t.scratch("lake")
    append_lake_table(t.events.transform(event_log_partition_columns), out, to="day")
    return out


@query(LAKE_SQL + " WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00'")
def lake_slice(t: Tables) -> DataFrame:
    return read_last_minute(
        t.spark, _lake(t), datetime(2024, 1, 16, 9), to="day", unit="day", schema=MESSAGE
    )


@query("""
SELECT DISTINCT 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts) AS leaf, true AS written
FROM events""")
def lake_layout(t: Tables) -> DataFrame:
    report = listing.layout_report(t.spark, _lake(t))
    return report.select("leaf", ((F.col("files") >= 1) & (F.col("bytes") > 0)).alias("written"))


@query("SELECT DISTINCT 'month=' || month(ts) || '/' AS name FROM events WHERE year(ts) = 2024")
def lake_months(t: Tables) -> DataFrame:
    return listing.list_children(t.spark, f"{_lake(t)}/year=2024").select("name")


@query("""
SELECT 'row_count' AS "check", count(DISTINCT month(ts)) AS observed, count(DISTINCT month(ts)) = 1 AS passed
FROM events WHERE year(ts) = 2024
UNION ALL
SELECT 'domain(name)', count(DISTINCT month(ts)) FILTER (month(ts) <> 1),
       count(DISTINCT month(ts)) FILTER (month(ts) <> 1) = 0 AND bool_or(month(ts) = 1)
FROM events WHERE year(ts) = 2024""")
def check_layout(t: Tables) -> DataFrame:
    months = listing.list_children(t.spark, f"{_lake(t)}/year=2024")
    return months.transform(checks.audit, checks.row_count(exact=1), checks.domain("name", ["month=1/"]))


@query(HOURS_SQL.format(rest="count(*) AS messages, 1::BIGINT AS files"))
def bronze_layout(t: Tables) -> DataFrame:
    """Exactly one file in the directory of every hour."""
    out = t.scratch("bronze")
    bronze.write_bronze(t.events, out, one_file=True)
    parts = parts_to("hour")
    schema = StructType([StructField("message_id", StringType()), *(StructField(p, IntegerType()) for p in parts)])
    rows = t.spark.read.schema(schema).parquet(out).groupBy(*parts).agg(F.count("message_id").alias("messages"))
    leaf = F.concat_ws("/", *[F.concat(F.lit(f"{part}="), part) for part in parts]).alias("leaf")
    files = listing.layout_report(t.spark, out).select("leaf", "files")
    return rows.withColumn("leaf", leaf).join(files, "leaf").drop("leaf")


@query("""
SELECT name, "check", 1::BIGINT AS observed, true AS passed
FROM (VALUES ('StartTransactionRequest'), ('StartTransactionResponse'), ('StopTransactionRequest'),
             ('MeterValuesRequest'), ('cdr')) names(name), (VALUES ('data_files'), ('committed')) checks("check")""")
def table_layout(t: Tables) -> DataFrame:
    """One file and the marker of a finished job in each silver table and in the gold table."""
    out = t.scratch("tables")
    silver.write_silver(t.log(), out, wide_ids=True, files=1)
    tables = silver.silver_tables(t.log(), wide_ids=True)
    written = {name: read_parquet(t.spark, f"{out}/{name}", table.schema) for name, table in tables.items()}
    gold.write_gold(gold.charge_detail_records_from_silver(written), out, files=1)
    found = [
        listing.list_output(t.spark, f"{out}/{name}")
        .transform(checks.audit, checks.data_files(exact=1), checks.committed())
        .withColumn("name", F.lit(name))
        for name in (*tables, "cdr")
    ]
    return reduce(DataFrame.unionByName, found)


EVENT_LOG_SQL = """
SELECT event_type AS action, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, count(*) AS messages
FROM events {where} GROUP BY ALL"""


def _log_counts(t: Tables, path: str) -> DataFrame:
    parts = ["action", "year", "month", "day"]
    schema = "message_id string, action string, year int, month int, day int"
    return t.spark.read.schema(schema).parquet(path).groupBy(*parts).agg(F.count("message_id").alias("messages"))


@query(EVENT_LOG_SQL.format(where=""))
def event_log(t: Tables) -> DataFrame:
    out = t.scratch("event-log")
    write_event_log(t.events.transform(event_log_partition_columns), out, key="action")
    return _log_counts(t, out)


@query(EVENT_LOG_SQL.format(where="WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00'"))
def event_log_slice(t: Tables) -> DataFrame:
    out = t.scratch("event-log")
    lake.run_minute(
        t.spark, _lake(t), out, datetime(2024, 1, 16, 9), to="day", key="action", unit="day", schema=MESSAGE
    )
    return _log_counts(t, out)


@query(EVENT_LOG_SQL.format(where=""))
def event_log_stream(t: Tables) -> DataFrame:
    out = t.scratch("event-log")
    lake.stream_event_log(
        t.spark, _lake(t), f"{out}/log", f"{out}/checkpoint", key="action", schema=MESSAGE
    ).awaitTermination()
    return _log_counts(t, f"{out}/log")


@query("""
SELECT event_type AS action, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, count(*) AS messages, 1::BIGINT AS files
FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY ALL""")
def event_log_compacted(t: Tables) -> DataFrame:
    """A log of three appends: its closed days have the same rows in one file each."""
    out = t.scratch("event-log")
    for part in range(3):
        rows = t.events.filter(F.col("message_id").cast("long") % 3 == part)
        write_event_log(rows.transform(event_log_partition_columns), f"{out}/log", key="action")
    lake.compact_event_log(t.spark, f"{out}/log", f"{out}/compacted", datetime(2024, 1, 20), key="action")
    leaf = F.concat_ws("/", *[F.concat(F.lit(f"{part}="), part) for part in ("action", "year", "month", "day")])
    files = listing.layout_report(t.spark, f"{out}/compacted").select("leaf", "files")
    return _log_counts(t, f"{out}/compacted").withColumn("leaf", leaf).join(files, "leaf").drop("leaf")


@query(EVENT_LOG_SQL.format(where="WHERE date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00'"))
def event_log_caught_up(t: Tables) -> DataFrame:
    """Half of a day comes late; taking the day over again adds that half alone."""
    out, day = t.scratch("event-log"), datetime(2024, 1, 16, 9)
    for part in range(2):
        rows = t.events.filter(F.col("message_id").cast("long") % 2 == part)
        append_lake_table(rows.transform(event_log_partition_columns), f"{out}/lake", to="day")
        for _ in range(2):
            lake.run_minute(
                t.spark, f"{out}/lake", f"{out}/log", day, to="day", key="action", unit="day", schema=MESSAGE, once=True
            )
    return _log_counts(t, f"{out}/log")


@query("""
SELECT event_id AS value, CAST(user_id AS VARCHAR) AS charge_point_id, event_type AS action,
       CAST(2 AS BIGINT) AS message_type, props AS body
FROM events""")
def stream_messages(t: Tables) -> DataFrame:
    out = t.scratch("messages")
    rows = t.events.withColumns(
        {"value": F.col("message_id").cast("long"), "message_type": F.col("message_type").cast("long")}
    )
    write_table(rows.select(*STREAM_MESSAGE.names), f"{out}/in")
    arriving = streams.read_message_stream(t.spark, f"{out}/in")
    write_stream(arriving, f"{out}/out", f"{out}/checkpoint").awaitTermination()
    return read_parquet(t.spark, f"{out}/out", STREAM_MESSAGE)
