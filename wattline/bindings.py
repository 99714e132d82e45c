"""The general-purpose test tables seen as a charging log.

``orders`` are sessions, ``lineitem`` rows are meter messages, ``events`` are status
notifications. Bodies are real JSON text, so the jobs parse what they would parse
in production. Everything is a row-wise expression or an aggregation that combines
before the shuffle; no rows are gathered into arrays.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import iso_text
from wattline.schemas import MESSAGE, REQUEST, RESPONSE

JSON = {"ignoreNullFields": "false"}
SECOND_READING = "INTERVAL 6 HOURS"
PLUGGED_OUT = "INTERVAL 12 HOURS"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def event_messages(events: DataFrame) -> DataFrame:
    """Events as envelope rows; ``props`` is the body."""
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.lit(REQUEST).alias("message_type"),
        F.col("user_id").cast("string").alias("charge_point_id"),
        F.col("event_type").alias("action"),
        iso_text("ts").alias("write_timestamp"),
        F.col("props").alias("body"),
    )


def status_notifications(events: DataFrame) -> DataFrame:
    """Events as status reports: the event type is the status of device ``user_id``."""
    return events.select(
        F.concat(F.lit("status-"), "event_id").alias("message_id"),
        F.lit(REQUEST).alias("message_type"),
        F.col("user_id").cast("string").alias("charge_point_id"),
        F.lit("StatusNotification").alias("action"),
        iso_text("ts").alias("write_timestamp"),
        F.to_json(
            F.struct(
                F.lit(1).alias("connector_id"),
                F.lit("NoError").alias("error_code"),
                F.col("event_type").alias("status"),
                iso_text("ts", "xx").alias("timestamp"),
                F.get_json_object("props", "$.k").try_cast("int").alias("info"),
                F.lit(None).cast("int").alias("vendor_id"),
                F.lit(None).cast("int").alias("vendor_error_code"),
            ),
            JSON,
        ).alias("body"),
    )


def session_facts(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders with the first and last ship date and the lowest and highest price of their lines.

    The explode keeps the four together: jobs that use two of them here and two there share one aggregation.
    """
    ends = lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_extendedprice").alias("low"),
        F.max("l_extendedprice").alias("high"),
    )
    lines = ends.select("l_orderkey", F.explode(F.array(F.struct("first_ship", "last_ship", "low", "high"))).alias("ends")).select(
        "l_orderkey", "ends.first_ship", "ends.last_ship",
        F.floor("ends.low").cast("int").alias("low"), F.floor("ends.high").cast("int").alias("high"),
    )
    return orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus").join(
        lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )


def start_requests(facts: DataFrame) -> DataFrame:
    """Every order asks for a session, at the order date or at an earlier first ship date."""
    start = F.least("o_orderdate", "first_ship")
    return _envelope(
        facts,
        F.concat(F.lit("start-"), "o_orderkey"),
        REQUEST,
        F.col("o_custkey"),
        "StartTransaction",
        start,
        _json(
            F.lit(1).alias("connector_id"),
            F.concat(F.lit("tag-"), "o_custkey").alias("id_tag"),
            F.coalesce("low", F.lit(0)).alias("meter_start"),
            iso_text(start).alias("timestamp"),
            F.lit(None).cast("int").alias("reservation_id"),
        ),
    )


def start_responses(orders: DataFrame) -> DataFrame:
    return _envelope(
        orders,
        F.concat(F.lit("start-"), "o_orderkey"),
        RESPONSE,
        F.col("o_custkey"),
        "StartTransaction",
        F.col("o_orderdate"),
        _json(
            F.col("o_orderkey").alias("transaction_id"),
            F.struct(
                F.col("o_orderstatus").alias("status"),
                F.col("o_orderpriority").alias("parent_id_tag"),
                F.lit(None).cast("string").alias("expiry_date"),
            ).alias("id_tag_info"),
        ),
    )


def stop_requests(facts: DataFrame) -> DataFrame:
    """Orders with lines end their session half a day after the last ship date."""
    stop = F.col("last_ship") + F.expr(PLUGGED_OUT)
    return _envelope(
        facts.filter(F.col("last_ship").isNotNull()),
        F.concat(F.lit("stop-"), "o_orderkey"),
        REQUEST,
        F.col("o_custkey"),
        "StopTransaction",
        stop,
        _json(
            F.col("high").alias("meter_stop"),
            iso_text(stop).alias("timestamp"),
            F.col("o_orderkey").alias("transaction_id"),
            F.lit(None).cast("string").alias("reason"),
            F.concat(F.lit("tag-"), "o_custkey").alias("id_tag"),
            F.array("o_orderstatus", "o_orderpriority").alias("transaction_data"),
        ),
    )


def meter_values(lineitem: DataFrame) -> DataFrame:
    """Every line is a meter message of two readings six hours apart, three samples each.

    Power is zero on lines without discount. The extra key ``location`` is in the
    JSON text only. The text is put together from its parts, as numbers and times need no escapes: that
    takes less time than forming structs and writing them as JSON, and gives the same text.
    """
    power = F.when(F.col("l_discount") == 0, "0.0").otherwise(F.col("l_quantity").cast("string"))
    samples = F.concat(
        *_sample(power, "Power.Active.Import", None, "W"), F.lit(","),
        *_sample(F.col("l_extendedprice").cast("string"), "Voltage", "L1-N", "V"), F.lit(","),
        *_sample(F.col("l_tax").cast("string"), "Power.Active.Import", "L1", "W"),
    )
    second = F.col("l_shipdate") + F.expr(SECOND_READING)

    def reading(at: Column) -> list[Column]:
        return [F.lit('{"timestamp":'), _quoted(iso_text(at)), F.lit(',"sampled_value":['), samples, F.lit("]}")]

    return _envelope(
        lineitem,
        F.concat_ws("-", F.lit("meter"), F.col("l_orderkey"), F.col("l_linenumber")),
        REQUEST,
        F.col("l_suppkey"),
        "MeterValues",
        second,
        F.concat(
            F.lit('{"connector_id":'),
            F.coalesce(F.col("l_linenumber").cast("string"), F.lit("null")),
            F.lit(',"meter_value":['),
            *reading(F.col("l_shipdate")),
            F.lit(","),
            *reading(second),
            F.lit('],"transaction_id":'),
            F.coalesce(F.col("l_orderkey").cast("string"), F.lit("null")),
            F.lit("}"),
        ),
    )


ACTIONS = ("StartTransaction", "StopTransaction", "MeterValues", "StatusNotification")


def charging_log(
    orders: DataFrame,
    lineitem: DataFrame,
    events: DataFrame,
    actions: Sequence[str] = ACTIONS,
    tasks: int | None = None,
) -> DataFrame:
    """The raw log of the given actions; a filter on one kind of message leaves only its branch.

    ``tasks`` deals orders, meter lines and events out to that many tasks before their bodies are built. It is for
    a caller that knows its tables to be a few small files; by default nothing is shuffled.
    """

    def dealt(df: DataFrame) -> DataFrame:
        return df if tasks is None else df.repartition(tasks)

    facts = session_facts(orders, lineitem)
    kinds = {
        "StartTransaction": lambda: start_requests(facts).unionByName(start_responses(dealt(orders))),
        "StopTransaction": lambda: stop_requests(facts),
        "MeterValues": lambda: meter_values(dealt(lineitem)),
        "StatusNotification": lambda: status_notifications(dealt(events)),
    }
    return reduce(DataFrame.unionByName, [kinds[action]() for action in actions])


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), JSON)


def _quoted(text: Column) -> Column:
    """A number or a time as a JSON string; null stays null."""
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def _sample(value: Column, measurand: str, phase: str | None, unit: str) -> list[Column]:
    """The parts of a sampled value's JSON text."""
    rest = {
        "context": "Sample.Periodic", "format": "Raw", "measurand": measurand, "phase": phase, "location": "Outlet", "unit": unit
    }
    return [F.lit('{"value":'), _quoted(value), F.lit("," + json.dumps(rest, separators=(",", ":"))[1:])]


def _envelope(df, message_id, message_type, device, action, written, body) -> DataFrame:
    return df.select(
        message_id.alias("message_id"),
        F.lit(message_type).alias("message_type"),
        device.cast("string").alias("charge_point_id"),
        F.lit(action).alias("action"),
        iso_text(written).alias("write_timestamp"),
        body.alias("body"),
    ).select(*MESSAGE.names)
