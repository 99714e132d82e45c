"""Charging sessions: matching, closing, measuring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import energy, hours_between


def match_start(responses: DataFrame, requests: DataFrame, once: bool = False) -> DataFrame:
    """Start requests that were answered, with the transaction id of the answer.

    Both sides may be flat tables or still hold the unpacked body. ``message_id``
    links the two; the device is part of the key because both sides have it. As in
    any join, a message logged twice counts twice; ``once`` first drops exact copies,
    for logs that were delivered more than once.
    """
    answered = responses.select(
        "charge_point_id", "message_id", _field(responses, "transaction_id").alias("transaction_id")
    )
    asked = requests.select(
        "charge_point_id",
        "message_id",
        _field(requests, "meter_start").alias("meter_start"),
        _field(requests, "timestamp").alias("start_timestamp"),
    )
    if once:
        answered, asked = answered.dropDuplicates(), asked.dropDuplicates()
    return answered.join(asked, ["charge_point_id", "message_id"]).select(
        "charge_point_id", "transaction_id", "meter_start", "start_timestamp"
    )


def close_session(stops: DataFrame, starts: DataFrame, once: bool = False) -> DataFrame:
    """Sessions with both ends; a stop without a start, or the reverse, gives no row.

    ``once`` drops exact copies first, as in ``match_start``.
    """
    ended = stops.select(
        _field(stops, "transaction_id").alias("transaction_id"),
        _field(stops, "meter_stop").alias("meter_stop"),
        _field(stops, "timestamp").alias("stop_timestamp"),
    )
    if once:
        ended, starts = ended.dropDuplicates(), starts.dropDuplicates()
    return ended.join(starts, "transaction_id").select(
        "charge_point_id",
        "transaction_id",
        "meter_start",
        "meter_stop",
        "start_timestamp",
        "stop_timestamp",
    )


def attach_parking(sessions: DataFrame, parking: DataFrame) -> DataFrame:
    """Parking time per session; null, not zero, where no idle sample was seen."""
    found = parking.select("transaction_id", "total_parking_time")
    return sessions.join(found, "transaction_id", "left").select(*sessions.columns, "total_parking_time")


def total_time(
    df: DataFrame,
    start: str = "start_timestamp",
    stop: str = "stop_timestamp",
    target: str = "total_time",
) -> DataFrame:
    return df.withColumn(target, hours_between(start, stop))


def total_energy(
    df: DataFrame,
    start: str = "meter_start",
    stop: str = "meter_stop",
    unit: str = "kWh",
    target: str = "total_energy",
) -> DataFrame:
    return df.withColumn(target, energy(start, stop, unit))


def drop_meters(df: DataFrame) -> DataFrame:
    return df.drop("meter_start", "meter_stop")


def _field(df: DataFrame, name: str, struct: str = "new_body") -> Column:
    return F.col(name) if name in df.columns else F.col(struct).getField(name)
