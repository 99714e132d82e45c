"""Parking time kept up to date slice by slice, without going over old samples.

The state holds one row for each session and instant: what its first and its last sample there say, which is all that
``total_parking_time`` needs of them. Two states of an instant merge by taking the smaller first and the larger
last sample, so slices may come in any order, late or more than once, and the result is that of all samples
together. It is a table cut by days (``sinks.versions``); a slice writes the days of its own samples anew and no others.
Beside each day's instants lies one row for each session and hour with the steps within the hour;
a report adds these up and reads no samples at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampType

from wattline.operators.idle import chunk_states, instant_states, merged_instants, parking_of_chunks
from wattline.sinks.versions import commits, read_parts, replace_parts

PART = "part"
#: How finely the state is cut: the day (month, year) of a sample as the name of its directory.
NAMES = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
_SAMPLE = StructType([StructField("reading", DoubleType()), StructField("idle", BooleanType())])
INSTANTS = StructType(
    [
        StructField("transaction_id", LongType()), StructField("at", TimestampType()), StructField("opens", _SAMPLE),
        StructField("closes", _SAMPLE), StructField("any_idle", BooleanType()), StructField(PART, StringType()),
    ]
)
CHUNKS = StructType(
    [
        StructField("transaction_id", LongType()), StructField("chunk", TimestampType()), StructField("steps", LongType()),
        StructField("first", TimestampType()), StructField("last", TimestampType()), StructField("opens_idle", BooleanType()),
        StructField("closes_idle", BooleanType()), StructField("any_idle", BooleanType()), StructField(PART, StringType()),
    ]
)


def update_parking(
    samples: DataFrame,
    state: str,
    slice_number: int,
    idle: Column | None = None,
    no_session: Sequence[Any] = (),
    to: str = "day",
) -> None:
    """Merge the samples of one slice into the state. A slice that was merged before changes nothing.

    ``to`` is the same for all slices: days where a slice is a minute or an hour of the log, months or years where
    it is a backlog, as each day that a slice has samples of is a directory that is written.
    """
    spark = samples.sparkSession
    arrived = instant_states(samples, idle=idle, no_session=no_session).select(
        F.col("transaction_id").cast("long").alias("transaction_id"), F.col("at").cast("timestamp").alias("at"), "opens", "closes", "any_idle"
    )
    # The slice is asked for its parts and for its rows; its samples are read once.
    arrived = arrived.withColumn(PART, F.date_format("at", NAMES[to])).persist()
    try:
        there = read_parts(spark, f"{state}/instants", INSTANTS, [PART], only=arrived)
        merged = merged_instants(there.unionByName(arrived.select(*INSTANTS.names)), "transaction_id", "at", PART)
        replace_parts(merged.select(*INSTANTS.names), f"{state}/instants", slice_number, [PART])
    finally:
        arrived.unpersist()
    # The hours of the parts that this slice has written, as its commit notes them; an hour lies within one part.
    noted = commits(spark, f"{state}/instants", f"{PART} string").filter(F.col("version") == slice_number)
    written = read_parts(spark, f"{state}/instants", INSTANTS, [PART], only=noted)
    hours = chunk_states(written, "transaction_id", chunk="hour").withColumn(PART, F.date_format("chunk", NAMES[to]))
    replace_parts(hours.select(*CHUNKS.names), f"{state}/hours", slice_number, [PART])


def parking_so_far(spark: SparkSession, state: str) -> DataFrame:
    """``total_parking_time`` of all slices merged so far, from one row for each session and hour."""
    return parking_of_chunks(read_parts(spark, f"{state}/hours", CHUNKS, [PART]), "transaction_id")
