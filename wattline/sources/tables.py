"""Batch sources with declared schemas."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType

from wattline.functions import event_time
from wattline.operators.timeparts import parts_to
from wattline.schemas import LAKE_MESSAGE, MESSAGE
from wattline.sources.listing import exists

# A JSON body in a CSV cell doubles its quotes.
READ_OPTIONS = {"csv": {"header": "true", "escape": '"'}}
STEPS = {"minute": timedelta(minutes=1), "hour": timedelta(hours=1), "day": timedelta(days=1)}


def frame_from_records(spark: SparkSession, rows: Iterable[Any], schema: StructType) -> DataFrame:
    """A small literal table, for expected rows and lookups."""
    return spark.createDataFrame(rows, schema)


def read_message_log(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: StructType = MESSAGE,
    **options: str,
) -> DataFrame:
    """The raw log from Parquet, ORC, JSON lines or CSV."""
    settings = {**READ_OPTIONS.get(format, {}), **options}
    return spark.read.schema(schema).format(format).options(**settings).load(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_time_slice(
    df: DataFrame, at: datetime, column: str = "write_timestamp", unit: str = "minute"
) -> DataFrame:
    """Rows of the minute (hour, day) that contains ``at``; the schema stays as it is.

    Where the table has date parts as columns, they are compared as well, which is
    what lets Spark skip partitions.
    """
    start = _floor(at, unit)
    time, low, high = _comparable(df, column, start, start + STEPS[unit])
    inside = (time >= low) & (time < high)
    for part in parts_to(unit):
        if part in df.columns:
            inside = inside & (F.col(part) == getattr(start, part))
    return df.filter(inside)


def read_last_minute(
    spark: SparkSession,
    path: str,
    now: datetime | None = None,
    to: str = "minute",
    format: str = "parquet",
    schema: StructType = LAKE_MESSAGE,
    column: str = "write_timestamp",
    unit: str = "minute",
) -> DataFrame:
    """What the lake table received in the minute before ``now``.

    A Parquet table is opened at the one directory that can hold that minute (its
    directories go down to ``to``), so the cost does not grow with the age of the
    table. Other formats prune through their own log. A minute in which nothing arrived
    gives no rows; a table that is not there is an error.
    """
    at = (now or datetime.now(timezone.utc)) - STEPS[unit]
    if format != "parquet":
        return read_time_slice(spark.read.format(format).load(path), at, column, unit)
    parts = parts_to(to)
    missing = [StructField(part, IntegerType(), True) for part in parts if part not in schema.names]
    full = StructType(schema.fields + missing)
    start = _floor(at, unit)
    coarse = parts[: parts.index(unit) + 1] if unit in parts else parts
    leaf = "/".join([path.rstrip("/"), *[f"{part}={getattr(start, part)}" for part in coarse]])
    if not exists(spark, path):
        raise FileNotFoundError(f"no lake table at {path}")
    if not exists(spark, leaf):
        return spark.createDataFrame([], full)
    table = spark.read.schema(full).option("basePath", path).parquet(leaf)
    return read_time_slice(table, at, column, unit)


def slice_bounds(at: datetime, unit: str = "minute") -> tuple[datetime, datetime]:
    """Start and end of the minute (hour, day) that contains ``at``."""
    start = _floor(at, unit)
    return start, start + STEPS[unit]


def _floor(at: datetime, unit: str) -> datetime:
    """Start of the unit on the UTC clock; a time without zone is taken as UTC."""
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
    zeros = {name: 0 for name in ("hour", "minute") if name not in parts_to(unit)}
    return at.replace(second=0, microsecond=0, **zeros)


def _comparable(
    df: DataFrame, column: str, *bounds: datetime
) -> tuple[Column, Column, Column]:
    """The time column and its bounds in one type; a typed column stays bare for pushdown."""
    kind = df.schema[column].dataType
    time = event_time(column) if isinstance(kind, StringType) else F.col(column)
    limits = [F.lit(bound) for bound in bounds]
    if isinstance(kind, TimestampNTZType):
        limits = [F.lit(bound.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz") for bound in bounds]
    return (time, *limits)
