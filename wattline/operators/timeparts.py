"""Date parts used as partition columns, and parsed event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import event_time

PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
}


def parts_to(finest: str) -> list[str]:
    """Part names from the year down to ``finest``."""
    names = list(PARTS)
    return names[: names.index(finest) + 1]


def partition_columns(
    df: DataFrame, column: str = "write_timestamp", to: str = "hour", replace: bool = False
) -> DataFrame:
    """Append year … ``to`` of a text time; ``replace`` also turns the text into a timestamp."""
    time = event_time(column)
    parts = {name: PARTS[name](time) for name in parts_to(to)}
    return df.withColumns({column: time, **parts} if replace else parts)


def bronze_partition_columns(df: DataFrame) -> DataFrame:
    """The raw log: typed write time, partitioned to the hour."""
    return partition_columns(df, to="hour", replace=True)


def lake_partition_columns(df: DataFrame) -> DataFrame:
    """The lake table: write time stays text, partitioned to the minute."""
    return partition_columns(df, to="minute")


def event_log_partition_columns(df: DataFrame) -> DataFrame:
    """The per-device log: write time stays text, partitioned to the day."""
    return partition_columns(df, to="day")


def with_event_time(
    df: DataFrame, source: str = "write_timestamp", target: str = "converted_timestamp"
) -> DataFrame:
    return df.withColumn(target, event_time(source))
