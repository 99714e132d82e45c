"""Most recent row per device."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    key: str = "charge_point_id",
    time: str = "converted_timestamp",
    ties: tuple[str, ...] | None = None,
    target: str = "rn",
) -> DataFrame:
    """The newest row of every key, with its rank 1 kept as last column.

    Each task first cuts its own rows to one per key (a group limit below the
    shuffle), so a hot key costs one row per task. ``ties`` decides between rows of
    the same time; it is ``message_id`` where there is one.
    """
    if ties is None:
        ties = ("message_id",) if "message_id" in df.columns else ()
    newest = Window.partitionBy(key).orderBy(*[F.desc(name) for name in (time, *ties)])
    return df.withColumn(target, F.row_number().over(newest)).filter(F.col(target) == 1)


def drop_helpers(df: DataFrame, *columns: str) -> DataFrame:
    """Drop the columns that only served to find the row; absent ones are no error."""
    return df.drop(*(columns or ("rn", "write_timestamp")))
