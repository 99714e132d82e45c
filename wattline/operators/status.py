"""Status counts in event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_counts(
    df: DataFrame,
    key: str = "charge_point_id",
    status: str = "status",
    time: str = "timestamp",
    length: str = "5 minutes",
    delay: str = "10 minutes",
) -> DataFrame:
    """Reports per device, status and tumbling window, on a batch or a stream.

    On a stream the watermark drops reports that come more than ``delay`` behind and
    frees the windows it has passed. On a batch it has no effect.
    """
    return (
        df.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, delay)
        .groupBy(key, status, F.window(time, length))
        .agg(F.count(status).alias(f"count({status})"))
        # Analysis marks the window column; the mark is not part of the table's schema.
        .withMetadata("window", {})
    )
