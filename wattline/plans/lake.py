"""Minute micro-batches over the partitioned lake table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from wattline.operators.timeparts import event_log_partition_columns, lake_partition_columns, parts_to
from wattline.schemas import LAKE_MESSAGE
from wattline.sinks.tables import append_lake_table, write_event_log
from wattline.sources.listing import exists
from wattline.sources.streams import read_message_stream
from wattline.sources.tables import read_last_minute
from wattline.streaming.status import write_stream


def append_bronze(log: DataFrame, lake: str, to: str = "minute", format: str = "parquet") -> None:
    append_lake_table(log.transform(lake_partition_columns), lake, to, format)


def run_minute(
    spark: SparkSession,
    lake: str,
    event_log: str,
    now: datetime | None = None,
    to: str = "minute",
    key: str = "charge_point_id",
    unit: str = "minute",
    schema: StructType = LAKE_MESSAGE,
    format: str = "parquet",
    once: bool = False,
) -> None:
    """Scheduled once a minute: the last full minute of the lake into the log of each device.

    It appends, so a minute that is run twice is there twice, unless ``once``: then messages that the
    log has already, by ``message_id`` and device, on the days that arrive, are left out. With
    ``unit="hour"`` or ``"day"`` and ``once`` it takes over minutes that were skipped and rows
    that came late. ``stream_event_log`` keeps track of what it has taken over.
    """
    arrived = read_last_minute(spark, lake, now, to=to, format=format, unit=unit, schema=schema).select(*schema.names)
    placed = arrived.transform(event_log_partition_columns)
    if once and exists(spark, event_log):
        days = parts_to("day")
        there = spark.read.format(format).load(event_log).select("message_id", key, *days)
        there = there.withColumn(key, F.col(key).cast("string"))
        # As a join the days that arrive prune the directories that are read.
        there = there.join(placed.select(*days).distinct(), days, "left_semi")
        placed = placed.join(there, ["message_id", key, *days], "left_anti").select(*placed.columns)
    write_event_log(placed, event_log, key, format)


def stream_event_log(
    spark: SparkSession,
    lake: str,
    event_log: str,
    checkpoint: str,
    key: str = "charge_point_id",
    schema: StructType = LAKE_MESSAGE,
    once: bool = True,
    format: str = "parquet",
    split: int = 1,
    **options: str,
) -> StreamingQuery:
    """The same flow as a stream: each lake file is taken over exactly once, also after a failure.

    Source options such as ``maxFilesPerTrigger`` bound the batches of a long backlog. A batch adds one
    file to the directory of each device and day; ``split`` files share a large one.
    """
    arrived = read_message_stream(spark, lake, format, schema, **options).transform(event_log_partition_columns)
    by = (key, *parts_to("day"))
    return write_stream(arrived, event_log, checkpoint, by, once, format=format, split=split)


def compact_event_log(
    spark: SparkSession, event_log: str, compacted: str, before: datetime, key: str = "charge_point_id", format: str = "parquet"
) -> None:
    """Days before ``before``, which get no more rows, written anew with as few files as their size allows.

    They go to a table of their own, so a reader of the log never sees a half-written day; the old
    directories may be removed when it is committed. Running it again replaces the same table.
    """
    log = spark.read.format(format).load(event_log)
    day = F.make_date("year", "month", "day")
    closed = log.filter(day < F.lit(before.date())).withColumn(key, F.col(key).cast("string"))
    write_event_log(closed, compacted, key, format, mode="overwrite")
