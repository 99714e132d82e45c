"""Live counts as a table: each batch of changed windows replaces the ones it had."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from wattline.sinks.versions import read_parts, replace_parts

PART = "window_part"
#: How finely the table is cut: the start of a window as the name of its directory.
NAMES = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}


def upsert_counts(changed: DataFrame, path: str, batch: int, keys: list[str], to: str = "hour") -> None:
    """Put the changed rows of one batch in place of those with the same keys.

    Only the hours (days, months: ``to``) that the batch has rows of are written anew, as version ``batch`` of them: hours suit a
    busy stream, whose batches touch one or two; days a long backlog. A batch
    that was put in before changes nothing, so one that is repeated after a failure does no harm. Each key may occur
    once in a batch, as in the output of an aggregation.
    """
    spark, rows = changed.sparkSession, changed.withColumn(PART, F.date_format("window.start", NAMES[to]))
    before = read_parts(spark, path, rows.schema, [PART], only=rows)
    kept = before.join(rows.select(*keys), keys, "left_anti")
    replace_parts(kept.unionByName(rows), path, batch, [PART])


def upsert_stream(
    counts: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    once: bool = True,
    interval: str = "1 minute",
    to: str = "hour",
) -> StreamingQuery:
    """Keep a table of counts up to date with a stream in update mode, open windows included.

    ``counts`` is a windowed aggregation such as ``count_statuses``; ``keys`` are its columns but the count.
    """
    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": interval}

    def put(batch: DataFrame, number: int) -> None:
        # The batch is read twice, for its parts and its rows; the state store would be asked again each time.
        rows = batch.persist()
        try:
            upsert_counts(rows, path, number, keys, to)
        finally:
            rows.unpersist()

    return writer.foreachBatch(put).trigger(**trigger).start()


def read_counts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table that ``upsert_stream`` keeps; ``schema`` is that of the counts."""
    full = StructType([*schema.fields, StructField(PART, StringType())])
    return read_parts(spark, path, full, [PART]).select(*schema.names)


def open_windows(spark: SparkSession, checkpoint: str, count: str = "count(status)") -> DataFrame:
    """What a stopped query of counts holds in its state: windows that the watermark has not passed, as last counted.

    Together with the windows it has written they are the counts of all that arrived in time.
    """
    state = spark.read.format("statestore").load(checkpoint)
    value = state.schema["value"].dataType.names[0]
    return state.select("key.*", F.col("value").getField(value).alias(count))
