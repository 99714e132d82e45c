"""Live status counts: message stream to windowed counts to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattline.operators.messages import messages, select_status, unpack_json
from wattline.operators.status import status_counts
from wattline.schemas import REQUEST, STATUS_REPORT


def count_statuses(stream: DataFrame, length: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Same transforms on a stream as on a batch."""
    return (
        stream.transform(messages, "StatusNotification", REQUEST)
        .transform(unpack_json, STATUS_REPORT)
        .transform(select_status)
        .transform(status_counts, length=length, delay=delay)
    )


def write_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    once: bool = True,
    interval: str = "1 minute",
    files: int | None = None,
    format: str = "parquet",
    split: int = 1,
) -> StreamingQuery:
    """Append a stream to files; a window appears once the watermark has passed it.

    ``once`` works off what is there and ends; otherwise a batch runs every ``interval``.
    ``files`` brings the few rows of a batch of counts together, where every state
    partition would otherwise write a file of its own. Rows of one directory of ``partition_by`` are
    brought together, in ``split`` tasks by a hash of the row, so a batch adds as many files to each directory
    and not one for each task.
    """
    if files is not None:
        df = df.repartition(files)
    elif partition_by:
        part = [] if split == 1 else [F.pmod(F.xxhash64(*df.columns), F.lit(split))]
        df = df.repartition(*partition_by, *part)
    writer = df.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start(path)
