"""Raw log to the partitioned bronze log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from wattline.operators.checks import Check, Watch
from wattline.operators.timeparts import bronze_partition_columns
from wattline.sinks.tables import write_log_partitioned


def write_bronze(
    log: DataFrame, path: str, one_file: bool = False, tasks: int | None = None, checks: Sequence[Check] = ()
) -> DataFrame | None:
    """The log partitioned to the hour; ``checks`` are made on the rows as they are written and returned as rows."""
    watch = Watch(*checks)
    write_log_partitioned(watch.on(log.transform(bronze_partition_columns)), path, one_file=one_file, tasks=tasks)
    return watch.rows() if checks else None
