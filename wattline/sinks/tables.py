"""Batch sinks.

Rows are brought together per output directory with a rebalance: directories of
usual size get exactly one file, while a directory that is too large for one task
is split by its real size at run time. No task has to write a whole hot partition.
A table in one file is written by many tasks, too, and joined row group by row group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.timeparts import parts_to


def write_log_partitioned(
    df: DataFrame,
    path: str,
    to: str = "hour",
    cluster_by: tuple[str, ...] = ("action", "message_type"),
    one_file: bool = False,
    tasks: int | None = None,
    mode: str = "overwrite",
) -> None:
    """The raw log as Parquet under ``year=…/month=…/day=…/hour=…``.

    Rows are sorted by the kind of message within a file, so a later filter on one
    kind skips the row groups of the others. ``one_file`` forces one file per
    directory whatever its size. ``tasks`` should be about the number of directories
    of a large load, so that no task holds a little of many of them.
    """
    order = [name for name in cluster_by if name in df.columns]
    _write_by(df, path, parts_to(to), mode, order=order, one_file=one_file, tasks=tasks)


def write_table(
    df: DataFrame, path: str, files: int | None = None, in_place: bool = False, mode: str = "overwrite"
) -> None:
    """A Parquet table in as many files as its size asks for, or in exactly ``files``.

    ``in_place`` writes every row where it is, without a shuffle: right for a table
    about as large as the input it is made of, row by row. One file is joined from what the tasks
    wrote; more than one are dealt to as many tasks.
    """
    if files is not None and files != 1:
        df = df.repartition(files)
    elif not in_place:
        df = df.hint("rebalance")
    if files == 1:
        _write_joined(df, path, mode)
    else:
        df.write.mode(mode).parquet(path)


def append_lake_table(
    df: DataFrame, path: str, to: str = "minute", format: str = "parquet", mode: str = "append"
) -> None:
    """Append to the lake table, partitioned down to ``to``; ``format="delta"`` where installed."""
    _write_by(df, path, parts_to(to), mode, format)


def write_event_log(
    df: DataFrame, path: str, key: str = "charge_point_id", format: str = "parquet", mode: str = "append"
) -> None:
    """The log of each device under ``<key>=…/year=…/month=…/day=…``."""
    _write_by(df, path, [key, *parts_to("day")], mode, format)


def lake_format(spark: SparkSession) -> str:
    """``delta`` if its package is on the class path, else ``parquet``."""
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("io.delta.sql.DeltaSparkSessionExtension")
    except Exception:
        return "parquet"
    return "delta"


def _write_by(
    df: DataFrame,
    path: str,
    parts: list[str],
    mode: str,
    format: str = "parquet",
    order: list[str] | None = None,
    one_file: bool = False,
    tasks: int | None = None,
) -> None:
    by = [*([] if tasks is None else [tasks]), *parts]
    placed = df.repartition(*by) if one_file else df.hint("rebalance", *by)
    if order:
        # The writer sorts by directory anyway; this order begins the same, so it is one sort.
        placed = placed.sortWithinPartitions(*parts, *order)
    placed.write.mode(mode).format(format).partitionBy(*parts).save(path)


def _write_joined(df: DataFrame, path: str, mode: str) -> None:
    """A table in one file, without one task that writes it all.

    Tasks write files beside ``path``; then the driver's JVM copies their row groups, as the bytes they are and a
    buffer at a time, behind one another. The table is replaced when that is done, the marker comes last.
    """
    spark = df.sparkSession
    Path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    target = Path(path)
    files = target.getFileSystem(conf)
    target = files.makeQualified(target)
    mode = mode.lower()
    if mode not in ("overwrite", "append") and files.exists(target):
        if mode == "ignore":
            return
        raise FileExistsError(f"{path} exists")
    beside = Path(target.getParent(), f"_joining-{uuid.uuid4().hex}")
    try:
        parts, joined = Path(beside, "parts"), Path(beside, "joined")
        df.write.parquet(parts.toString())
        written = {status.getPath().getName(): status.getPath() for status in files.listStatus(parts)}
        tables = sorted(name for name in written if name.endswith(".parquet"))
        _join(spark, [written[name] for name in tables], joined)
        if mode == "overwrite":
            files.delete(target, True)
        files.mkdirs(target)
        _move(files, joined, Path(target, tables[0]))
        marker = Path(target, "_SUCCESS")
        if "_SUCCESS" in written and not files.exists(marker):
            _move(files, written["_SUCCESS"], marker)
    finally:
        files.delete(beside, True)
    spark.catalog.refreshByPath(path)


def _join(spark: SparkSession, parts: list, out) -> None:
    """Parquet files of one schema as one file with all their row groups."""
    hadoop, conf = spark._jvm.org.apache.parquet.hadoop, spark._jsc.hadoopConfiguration()

    def opened(part):
        return hadoop.util.HadoopInputFile.fromPath(part, conf)

    reader = hadoop.ParquetFileReader.open(opened(parts[0]))
    described = reader.getFileMetaData()
    reader.close()
    writer = hadoop.ParquetFileWriter(conf, described.getSchema(), out)
    writer.start()
    for part in parts:
        writer.appendFile(opened(part))
    writer.end(described.getKeyValueMetaData())


def _move(files, source, target) -> None:
    if not files.rename(source, target):
        raise OSError(f"{source.toString()} can't be renamed to {target.toString()}")
