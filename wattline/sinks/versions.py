"""Tables whose parts are replaced one by one, each change with a commit of its own.

A change is a number. It writes the new state of the parts it touches (directories by the ``by`` columns) under
``data/version=<n>``, and when all of it is there, the list of these parts under ``commits/version=<n>``. Readers take each
part from the newest committed version that has it, so they never see half a change, a change that failed is
written anew under its number, and one that was committed is not made again. Nothing is renamed, so
any file store serves. ``vacuum`` removes what newer versions have replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from wattline.sources.listing import exists, is_committed, list_output, remove


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed changes in order; one directory for each is listed."""
    folder = f"{path.rstrip('/')}/commits"
    if not exists(spark, folder):
        return []
    names = [row["name"].rstrip("/") for row in list_output(spark, folder).collect()]
    numbers = sorted(int(name.removeprefix("version=")) for name in names if name.startswith("version="))
    return [number for number in numbers if is_committed(spark, f"{folder}/version={number}")]


def commits(spark: SparkSession, path: str, kinds: str) -> DataFrame:
    """What the committed changes have noted (columns ``kinds``), with their ``version``."""
    base = f"{path.rstrip('/')}/commits"
    folders = [f"{base}/version={number}" for number in versions(spark, path)]
    schema = f"{kinds}, version int" if kinds else "version int"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def replace_parts(df: DataFrame, path: str, version: int, by: list[str], notes: DataFrame | None = None) -> None:
    """Write the new state of the parts that ``df`` has rows of, and commit it; a committed version is left as it is.

    ``by`` are columns whose values name directories (numbers or dates). The commit notes the parts, or ``notes`` where
    the caller has to remember something else for the change.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if version in versions(spark, path):
        return
    data = f"{path}/data/version={version}"
    placed = df.hint("rebalance", *by).write.partitionBy(*by) if by else df.hint("rebalance").write
    placed.mode("overwrite").parquet(data)
    if notes is None:
        # From the directories, not the rows: one small row for each part.
        kinds = ", ".join(f"{name} {df.schema[name].dataType.simpleString()}" for name in by)
        notes = spark.read.schema(kinds).parquet(data).select(*by).distinct() if by else spark.range(1).select(F.lit(True).alias("whole"))
    notes.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={version}")


def read_parts(spark: SparkSession, path: str, schema: StructType, by: list[str], only: DataFrame | None = None) -> DataFrame:
    """The table as of the last committed change, or the parts of it that ``only`` has rows of; columns are those of the schema.

    One name for each part comes to the driver, as in any listing of directories.
    """
    path = path.rstrip("/")
    kinds = ", ".join(f"{name} {schema[name].dataType.simpleString()}" for name in by)
    newest = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("version"))
    parts = commits(spark, path, kinds).withColumn("rank", F.row_number().over(newest)).filter("rank = 1")
    if only is not None:
        parts = parts.join(only.select(*by).distinct(), by, "left_semi")
    # Directories are named as the writer names them.
    leaf = F.concat_ws("/", F.concat(F.lit("version="), "version"), *(F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in by))
    folders = [f"{path}/data/{row['leaf']}" for row in parts.select(leaf.alias("leaf")).collect()]
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField("version", IntegerType())])
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def vacuum(spark: SparkSession, path: str, schema: StructType, by: list[str]) -> list[str]:
    """Remove directories of replaced parts and of changes that were never committed; returns their names.

    No change may be under way, and readers of an older state lose their files.
    """
    path, done = path.rstrip("/"), versions(spark, path)
    kinds = ", ".join(f"{name} {schema[name].dataType.simpleString()}" for name in by)
    newest = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("version"))
    noted = commits(spark, path, kinds).withColumn("rank", F.row_number().over(newest))
    leaf = F.concat_ws("/", F.concat(F.lit("version="), "version"), *(F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in by))
    gone = [row["leaf"] for row in noted.filter("rank > 1").select(leaf.alias("leaf")).collect()]
    found = [row["name"].rstrip("/") for row in list_output(spark, f"{path}/data").collect()] if exists(spark, f"{path}/data") else []
    gone += [name for name in found if name.startswith("version=") and int(name.removeprefix("version=")) not in done]
    for name in gone:
        remove(spark, f"{path}/data/{name}")
    return sorted(gone)
