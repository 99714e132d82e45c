"""Tables without date directories that know the times in each of their files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.sources.listing import exists, list_tree
from wattline.sources.tables import read_time_slice, slice_bounds

ZONES = "_zones"
ZONE = "name string, low timestamp, high timestamp, no_time long"


def append_zoned(df: DataFrame, path: str, time: str = "write_timestamp", files: int | None = None) -> None:
    """Append rows in the order of ``time`` (a timestamp), so each file covers a short stretch, and note the stretch of each new file.

    Late rows make files of their own with older stretches; nothing that was written is touched.
    """
    placed = df.repartitionByRange(time) if files is None else df.repartitionByRange(files, time)
    placed.sortWithinPartitions(time).write.mode("append").parquet(path)
    note_zones(df.sparkSession, path, time)


def note_zones(spark: SparkSession, path: str, time: str = "write_timestamp") -> None:
    """Bring the zone map up to the files that are there; files that it has are not opened again."""
    missing = _files(spark, path).join(_zones(spark, path).select("name"), "name", "left_anti")
    names = [f"{path.rstrip('/')}/{row['name']}" for row in missing.collect()]  # the files of one append
    if not names:
        return
    at = F.col(time).cast("timestamp")
    rows = spark.read.parquet(*names).select(F.col("_metadata.file_name").alias("name"), at.alias("at"))
    zones = rows.groupBy("name").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count_if(F.col("at").isNull()).alias("no_time"))
    zones.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{ZONES}")


def files_of_slice(spark: SparkSession, path: str, at: datetime, unit: str = "minute") -> list[str]:
    """Files that may hold rows of the minute (hour, day) that contains ``at``; one that the map doesn't know may."""
    start, stop = slice_bounds(at, unit)
    known = F.col("known").isNull() | ((F.col("low") < F.lit(stop)) & (F.col("high") >= F.lit(start)))
    zones = _zones(spark, path).withColumn("known", F.lit(True))
    found = _files(spark, path).join(zones, "name", "left").filter(known).select("name").collect()
    return sorted(f"{path.rstrip('/')}/{row['name']}" for row in found)


def read_zoned_slice(
    spark: SparkSession, path: str, at: datetime, schema: StructType, column: str = "write_timestamp", unit: str = "minute"
) -> DataFrame:
    """Rows of the minute (hour, day) that contains ``at``, from the files that can hold them; no other file is opened."""
    names = files_of_slice(spark, path, at, unit)
    rows = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return read_time_slice(rows, at, column, unit)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Files directly in the table's directory."""
    return list_tree(spark, path).filter("leaf = ''").select("name")


def _zones(spark: SparkSession, path: str) -> DataFrame:
    folder = f"{path.rstrip('/')}/{ZONES}"
    if not exists(spark, folder):
        return spark.createDataFrame([], ZONE)
    # An append that failed after its notes may have noted a file again.
    return spark.read.schema(ZONE).parquet(folder).groupBy("name").agg(F.min("low").alias("low"), F.max("high").alias("high"))
