"""When each device was last heard of, from the whole log or kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.operators.latest import drop_helpers, latest_per_key
from wattline.operators.order import report_order
from wattline.operators.timeparts import with_event_time
from wattline.schemas import LAKE_MESSAGE
from wattline.sinks.versions import commits, read_parts, replace_parts, versions
from wattline.sources.listing import list_tree

FILE = "leaf string, name string"


def last_seen_report(log: DataFrame, key: str = "charge_point_id") -> DataFrame:
    return (
        log.transform(with_event_time)
        .transform(latest_per_key, key)
        .transform(drop_helpers)
        .transform(report_order, key)
    )


def new_files(spark: SparkSession, lake: str, snapshot: str) -> DataFrame:
    """Files of the lake table that no update of the snapshot has read: ``leaf`` (directory), ``name``."""
    found = list_tree(spark, lake).select("leaf", "name")
    return found.join(commits(spark, snapshot, FILE), ["leaf", "name"], "left_anti")


def read_files(spark: SparkSession, lake: str, files: DataFrame, schema: StructType) -> DataFrame:
    """The rows of the given files of a table; their names, as many as a slice has, come to the driver."""
    lake = lake.rstrip("/")
    names = [f"{lake}/{row['leaf']}/{row['name']}".replace("//", "/") for row in files.collect()]
    if "://" in lake:
        names = [name.replace(":/", "://", 1) for name in names]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", lake).parquet(*names).select(*schema.names)


def update_last_seen(
    spark: SparkSession, lake: str, snapshot: str, key: str = "charge_point_id", schema: StructType = LAKE_MESSAGE
) -> DataFrame:
    """Merge what has arrived in the lake since the last update into the newest row of each device; returns the files that were read.

    A late file counts as any other: the newest message stays, whichever update brings it. The snapshot is replaced as a whole by a
    commit that also notes the files, so an update that fails is made again and none is made twice.
    """
    files = new_files(spark, lake, snapshot).persist()
    try:
        rows = read_files(spark, lake, files, schema).transform(with_event_time)
        before = read_parts(spark, snapshot, rows.schema, [])
        # The tie-break is the same as over the whole log, so it does not matter in which update a row came.
        newest = before.unionByName(rows).transform(latest_per_key, key).drop("rn")
        number = max(versions(spark, snapshot), default=-1) + 1
        if files.take(1):
            replace_parts(newest, snapshot, number, [], notes=files)
        return commits(spark, snapshot, FILE).filter(F.col("version") == number).select("leaf", "name")
    finally:
        files.unpersist()


def last_seen_so_far(
    spark: SparkSession, snapshot: str, key: str = "charge_point_id", schema: StructType = LAKE_MESSAGE
) -> DataFrame:
    """The report as of the last update."""
    full = with_event_time(spark.createDataFrame([], schema)).schema
    return read_parts(spark, snapshot, full, []).transform(drop_helpers).transform(report_order, key)
