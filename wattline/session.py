"""Session settings the jobs are designed for."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Event time is text with an offset; date parts are defined on the UTC wall clock.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot transaction is split even where a later join would have reused the partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(
    app: str = "wattline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the time zone of a session that somebody else built; the setting stays on that session.

    ``forceOptimizeSkewedJoin`` and the other ``SETTINGS`` are left as that session has them.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that every executor can reach; it goes when the session's JVM ends.

    One rule for every master: the folder named by ``spark.checkpoint.dir``, else a
    folder below ``spark.sql.warehouse.dir``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder
