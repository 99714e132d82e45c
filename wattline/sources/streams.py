"""Streaming sources of charge-point messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from wattline.schemas import STREAM_MESSAGE


def read_message_stream(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: StructType = STREAM_MESSAGE,
    **options: str,
) -> DataFrame:
    """New files of a directory as a stream; columns are those of the schema."""
    return spark.readStream.schema(schema).format(format).options(**options).load(path)
