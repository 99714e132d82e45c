"""Bodies that can't be read as declared, told apart from good ones while both are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"
GOOD = "good"
#: Why a body was set aside.
MISSING, MALFORMED, UNTYPED = "missing", "malformed", "untyped"


def unpack_checked(
    df: DataFrame, schema: StructType, source: str = "body", target: str = "new_body", reason: str = "reason"
) -> DataFrame:
    """Parse a JSON text column and say why where it can't be read: ``reason`` is null for a good row.

    A body is ``missing`` (null), ``malformed`` (no JSON object) or ``untyped`` (a value is not of the type
    that its field declares). The text is kept for these and dropped where the struct says it all.
    The parser itself reports both kinds, so each text is parsed once.
    """
    full = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # As in ``unpack_json``, the explode keeps later conditions from parsing the text again.
    parsed = F.explode_outer(F.array(F.from_json(source, full, options))).alias("__parsed")
    body = F.col("__parsed")
    # What begins as an object and has a declared field is JSON with a wrong value in it, else it is none.
    no_object = F.get_json_object(source, "$").isNull() | ~F.startswith(F.ltrim(F.col(source)), F.lit("{"))
    why = (
        F.when(F.col(source).isNull(), MISSING)
        .when(body.getField(CORRUPT).isNotNull() & no_object, MALFORMED)
        .when(body.getField(CORRUPT).isNotNull(), UNTYPED)
        .when(body.isNull(), MALFORMED)
    )
    struct = F.struct(*(body.getField(name).alias(name) for name in schema.names))
    kept = [F.col(name) for name in df.columns if name not in (source, target, reason)]
    return df.select("*", parsed).select(*kept, body, F.col(source), why.alias(reason)).select(
        *kept,
        F.when(F.col(reason).isNull(), struct).alias(target),
        F.when(F.col(reason).isNotNull(), F.col(source)).alias(source),
        reason,
    )


def write_split(df: DataFrame, path: str, reason: str = "reason", mode: str = "append") -> None:
    """Good and bad rows to ``good=true`` and ``good=false`` of one table, in one pass over the input.

    A reader of the good rows opens their directory alone; rows stay where they were read.
    """
    df.withColumn(GOOD, F.col(reason).isNull()).write.mode(mode).partitionBy(GOOD).parquet(path)


def read_split(spark: SparkSession, path: str, schema: StructType, good: bool = True) -> DataFrame:
    """The good rows of a table written by ``write_split``, or its quarantine."""
    full = StructType([*schema.fields, StructField(GOOD, BooleanType())])
    rows = spark.read.schema(full).parquet(path).filter(F.col(GOOD) == F.lit(good))
    return rows.select(*schema.names)
