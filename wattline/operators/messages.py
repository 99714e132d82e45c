"""Filtering, unpacking and flattening of charge-point messages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattline.functions import event_time

POWER = "Power.Active.Import"
SAMPLE_ENVELOPE = ("message_id", "message_type", "charge_point_id", "action", "write_timestamp")


def messages(df: DataFrame, action: str, message_type: int) -> DataFrame:
    """One kind of message: an action, and its requests or its responses."""
    return df.filter((F.col("action") == action) & (F.col("message_type") == message_type))


def actions(df: DataFrame, action: str, column: str = "action") -> DataFrame:
    """All messages of an action, for logs that do not tell requests from responses."""
    return df.filter(F.col(column) == action)


def power_samples(df: DataFrame, measurand: str = POWER) -> DataFrame:
    """Flat samples of the total over all phases of one measurand."""
    return df.filter((F.col("measurand") == measurand) & F.col("phase").isNull())


def unpack_json(
    df: DataFrame, schema: StructType, source: str = "body", target: str = "new_body"
) -> DataFrame:
    """Parse a JSON text column into a struct; replaces ``target`` if it is there already.

    The struct comes out of a one-element explode. Were it a plain column, Spark would
    push every later condition on a field (each join adds one) below the projection
    and parse the text a second time there.
    """
    parsed = F.explode_outer(F.array(F.from_json(source, schema))).alias(target)
    if target not in df.columns:
        return df.select("*", parsed)
    return df.select(*[parsed if name == target else F.col(name) for name in df.columns])


def flatten(df: DataFrame, struct: str = "new_body", drop: tuple[str, ...] = ("body",)) -> DataFrame:
    """Struct fields as columns after the envelope; inner structs give their name as prefix."""
    kept = [F.col(name) for name in df.columns if name != struct and name not in drop]
    return df.select(*kept, *_leaves(df.schema[struct].dataType, F.col(struct)))


def _leaves(schema: StructType, parent: Column, prefix: str = "") -> Iterator[Column]:
    for field in schema.fields:
        column, name = parent.getField(field.name), prefix + field.name
        if isinstance(field.dataType, StructType):
            yield from _leaves(field.dataType, column, f"{name}_")
        else:
            yield column.alias(name)


def flatten_samples(df: DataFrame, struct: str = "new_body") -> DataFrame:
    """One row per sampled value of every meter reading, with time and value typed."""
    envelope = [name for name in SAMPLE_ENVELOPE if name in df.columns]
    return _samples(df, struct, envelope, ("transaction_id", "connector_id"))


def reshape_meter_values(df: DataFrame, measurand: str = POWER, struct: str = "new_body") -> DataFrame:
    """Only the total samples of one measurand, straight from the unpacked messages.

    The two explodes and the filter run as one generated loop, so a dropped sample
    costs no row.
    """
    return _samples(df, struct, [], ("transaction_id",)).transform(power_samples, measurand)


def _samples(df: DataFrame, struct: str, envelope: list[str], ids: tuple[str, ...]) -> DataFrame:
    body = F.col(struct)
    kept = [*envelope, *ids]
    # Each explode is given only what its rows will need: no row carries the struct or the
    # array it came from. The time comes out of an explode of its own, once per reading; a
    # condition on it would else be pushed below the samples and parse it again.
    bodies = df.select(
        *envelope,
        *[body.getField(name).alias(name) for name in ids],
        body.getField("meter_value").alias("readings"),
    )
    readings = bodies.select(*kept, F.explode("readings").alias("reading")).select(
        *kept,
        F.explode(F.array(event_time("reading.timestamp"))).alias("timestamp"),
        F.col("reading.sampled_value").alias("samples"),
    )
    return readings.select(*kept, "timestamp", F.explode("samples").alias("sample")).select(
        *kept,
        "timestamp",
        F.col("sample.measurand").alias("measurand"),
        F.col("sample.phase").alias("phase"),
        F.col("sample.value").try_cast("double").alias("value"),
    )


def cast_timestamps(df: DataFrame, *columns: str) -> DataFrame:
    """Text times to timestamps in place; ``timestamp`` unless columns are named."""
    return df.withColumns({name: event_time(name) for name in columns or ("timestamp",)})


def cast_session_timestamps(df: DataFrame) -> DataFrame:
    return cast_timestamps(df, "start_timestamp", "stop_timestamp")


def select_status(df: DataFrame, struct: str = "new_body") -> DataFrame:
    """Device, reported status and the time of the report."""
    return df.select(
        "charge_point_id",
        F.col(f"{struct}.status").alias("status"),
        event_time(f"{struct}.timestamp").alias("timestamp"),
    )
