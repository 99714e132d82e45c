"""Declared schemas of the charging log; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

REQUEST = 2
RESPONSE = 3


def _struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


MESSAGE = _struct(
    message_id=StringType(),
    message_type=IntegerType(),
    charge_point_id=StringType(),
    action=StringType(),
    write_timestamp=StringType(),
    body=StringType(),
)

LAKE_MESSAGE = StructType(MESSAGE.fields + [StructField("write_timestamp_epoch", LongType(), True)])

STREAM_MESSAGE = _struct(
    value=LongType(),
    charge_point_id=StringType(),
    action=StringType(),
    message_type=LongType(),
    body=StringType(),
)

START_REQUEST = _struct(
    connector_id=IntegerType(),
    id_tag=StringType(),
    meter_start=IntegerType(),
    timestamp=StringType(),
    reservation_id=IntegerType(),
)

START_RESPONSE = _struct(
    transaction_id=IntegerType(),
    id_tag_info=_struct(status=StringType(), parent_id_tag=StringType(), expiry_date=StringType()),
)

STOP_REQUEST = _struct(
    meter_stop=IntegerType(),
    timestamp=StringType(),
    transaction_id=IntegerType(),
    reason=StringType(),
    id_tag=StringType(),
    transaction_data=ArrayType(StringType(), True),
)

SAMPLED_VALUE = _struct(
    value=StringType(),
    context=StringType(),
    format=StringType(),
    measurand=StringType(),
    phase=StringType(),
    unit=StringType(),
)


def _meter_values(sample: StructType) -> StructType:
    reading = _struct(timestamp=StringType(), sampled_value=ArrayType(sample, True))
    return _struct(
        connector_id=IntegerType(),
        transaction_id=IntegerType(),
        meter_value=ArrayType(reading, True),
    )


METER_VALUES = _meter_values(SAMPLED_VALUE)

# What the flat samples keep of a message.
METER_SAMPLES = _meter_values(_struct(value=StringType(), measurand=StringType(), phase=StringType()))

# What single jobs use of a message. A parser reads the whole schema it is given as soon as two of
# its fields are used, so a job that uses less declares less.
SESSION_START = _struct(meter_start=IntegerType(), timestamp=StringType())
SESSION_ID = _struct(transaction_id=IntegerType())
SESSION_STOP = _struct(meter_stop=IntegerType(), timestamp=StringType(), transaction_id=IntegerType())
SESSION_SAMPLES = StructType([field for field in METER_SAMPLES.fields if field.name != "connector_id"])
STATUS_REPORT = _struct(status=StringType(), timestamp=StringType())

STATUS_NOTIFICATION = _struct(
    connector_id=IntegerType(),
    error_code=StringType(),
    status=StringType(),
    timestamp=StringType(),
    info=IntegerType(),
    vendor_id=IntegerType(),
    vendor_error_code=IntegerType(),
)

SESSION = _struct(
    charge_point_id=StringType(),
    transaction_id=IntegerType(),
    meter_start=IntegerType(),
    meter_stop=IntegerType(),
    start_timestamp=TimestampType(),
    stop_timestamp=TimestampType(),
)

CDR = _struct(
    charge_point_id=StringType(),
    transaction_id=IntegerType(),
    start_timestamp=TimestampType(),
    stop_timestamp=TimestampType(),
    total_time=DoubleType(),
    total_energy=DoubleType(),
    total_parking_time=DoubleType(),
)


def with_wide_ids(schema: StructType, name: str = "transaction_id") -> StructType:
    """The same schema with a 64-bit id, for logs with more than 2^31 transactions.

    A 32-bit field would turn larger ids in the JSON text into nulls.
    """
    return StructType(
        [
            StructField(field.name, LongType() if field.name == name else field.dataType, field.nullable)
            for field in schema.fields
        ]
    )
