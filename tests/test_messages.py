import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import helpers as h
from wattline import schemas
from wattline.operators import messages as m
from wattline.sources.tables import frame_from_records

ENVELOPE = "message_id string, message_type int, charge_point_id string, action string, write_timestamp string, body string"
WRITTEN = "2023-05-06T07:08:09.000123+00:00"


def log(spark, *bodies, action="StartTransaction", kind=2):
    data = [(f"m{i}", kind, "plug-1", action, WRITTEN, body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(data, ENVELOPE)


@pytest.mark.parametrize(
    "action, kind",
    [("StartTransaction", 2), ("StartTransaction", 3), ("StopTransaction", 2), ("MeterValues", 2)],
)
def test_messages_keep_one_kind(spark, action, kind):
    df = spark.createDataFrame(
        [(action, 2, "123"), (action, 3, "123"), ("Heartbeat", kind, "123"), (None, kind, "1"), (action, None, "1")],
        "action string, message_type int, charge_point_id string",
    )
    result = df.transform(m.messages, action, kind)
    assert result.schema == df.schema
    assert h.rows(result) == [(action, kind, "123")]


def test_actions_need_no_message_type(spark):
    df = spark.createDataFrame(
        [("a", "StopTransaction"), ("b", "StartTransaction"), ("c", "Heartbeat")], "foo string, action string"
    )
    assert h.rows(df.transform(m.actions, "StopTransaction")) == [("a", "StopTransaction")]


BODIES = {
    "start request": (schemas.START_REQUEST, h.START_REQUEST_BODY, (1, h.TAG, 0, "2022-01-01T08:00:00+00:00", None)),
    "start response": (schemas.START_RESPONSE, h.START_RESPONSE_BODY, (1, ("Accepted", h.TAG, None))),
    "stop request": (
        schemas.STOP_REQUEST,
        h.STOP_REQUEST_BODY,
        (2780, "2022-01-01T08:20:00+00:00", 1, None, h.TAG, None),
    ),
}


@pytest.mark.parametrize("name", BODIES)
def test_unpack_appends_a_struct_and_filters_nothing(spark, name):
    schema, body, expected = BODIES[name]
    df = log(spark, body, None)
    result = df.transform(m.unpack_json, schema)
    assert result.schema == T.StructType(df.schema.fields + [T.StructField("new_body", schema, True)])
    assert h.rows(result.select("message_id", "new_body")) == [("m0", expected), ("m1", None)]


def test_unpack_needs_only_the_body_and_replaces_a_former_struct_in_place(spark):
    df = spark.createDataFrame([(h.START_RESPONSE_BODY,)], "body string").select(
        F.lit("old").alias("new_body"), "body"
    )
    result = df.transform(m.unpack_json, schemas.START_RESPONSE)
    assert result.columns == ["new_body", "body"]
    assert result.first().new_body.transaction_id == 1


def test_unpack_keeps_dirty_rows(spark):
    bodies = ["{not json", '{"connector_id": "x", "meter_start": 5}', "[1]", "", "{}"]
    result = log(spark, *bodies).transform(m.unpack_json, schemas.START_REQUEST)
    assert h.rows(result.select("message_id", "new_body.connector_id", "new_body.meter_start")) == [
        ("m0", None, None),
        ("m1", None, 5),
        ("m2", None, None),
        ("m3", None, None),
        ("m4", None, None),
    ]


def test_wide_ids_hold_what_32_bits_cannot(spark):
    body = '{"transaction_id": 5000000000}'
    narrow = log(spark, body).transform(m.unpack_json, schemas.START_RESPONSE)
    wide = log(spark, body).transform(m.unpack_json, schemas.with_wide_ids(schemas.START_RESPONSE))
    assert narrow.select("new_body.transaction_id").first()[0] is None
    assert wide.select("new_body.transaction_id").first()[0] == 5_000_000_000


def test_unpack_meter_values_drops_unknown_keys(spark):
    df = log(spark, h.meter_body((WRITTEN, h.full_reading())), action="MeterValues")
    result = df.transform(m.unpack_json, schemas.METER_VALUES)
    assert result.schema["new_body"].dataType == schemas.METER_VALUES
    body = result.first().new_body
    assert body.transaction_id == 1
    assert len(body.meter_value[0].sampled_value) == 21
    assert "location" not in body.meter_value[0].sampled_value[0]


def test_unpack_status(spark):
    body = (
        '{"connector_id": 1, "error_code": "NoError", "status": "SuspendedEVSE",'
        ' "timestamp": "2023-01-01T09:03:00+00:00", "info": null, "vendor_id": null, "vendor_error_code": null}'
    )
    result = log(spark, body).transform(m.unpack_json, schemas.STATUS_NOTIFICATION)
    assert tuple(result.first().new_body) == (
        1, "NoError", "SuspendedEVSE", "2023-01-01T09:03:00+00:00", None, None, None,
    )


def test_json_text_is_parsed_once(spark):
    """A join condition on a parsed field must not parse the text again below."""
    left = log(spark, h.START_RESPONSE_BODY).transform(m.unpack_json, schemas.START_RESPONSE)
    starts = left.select("message_id", "new_body.transaction_id")
    other = spark.range(3).select(F.col("id").cast("int").alias("transaction_id"))
    joined = starts.join(other, "transaction_id")
    assert h.physical(joined).count("from_json") == 1


def test_flatten_start_request(spark):
    result = log(spark, h.START_REQUEST_BODY).transform(m.unpack_json, schemas.START_REQUEST).transform(m.flatten)
    assert result.columns == [
        "message_id", "message_type", "charge_point_id", "action", "write_timestamp",
        "connector_id", "id_tag", "meter_start", "timestamp", "reservation_id",
    ]
    assert result.schema["timestamp"].dataType == T.StringType()
    assert h.rows(result) == [
        ("m0", 2, "plug-1", "StartTransaction", WRITTEN, 1, h.TAG, 0, "2022-01-01T08:00:00+00:00", None)
    ]


def test_flatten_prefixes_inner_structs(spark):
    df = log(spark, h.START_RESPONSE_BODY, h.START_RESPONSE_BODY, kind=3)
    result = df.transform(m.unpack_json, schemas.START_RESPONSE).transform(m.flatten)
    assert result.columns[5:] == [
        "transaction_id", "id_tag_info_status", "id_tag_info_parent_id_tag", "id_tag_info_expiry_date",
    ]
    assert result.count() == 2
    assert tuple(result.first())[5:] == (1, "Accepted", h.TAG, None)


def test_flatten_keeps_arrays(spark):
    body = h.STOP_REQUEST_BODY.replace('"transaction_data": null', '"transaction_data": ["a", "b"]')
    result = log(spark, body).transform(m.unpack_json, schemas.STOP_REQUEST).transform(m.flatten)
    assert result.columns[5:] == schemas.STOP_REQUEST.names
    assert result.schema["transaction_data"].dataType == T.ArrayType(T.StringType(), True)
    assert result.first().transaction_data == ["a", "b"]


SAMPLE_COLUMNS = [
    "message_id", "message_type", "charge_point_id", "action", "write_timestamp",
    "transaction_id", "connector_id", "timestamp", "measurand", "phase", "value",
]


def meter_log(spark):
    return log(
        spark,
        h.meter_body((WRITTEN, h.full_reading()), ("2023-05-06T07:13:09Z", h.full_reading()[:3])),
        h.meter_body((WRITTEN, [h.sample("n/a", "Power.Active.Import", None)]), ("bad time", h.full_reading()[:1])),
        h.meter_body((WRITTEN, [])),
        '{"connector_id": 1, "meter_value": [], "transaction_id": 1}',
        None,
        action="MeterValues",
    )


@pytest.mark.parametrize("schema", [schemas.METER_VALUES, schemas.METER_SAMPLES], ids=["full", "narrow"])
def test_flatten_samples(spark, schema):
    result = meter_log(spark).transform(m.unpack_json, schema).transform(m.flatten_samples)
    assert result.columns == SAMPLE_COLUMNS
    assert result.schema["timestamp"].dataType == T.TimestampType()
    assert result.schema["value"].dataType == T.DoubleType()
    counts = dict(h.rows(result.groupBy("message_id").count()))
    assert counts == {"m0": 24, "m1": 2}
    dirty = result.filter("message_id = 'm1'").select("timestamp", "value")
    assert [tuple(r) for r in dirty.collect()].count((None, 40.0)) == 1
    assert result.filter("value is null").count() == 1


def test_one_message_of_21_samples(spark):
    df = log(spark, h.meter_body((WRITTEN, h.full_reading())), action="MeterValues")
    unpacked = df.transform(m.unpack_json, schemas.METER_VALUES)
    assert unpacked.transform(m.flatten_samples).count() == 21
    result = unpacked.transform(m.reshape_meter_values)
    assert set(result.columns) == {"transaction_id", "timestamp", "measurand", "phase", "value"}
    assert [r.value for r in result.collect()] == [1330]
    without_total = [s for s in h.full_reading() if s["value"] != "1330"]
    other = log(spark, h.meter_body((WRITTEN, without_total)), action="MeterValues")
    assert other.transform(m.unpack_json, schemas.METER_VALUES).transform(m.reshape_meter_values).count() == 0


def test_power_samples_need_measurand_and_no_phase(spark):
    df = spark.createDataFrame(
        [("Power.Active.Import", None), ("Power.Active.Import", "L1"), ("Voltage", None)],
        "measurand string, phase string",
    )
    assert h.rows(df.transform(m.power_samples)) == [("Power.Active.Import", None)]


def test_cast_timestamps_in_place(spark):
    df = spark.createDataFrame(
        [("a", "2022-01-01T08:00:00+00:00", [None]), ("b", "not a time", None)],
        "id string, timestamp string, transaction_data array<string>",
    )
    result = df.transform(m.cast_timestamps)
    assert result.columns == df.columns
    assert result.schema["timestamp"].dataType == T.TimestampType()
    assert [r.timestamp for r in result.orderBy("id").collect()] == [h.utc(2022, 1, 1, 8).replace(tzinfo=None), None]


def test_cast_session_timestamps(spark):
    df = frame_from_records(
        spark,
        [(1, "123", 0, 10, "2022-01-01T08:00:00+00:00", "2022-01-01T09:00:00Z")],
        "transaction_id int, charge_point_id string, meter_start int, meter_stop int,"
        " start_timestamp string, stop_timestamp string",
    )
    result = df.transform(m.cast_session_timestamps)
    assert result.columns == df.columns
    assert [t.simpleString() for t in (f.dataType for f in result.schema.fields[-2:])] == ["timestamp"] * 2


def test_all_three_spellings_of_utc(spark):
    texts = ["2023-01-01T09:00:00Z", "2023-01-01T09:00:00+00:00", "2023-01-01T09:00:00.000+0000"]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string").transform(m.cast_timestamps)
    assert {r[0] for r in df.collect()} == {h.utc(2023, 1, 1, 9).replace(tzinfo=None)}


def test_select_status(spark):
    df = spark.createDataFrame(
        [("430c", ("SuspendedEV", "2023-01-01T09:00:00.000+0000")), ("f3cf", ("Faulted", "2023-01-01T09:00:00.000+0000"))],
        "charge_point_id string, new_body struct<status: string, timestamp: string>",
    )
    result = df.transform(m.select_status)
    nine = h.utc(2023, 1, 1, 9).replace(tzinfo=None)
    assert h.rows(result) == [("430c", "SuspendedEV", nine), ("f3cf", "Faulted", nine)]
    assert result.schema == T.StructType(
        [
            T.StructField("charge_point_id", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
        ]
    )
