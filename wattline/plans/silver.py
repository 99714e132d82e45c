"""Raw log to one typed table per kind of message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.checks import Check, Watch
from wattline.operators.messages import cast_timestamps, flatten, flatten_samples, messages, unpack_json
from wattline.schemas import METER_SAMPLES, REQUEST, RESPONSE, START_REQUEST, START_RESPONSE, STOP_REQUEST
from wattline.schemas import with_wide_ids
from wattline.sinks.tables import write_table


def start_transaction_requests(log: DataFrame) -> DataFrame:
    return (
        log.transform(messages, "StartTransaction", REQUEST)
        .transform(unpack_json, START_REQUEST)
        .transform(flatten)
        .transform(cast_timestamps)
    )


def start_transaction_responses(log: DataFrame, wide_ids: bool = False) -> DataFrame:
    return (
        log.transform(messages, "StartTransaction", RESPONSE)
        .transform(unpack_json, body_schema(START_RESPONSE, wide_ids))
        .transform(flatten)
    )


def stop_transaction_requests(log: DataFrame, wide_ids: bool = False) -> DataFrame:
    return (
        log.transform(messages, "StopTransaction", REQUEST)
        .transform(unpack_json, body_schema(STOP_REQUEST, wide_ids))
        .transform(flatten)
        .transform(cast_timestamps)
    )


def meter_values_requests(log: DataFrame, wide_ids: bool = False) -> DataFrame:
    return (
        log.transform(messages, "MeterValues", REQUEST)
        .transform(unpack_json, body_schema(METER_SAMPLES, wide_ids))
        .transform(flatten_samples)
    )


def body_schema(schema, wide_ids: bool):
    return with_wide_ids(schema) if wide_ids else schema


def silver_tables(log: DataFrame, wide_ids: bool = False) -> dict[str, DataFrame]:
    return {
        "StartTransactionRequest": start_transaction_requests(log),
        "StartTransactionResponse": start_transaction_responses(log, wide_ids),
        "StopTransactionRequest": stop_transaction_requests(log, wide_ids),
        "MeterValuesRequest": meter_values_requests(log, wide_ids),
    }


def write_silver(
    log: DataFrame,
    path: str,
    wide_ids: bool = False,
    files: int | None = None,
    checks: Mapping[str, Sequence[Check]] | None = None,
) -> DataFrame | None:
    """One Parquet table per kind; on a bronze log each write reads its own row groups only.

    The samples are most of the log and stay where they were read; the small tables
    are brought together into few files. ``files`` fixes the number for all.

    ``checks`` names the checks of each table. They are made on the rows as they are written, and
    the result has a row for each: ``name`` of the table, ``check``, ``observed``, ``passed``.
    """
    found = []
    for name, table in silver_tables(log, wide_ids).items():
        watch = Watch(*(checks or {}).get(name, ()))
        write_table(watch.on(table), f"{path.rstrip('/')}/{name}", files, in_place=name == "MeterValuesRequest")
        if watch.checks:
            found.append(watch.rows().select(F.lit(name).alias("name"), "*"))
    return reduce(DataFrame.unionByName, found) if found else None
