"""Silver tables bucketed for the joins that read them, so that these need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wattline.operators.sessions import attach_parking, close_session, match_start, total_energy, total_time


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table of the session's catalog with ``buckets`` files by the hash of ``keys``, each sorted by them; returns it.

    Rows are brought together by bucket first, so a bucket is one file and a join reads it in order. The number of
    buckets is that of the tasks of a later join: choose it by the size of the table (about 128 MB a file).
    Tables that are to be joined need the same keys and numbers.
    """
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_sessions(
    requests: DataFrame, responses: DataFrame, stops: DataFrame, path: str, prefix: str, buckets: int
) -> dict[str, DataFrame]:
    """The tables that lead to closed sessions: both sides of the match by device and message, both sides of the closing by transaction.

    The match of starts is itself written by transaction: it is read by every job on sessions, and its join is paid once.
    """
    by_message, by_session, root = ["charge_point_id", "message_id"], ["transaction_id"], path.rstrip("/")
    sides = {
        name: write_bucketed(df, f"{prefix}_{name}", f"{root}/{name}", by_message, buckets)
        for name, df in (("requests", requests), ("responses", responses))
    }
    starts = sides["responses"].transform(match_start, sides["requests"])
    return {
        **sides,
        "starts": write_bucketed(starts, f"{prefix}_starts", f"{root}/starts", by_session, buckets),
        "stops": write_bucketed(stops, f"{prefix}_stops", f"{root}/stops", by_session, buckets),
    }


def records_from_buckets(tables: dict[str, DataFrame], parking: DataFrame) -> DataFrame:
    """Charge detail records from ``bucketed_sessions``: closing a session reads two buckets side by side."""
    return (
        tables["stops"].transform(close_session, tables["starts"])
        .transform(total_time)
        .transform(total_energy)
        .transform(attach_parking, parking)
    )
