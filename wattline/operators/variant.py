"""Bodies as VARIANT: keys that no schema declares are kept and can be asked for by path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, source: str = "body", target: str = "any_body") -> DataFrame:
    """Parse a JSON text column into a variant; text that is no JSON becomes null. Nothing in it is lost.

    The one-element explode serves the same end as in ``unpack_json``.
    """
    parsed = F.explode_outer(F.array(F.try_parse_json(F.col(source)))).alias(target)
    return df.select(*(F.col(name) for name in df.columns if name != target), parsed)


def at_paths(df: DataFrame, paths: dict[str, tuple[str, str]], source: str = "any_body") -> DataFrame:
    """Columns from paths: name to (JSON path, type); null where the path is missing or its value is of another kind.

    All paths are read from the one parsed value.
    """
    return df.withColumns({name: F.try_variant_get(F.col(source), path, kind) for name, (path, kind) in paths.items()})


def entries_at(df: DataFrame, path: str, kept: list[str], source: str = "any_body", target: str = "entry") -> DataFrame:
    """One row for each entry of the array at a path, as a variant of its own, beside the kept columns."""
    array = F.try_variant_get(F.col(source), path, "array<variant>")
    return df.select(*kept, F.explode(array).alias(target))


def inferred_schema(df: DataFrame, *by: str, source: str = "any_body", target: str = "schema") -> DataFrame:
    """The schema that all variants of a group have in common, as text: found by an aggregation, in one pass."""
    return df.groupBy(*by).agg(F.schema_of_variant_agg(F.col(source)).alias(target))


def undeclared(df: DataFrame, declared: Column, source: str = "any_body") -> DataFrame:
    """Rows whose top level has keys that are not among ``declared`` (an array of names), with these keys as ``undeclared``."""
    keys = F.map_keys(F.try_variant_get(F.col(source), "$", "map<string,variant>"))
    # As a plain column the keys would be listed once for the condition and once for the result.
    found = F.explode(F.array(F.array_except(keys, declared))).alias("undeclared")
    return df.select(*(F.col(name) for name in df.columns if name != "undeclared"), found).filter(F.size("undeclared") > 0)
