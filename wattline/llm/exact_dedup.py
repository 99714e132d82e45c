"""Exact duplicates by recipes of content-defined chunks, in Spark expressions only.

A text without its white space is cut where its content says so: after at least
``SHORTEST`` characters, behind the next anchor (a vowel and one of n, r, s, t), at
``LONGEST`` at the latest. Each chunk is named by a 64-bit hash. A first pass brings
equal chunks together and looks for a name that stands for two contents; only a name
without such a clash is a verified identifier. A document is then the ordered list of
its chunks' identifiers, about 1 % of its text, and these lists are what is grouped.
Where a name clashes, the documents that hold it carry their whole text as a second key,
so hash collisions never join different texts.

Defined results: null text is empty; all empty texts are equal; a null id sorts behind all
others; of repeated rows (same id, equal text, same length) one stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, fresh, text_of, written

SHORTEST, LONGEST = 512, 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{SPACE}]+", "")


def chunks(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    cut = f"(?s).{{{shortest - 2},{longest - 2}}}?[aeio][nrst]|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    longest: int = LONGEST,
    name: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per document: its group of equal texts and whether it stays.

    Columns: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_points``.
    The row with the most code points in the original text stays, then the smallest id.
    ``name`` is the hash of a chunk.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text"))
    bare = source.select(
        "id", F.char_length("text").cast("long").alias("n_points"), normalised(F.col("text")).alias("bare")
    )
    cut = bare.withColumn("chunks", chunks(F.col("bare"), shortest, longest))
    digest = written(
        cut.select(
            "id",
            "n_points",
            F.sha2("bare", 256).alias("text_sha256"),
            F.transform("chunks", lambda chunk: name(chunk)).alias("recipe"),
            F.lit(None).cast("string").alias("witness"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "recipes",
    )
    clashes = written(
        cut.select(F.explode("chunks").alias("chunk"))
        .groupBy(name(F.col("chunk")).alias("name"), "chunk")
        .agg(F.lit(1))
        .groupBy("name")
        .count()
        .filter("count > 1")
        .select("name"),
        "clashes",
    )
    if not clashes.isEmpty():
        digest = _with_witness(cut, digest, clashes, name)

    groups = (
        digest.groupBy("recipe", "witness", "n_points")
        .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("first"), F.count("*").alias("n"))
        .groupBy("recipe", "witness")
        .agg(
            F.min(F.struct((-F.col("n_points")).alias("shorter"), "first")).alias("best"),
            F.sum("n").alias("group_size"),
        )
        .select("recipe", "witness", "group_size", F.col("best.first").alias("first"))
    )
    key = digest["recipe"].eqNullSafe(groups["recipe"]) & digest["witness"].eqNullSafe(groups["witness"])
    return digest.join(groups, key).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
        "n_points",
    )


def _with_witness(cut: DataFrame, digest: DataFrame, clashes: DataFrame, name) -> DataFrame:
    """The digest again, with the whole text beside every recipe that holds a clashing name."""
    recipes = digest.select("recipe").distinct()
    unsafe = (
        recipes.select("recipe", F.explode("recipe").alias("name"))
        .join(clashes, "name", "left_semi")
        .select(F.col("recipe").alias("unsafe"))
        .distinct()
    )
    named = cut.withColumn("recipe", F.transform("chunks", lambda chunk: name(chunk)))
    return written(
        named.join(unsafe, named["recipe"] == unsafe["unsafe"], "left").select(
            "id",
            "n_points",
            F.sha2("bare", 256).alias("text_sha256"),
            "recipe",
            F.when(F.col("unsafe").isNotNull(), F.col("bare")).alias("witness"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "recipes",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row for each group of equal texts; columns as they came."""
    names = [fresh(docs, name) for name in ("kept_id", "kept_sha256", "kept_points")]
    kept = copies(docs, id_col, text_col).filter("kept").select(
        *[F.col(f"`{old}`").alias(new) for old, new in zip((id_col, "text_sha256", "n_points"), names)]
    )
    sha, points = fresh(docs, "own_sha256"), fresh(docs, "own_points")
    named = docs.withColumns(
        {sha: F.sha2(normalised(text_of(text_col)), 256), points: F.char_length(text_of(text_col)).cast("long")}
    )
    same = (
        named[id_col].eqNullSafe(kept[names[0]]) & (named[sha] == kept[names[1]]) & (named[points] == kept[names[2]])
    )
    return named.join(kept, same, "left_semi").dropDuplicates([id_col, sha, points]).select(*docs.columns)
