"""Mixing sources to target weights by nested hash thresholds.

Every document has a hash of ``bits * levels`` bits. Its source takes whole rounds of all
its documents, and of the last, partial round those whose hash lies below a threshold.
The threshold is found without sorting: sum the sizes by source and by the hash's first
``bits`` bits, find the bucket in which the budget runs out, and refine that bucket
alone by the next bits. The thresholds are nested: a larger budget takes a superset.

Targets: source number i in code point order (null last) weighs ``weights[i % len]``; all
sizes are shared by weight, no target exceeds ``most`` times its source's size, and the excess is
shared again, until none is above.

Defined results: a null or empty text has size 0 and takes nothing; a null id hashes like an
empty one; equal ids have equal hashes and go in together; a source of size 0 has target 0; an
empty table gives an empty mix. Of the last bucket all rows or none go in, whichever lies
nearer to the target (none, if equally near).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, fresh, text_of, written

WEIGHTS, MOST, BITS, LEVELS = (1, 2, 3), 3, 10, 5


def word_count(text: Column) -> Column:
    """Number of runs without white space: each run, with the space around it, shrinks to one mark."""
    runs = F.regexp_replace(text, f"[{SPACE}]*[^{SPACE}]+[{SPACE}]*", "x")
    return F.when(F.rlike(text, F.lit(f"[^{SPACE}]")), F.char_length(runs)).otherwise(0).cast("long")


def place(id_col: str, width: int) -> Column:
    """The hash of a document, ``width`` bits (up to 60), the same in every run and engine."""
    digest = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.shiftright(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 60 - width)


def shares(sources: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """Sources with their ``target``; ``sources`` has source and source_size, one row each.

    A source is numbered through its range partition and the partitions' counts, and the shared
    level is found by a few aggregations, so no task sees all sources.
    """
    ordered = written(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .select("source", "source_size", F.monotonically_increasing_id().alias("at")),
        "sources",
    ).withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = ordered.groupBy("part").count()
    before = counts.select(
        F.col("part").alias("before_part"),
        (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"),
    )
    number = F.col("at") + F.col("before")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    weighed = written(
        ordered.join(before, F.col("part") == F.col("before_part")).select(
            "source", "source_size", weight.alias("weight")
        ),
        "weights",
    )
    ceiling = F.col("source_size") * float(most)
    level = last = -1.0
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    while True:
        full = F.col("weight") * level > ceiling
        held, free = weighed.agg(
            F.sum(F.when(full, ceiling).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
        ).first()
        level = (total - held) / free if free else last
        if level <= last:
            break
        last = level
    return weighed.select("source", "source_size", F.least(ceiling, F.col("weight") * last).alias("target"))


def plan(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    bits: int = BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """For each source: ``source_size``, ``target``, whole ``rounds`` and the ``threshold`` of the last.

    ``sized`` has source, size and place (a hash of ``bits * levels`` bits). It is read once for the
    sources and once for each level, the lower levels through the boundary bucket alone.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = written(shares(sources, weights, most).withColumn("rounds", rounds.cast("long")), "targets")
    edge = planned.filter("source_size > 0").select(
        F.col("source").alias("of"),
        F.lit(0).cast("long").alias("prefix"),
        (F.col("target") - F.col("rounds") * F.col("source_size")).alias("budget"),
    )
    for level in range(levels):
        above, below = bits * (levels - level), bits * (levels - level - 1)
        inside = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("place", above) == F.col("prefix"))
        histogram = (
            sized.filter("size > 0")
            .join(edge, inside)
            .groupBy("of", "budget", F.shiftright("place", below).alias("prefix"))
            .agg(F.sum("size").alias("size"))
        )
        in_order = Window.partitionBy("of").orderBy("prefix")
        summed = histogram.select("*", F.sum("size").over(in_order).alias("reached"))
        # The first bucket that the budget doesn't fill; the last one where rounding leaves a budget for all.
        boundary = F.min_by(
            F.struct("prefix", (F.col("budget") - F.col("reached") + F.col("size")).alias("budget"), F.col("size").alias("leaf_size")),
            F.struct(F.col("reached") <= F.col("budget"), F.abs(F.col("reached") - F.col("budget"))),
        )
        edge = summed.groupBy("of").agg(boundary.alias("edge")).select("of", "edge.*")
    nearer = F.col("leaf_size") - F.col("budget") < F.col("budget")
    edge = edge.select("of", (F.col("prefix") + nearer.cast("long")).alias("threshold"))
    return planned.join(edge, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "rounds", F.coalesce("threshold", F.lit(0)).alias("threshold")
    )


def sizes(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, bits: int = BITS, levels: int = LEVELS
) -> DataFrame:
    return written(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(text_of(text_col)).alias("size"),
            place(id_col, bits * levels).alias("place"),
        ),
        "sizes",
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    most: float = MOST,
    bits: int = BITS,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target`` and ``taken`` words, repeats counted."""
    sized = sizes(docs, id_col, text_col, source_col, bits, levels)
    planned = written(plan(sized, weights, most, bits, levels), "mix").withColumnRenamed("source", "of")
    times = F.col("rounds") + (F.col("place") < F.col("threshold")).cast("long")
    return sized.join(planned, sized["source"].eqNullSafe(planned["of"])).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as they came."""
    bits, levels = options.get("bits", BITS), options.get("levels", LEVELS)
    planned = written(plan(sizes(docs, id_col, text_col, source_col, bits, levels), **options), "mix")
    names = {old: fresh(docs, f"mix_{old}") for old in ("source", "rounds", "threshold")}
    planned = planned.select(*[F.col(old).alias(new) for old, new in names.items()])
    copy = fresh(docs, "mix_copy")
    times = F.col(names["rounds"]) + (place(id_col, bits * levels) < F.col(names["threshold"])).cast("long")
    return (
        docs.join(planned, docs[source_col].eqNullSafe(planned[names["source"]]))
        .withColumn(copy, F.explode(F.sequence(F.lit(0), times)))
        .filter(F.col(copy) > 0)
        .select(*docs.columns)
    )
