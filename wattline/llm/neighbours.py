"""Approximate nearest neighbours by inner product, over several shifted Hilbert orders.

Candidates fall into bands by their norms, each band spanning a factor of ``STEP``. Within a band vectors are
lengthened by one coordinate that gives them all the band's largest norm, so that the largest inner product becomes the
nearest direction; a few long vectors do not press all others together, as they have a band of their own. Each of
``CURVES`` or more orders of a band projects its vectors to ``PROJECTED`` random directions, shifts and quantises the
projections, and sorts by the Hilbert key of the cell; queries are searched in all bands. Spark range-partitions all orders of all
bands at once. Ranks cut each order into blocks of ``BLOCK`` rows, with the ``WINDOW`` rows
before and after as a margin, so every task holds a bounded number of vectors however many share
a key. A query is compared exactly with the ``WINDOW`` rows on either side of its key; what all orders
found is merged.

Equal vectors are searched as one and take part with their smallest ids, so ties are complete. Centre
and spread of the projections are fitted, for each band, on the ``SAMPLE`` rows with the smallest hash of their id, as
queries and, those of the band, as candidates; every row is indexed. A band that one window holds needs one order. Windows are of fixed size, and a neighbour's chance to lie in one falls with the number of rows
about as its power -0.62, so beyond ``HELD`` windows the orders grow as the power 0.62 (``curves_for``).

Defined results: a vector that is null, zero, of another length than most of the sample or holds null or
non-finite components is no query and no candidate; a row without id takes no part; of rows that
repeat an id with other vectors each is a candidate; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ship, written

CURVES, PROJECTED, CELL_BITS, WINDOW, BLOCK, SAMPLE = 20, 8, 6, 2048, 8192, 4096
#: Rows that ``CURVES`` orders serve, in windows of one side, and the power by which the orders grow beyond.
HELD, POWER = 24, 0.62
#: The factor of norms that a band spans; the last of ``BANDS`` bands has all shorter vectors (below 1 / 2900 of the longest).
STEP, BANDS = 2**0.5, 24
RESULT = "query_id long, rank int, vec_id long, score double"


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (a row of whole coordinates below 2 ** bits) along the Hilbert curve.

    The coordinates are turned into the transposed index by undoing excess rotations from the highest bit
    down and then Gray-coding, after J. Skilling, "Programming the Hilbert curve" (2004).
    """
    x = cells.astype(np.int64).T.copy()
    for bit in reversed(range(1, bits)):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(len(x)):
            flips = (x[i] & high) > 0
            swap = np.where(flips, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flips, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in reversed(range(1, bits)):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for row in x:
            key = key << 1 | (row >> bit & 1)
    return key


def curves_for(rows: int, window: int = WINDOW) -> int:
    """How many orders keep the recall that ``CURVES`` have at ``HELD`` windows of rows."""
    return max(CURVES, math.ceil(CURVES * (rows / (HELD * window)) ** POWER))


class Orders:
    """The projections, shifts and scales of all orders of all bands.

    ``bands`` has for each band its largest norm and the number of its rows. Orders are numbered through all bands.
    """

    def __init__(self, sample: np.ndarray, bands: dict[int, tuple[float, int]], curves: int | None, window: int, projected: int, bits: int, seed: int):
        random = np.random.default_rng(seed)
        width = sample.shape[1] + 1
        self.bits, self.bands, first = bits, {}, 0
        needed = {band: curves or (1 if rows <= window else curves_for(rows, window)) for band, (_, rows) in bands.items()}
        most = max(needed.values())
        self.axes = np.stack([np.linalg.qr(random.normal(size=(width, min(projected, width))))[0] for _ in range(most)])
        self.shifts = random.random((most, self.axes.shape[2]))
        norms = np.sqrt((sample**2).sum(axis=1))
        longest = max(norm for norm, _ in bands.values())
        of_sample = band_of(norms, longest)
        for band, (norm, _) in sorted(bands.items()):
            both = np.concatenate((lengthened(sample[of_sample == band], norm, False), lengthened(sample, norm, True)))
            found = [both @ axes for axes in self.axes[: needed[band]]]
            self.bands[band] = (norm, first, [x.mean(axis=0) for x in found], [x.std(axis=0) + 1e-12 for x in found])
            first += needed[band]
        self.longest, self.total = longest, first

    def keys(self, vectors: np.ndarray, band: int, queries: bool) -> Iterator[tuple[int, np.ndarray]]:
        """Number and keys of each order of a band."""
        norm, first, centres, spreads = self.bands[band]
        vectors = lengthened(vectors, norm, queries)
        for curve, (axes, shifts, centre, spread) in enumerate(zip(self.axes, self.shifts, centres, spreads)):
            found = (vectors @ axes - centre) / spread
            unit = 1.0 / (1.0 + np.exp(-np.clip(1.7 * found, -30, 30)))  # near the normal distribution function
            yield first + curve, hilbert_key(((unit + shifts) * (1 << (self.bits - 1))).astype(np.int64), self.bits)


def band_of(norms: np.ndarray, longest: float) -> np.ndarray:
    """The band of each norm: 0 for the longest."""
    return np.clip(np.floor(np.log(longest / norms) / math.log(STEP) + 1e-9), 0, BANDS - 1).astype(np.int64)


def lengthened(vectors: np.ndarray, norm: float, queries: bool) -> np.ndarray:
    """Candidates with the coordinate that brings them to ``norm``, scaled to 1; queries scaled to 1, with 0 there."""
    if queries:
        vectors, extra = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None], np.zeros(len(vectors))
    else:
        vectors = vectors / norm
        extra = np.sqrt(np.maximum(0.0, 1.0 - (vectors**2).sum(axis=1)))
    return np.concatenate((vectors, extra[:, None]), axis=1)


def _keyed(frames: Iterator[pd.DataFrame], orders: Orders) -> Iterator[pd.DataFrame]:
    for frame in frames:
        if not len(frame):
            continue
        vectors, ids = np.stack(frame["vector"].to_numpy()).astype(np.float64), frame["id"].to_numpy()
        own, asked = frame["band"].to_numpy(), np.flatnonzero(frame["asked"].to_numpy())
        for band in orders.bands:
            for is_query, rows in ((False, np.flatnonzero(own == band)), (True, asked)):
                if len(rows):
                    for curve, keys in orders.keys(vectors[rows], band, is_query):
                        yield pd.DataFrame({"curve": curve, "key": keys, "query": is_query, "id": ids[rows]})


def _numbered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The number of candidates before each row in its partition."""
    part, seen = TaskContext.get().partitionId(), 0
    for frame in frames:
        candidates = (~frame["query"]).to_numpy().astype(np.int64)
        frame["part"], frame["at"] = part, seen + np.cumsum(candidates) - candidates
        seen += int(candidates.sum())
        yield frame[["curve", "query", "id", "part", "at"]]


def _searched(frame: pd.DataFrame, window: int, most: int) -> pd.DataFrame:
    """In one block, the best candidates of each query among those near it in the same order."""
    frame = frame.sort_values(["query", "rank", "id"])
    is_query = frame["query"].to_numpy()
    vectors = np.stack(frame["vector"].to_numpy()).astype(np.float64)
    ids, ranks, curves = (frame[name].to_numpy() for name in ("id", "rank", "curve"))
    c, q = np.flatnonzero(~is_query), np.flatnonzero(is_query)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(q), 64):
        some = q[start : start + 64]
        scores = vectors[some] @ vectors[c].T
        distance = ranks[c] - ranks[some][:, None]
        scores[(distance < -window) | (distance >= window) | (curves[c] != curves[some][:, None])] = -np.inf
        keep = min(most, len(c))
        if not keep:
            continue
        # All that reach the last kept score, with a margin for the order of additions.
        edge = np.partition(scores, len(c) - keep, axis=1)[:, len(c) - keep]
        row, column = np.nonzero((scores >= (edge - 1e-9 * np.maximum(1.0, np.abs(edge)))[:, None]) & np.isfinite(scores))
        exact = (vectors[some[row]] * vectors[c[column]]).sum(axis=1)
        order = np.lexsort((ids[c[column]], -exact, row))
        row, column, exact = row[order], column[order], exact[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < most
        found.append((ids[some[row[best]]], ids[c[column[best]]], exact[best]))
    if not found:
        return pd.DataFrame({"asking": [], "found": [], "score": []}).astype({"asking": "int64", "found": "int64"})
    return pd.DataFrame(dict(zip(("asking", "found", "score"), map(np.concatenate, zip(*found)))))


def nearest(
    table: DataFrame,
    asked: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    curves: int | None = None,
    projected: int = PROJECTED,
    bits: int = CELL_BITS,
    window: int = WINDOW,
    block: int = BLOCK,
    seed: int = 20250101,
) -> DataFrame:
    """For each row that is ``asked`` for, its ``k`` nearest others: query_id, rank, vec_id, score.

    Without ``curves`` their number in each band follows from the number of its rows.
    """
    spark = table.sparkSession
    ship(spark)
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("vector"), asked.alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & F.coalesce(usable, F.lit(False)))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    if not len(sample):
        return spark.createDataFrame([], RESULT)
    width = int(sample["vector"].map(len).mode()[0])
    rows = rows.filter(F.size("vector") == width)
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    fitted = np.stack(sample["vector"][sample["vector"].map(len) == width].to_numpy())
    # Equal vectors as one, with their k + 1 smallest ids; the limit is applied before the shuffle.
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    members = rows.withColumn("place", smallest).filter(F.col("place") <= k + 1).groupBy("vector")
    members = members.agg(F.sort_array(F.collect_list("id")).alias("ids"))
    questions = rows.filter("asked").groupBy("vector").agg(F.lit(True).alias("asked"))
    distinct = written(
        members.join(questions, "vector", "left").select(
            F.element_at("ids", 1).alias("id"), "ids", "vector", F.coalesce("asked", F.lit(False)).alias("asked"), F.sqrt(squared).alias("norm")
        ),
        "vectors",
    )
    longest = distinct.agg(F.max("norm")).first()[0]
    band = F.floor(F.ln(F.lit(longest) / F.col("norm")) / math.log(STEP) + 1e-9)
    distinct = distinct.withColumn("band", F.greatest(F.lit(0), F.least(band, F.lit(BANDS - 1))))
    bands = {row["band"]: (row["norm"], row["n"]) for row in distinct.groupBy("band").agg(F.max("norm").alias("norm"), F.count("*").alias("n")).collect()}
    orders = spark.sparkContext.broadcast(Orders(fitted, bands, curves, window, projected, bits, seed))

    order = ["curve", "key", "query", "id"]
    numbered = written(
        distinct.select("id", "vector", "asked", "band")
        .mapInPandas(lambda frames: _keyed(frames, orders.value), "curve int, key long, query boolean, id long")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(_numbered, "curve int, query boolean, id long, part int, at long"),
        "orders",
    )
    counts = numbered.filter("NOT query").groupBy("part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = numbered.select("part").distinct().join(counts, "part", "left")
    parts = parts.select("part", before.alias("before"))
    rank = F.col("at") + F.col("before")
    margin = F.when(F.col("query"), 0).otherwise(window)
    blocks = F.sequence(F.floor((F.col("rank") - margin) / block), F.floor((F.col("rank") + margin) / block))
    placed = numbered.join(parts, "part").select("curve", "query", "id", rank.alias("rank"))
    placed = placed.select("*", F.explode(blocks).alias("block")).join(distinct.select("id", "vector"), "id")
    found = placed.groupBy("block").applyInPandas(
        lambda frame: _searched(frame, window, k + 1), "asking long, found long, score double"
    )

    best = Window.partitionBy("asking").orderBy(F.desc("score"), "found")
    merged = found.groupBy("asking", "found").agg(F.max("score").alias("score"))
    merged = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    expanded = merged.join(distinct.select(F.col("id").alias("found"), "ids"), "found").select(
        "asking", "score", F.explode("ids").alias("vec_id")
    )
    by_id = Window.partitionBy("asking").orderBy(F.desc("score"), "vec_id")
    lists = (
        expanded.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("asking")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    )
    askers = rows.filter("asked").select(F.col("id").alias("query_id"), "vector").distinct()
    answers = askers.join(distinct.select("vector", F.col("id").alias("asking")), "vector").join(lists, "asking")
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "one")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "one.vec_id", "one.score"
    )
