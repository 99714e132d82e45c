"""The trie of conversations' first turns, in padded matrices of turn ids.

A conversation is cut into segments of ``WIDTH`` turns. A turn goes by 128 bits of its role, text and depth, a
prefix by the exclusive or of its turns, so the prefix before a segment follows from running totals. Segments are
range-partitioned by that prefix and their turns. Each batch of them, a shard, becomes a matrix with a row for a
segment and a column for a turn, padded at the end: ``numpy.lexsort`` orders the rows, a row that differs from the one
before in a column differs in all that follow (an accumulated or), and where it differs a node starts, so ``reduceat`` totals
every depth at once. Only nodes with the first or last row of a shard go on elsewhere: their totals are grouped again by prefix.

Totals over subtrees are sums over members. In the first pass each node gets its smallest member, its representative; a
conversation represents its nodes from some depth ``own`` down. A conversation saves the words of its turns above ``own``,
counts one leaf if it represents one, and one child where it represents the node below; the second pass sums these by node.

A node at which many conversations end gets their ids as pieces of sorted text, one for each shard, which
are hashed in order as they stream by; nothing else of a node is brought together. A long conversation is many segments, a
prefix that all share is many shards.

Defined results: rows without conversation id belong to none and are left out; a null turn comes first, turns of equal number
follow by digest of role and text; null role or text is empty; equal rows are turns of their own; no rows give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import SPACE, ship, text_of, written
from wattline.llm.running import running

WIDTH = 16
KEY = ["depth", "k1", "k2"]
NODE = "depth long, k1 long, k2 long, p1 long, p2 long, n long, low long, deepest long, words long, before long"
ENDS = "first_end long, piece string, ends string, partial boolean"
SUMS = "depth long, k1 long, k2 long, saved long, leaves long, children long, partial boolean"
NOTHING = hashlib.sha256(b"").hexdigest()


def numbered_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, ``at`` (from 0), 128 bits of role and text as ``hi`` and ``lo``, and the words of the text."""
    role, text = text_of(role_col), text_of(text_col)
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    half = [F.conv(F.substring(digest, start, 16), 16, -10).cast("long") for start in (1, 17)]
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), half[0].alias("hi"), half[1].alias("lo"),
        F.size(F.regexp_extract_all(text, F.lit(f"[^{SPACE}]+"), 0)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"),
    )
    placed = running(written(rows, "turns"), "conv_id", ["turn", "hi", "lo", "row"])
    return placed.select("conv_id", "at", "hi", "lo", "words")


def grafted(turns: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the conversation that their group of ``every`` ids begins with.

    How many, ``crc32(id) % most``, is at most ``most`` - 1; a conversation goes on with its own turns after as many.
    """
    lengths = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    skipped = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    plan = lengths.select("conv_id", base.alias("base"), skipped.alias("skipped")).join(heads, "base", "left")
    plan = written(plan.select("conv_id", "base", "skipped", F.least("skipped", F.coalesce("base_n", F.lit(0))).alias("taken")), "grafts")
    own = turns.join(plan, "conv_id").filter("at >= skipped").withColumn("at", F.col("at") - F.col("skipped") + F.col("taken"))
    first = turns.filter(F.col("at") < most - 1).withColumnRenamed("conv_id", "base")
    taken = plan.filter("taken > 0").join(first, "base").filter("at < taken")
    columns = ["conv_id", "at", "hi", "lo", "words"]
    return own.select(columns).unionByName(taken.select(columns))


def segments(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for every ``width`` turns of a conversation, one without turns for a conversation that has none."""
    keyed = turns.select(
        "conv_id", "at", F.expr(f"at div {width}").alias("seg"), "words",
        *(F.xxhash64(F.lit(i), "at", "hi", "lo").alias(f"k{i}") for i in (1, 2)),
    )
    # At most ``width`` turns meet in a group.
    listed = F.sort_array(F.collect_list(F.struct("at", "k1", "k2", "words")))
    found = keyed.groupBy("conv_id", "seg").agg(
        listed.alias("turns"), F.bit_xor("k1").alias("x1"), F.bit_xor("k2").alias("x2"), F.sum("words").alias("total")
    )
    lengths = keyed.groupBy("conv_id").agg(F.count("*").alias("len"), F.sum("words").alias("all_words"))
    every = conversations.select("conv_id").distinct().join(lengths, "conv_id", "left").join(found, "conv_id", "left")
    zero = F.lit(0).cast("long")
    rows = every.select(
        "conv_id", *(F.coalesce(name, zero).alias(name) for name in ("seg", "len", "all_words", "x1", "x2", "total")),
        F.coalesce(F.flatten(F.transform("turns", lambda turn: F.array(turn["k1"], turn["k2"]))), F.array().cast("array<bigint>")).alias("keys"),
        F.coalesce(F.transform("turns", lambda turn: turn["words"]), F.array().cast("array<bigint>")).alias("words"),
    )
    totals = running(rows, "conv_id", ["seg"], sums=["total"], xors=["x1", "x2"])
    renamed = {"before_total": "before", "before_x1": "p1", "before_x2": "p2"}
    return totals.withColumnsRenamed(renamed).drop("x1", "x2", "total", "at")


class Shard:
    """A batch of segments as a padded matrix, ordered; ``starts`` tells where the nodes of each depth begin."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        column = {name: batch.column(name) for name in batch.schema.names}
        flat = {name: column[name].to_numpy(zero_copy_only=False) for name in ("conv_id", "seg", "len", "before", "p1", "p2")}
        sizes = np.diff(column["words"].offsets.to_numpy())
        inside = np.arange(width) < sizes[:, None]
        pairs = column["keys"].flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
        keys = np.zeros((2, len(sizes), width), np.int64)
        keys[:, inside] = pairs.T
        words = np.zeros((len(sizes), width), np.int64)
        words[inside] = column["words"].flatten().to_numpy(zero_copy_only=False)
        ids = np.full((len(sizes), width), -1, np.int64)
        ids[inside] = _numbered(pairs)
        group = _numbered(np.column_stack([flat[name] for name in ("seg", "p1", "p2")]))
        # Of rows that are alike, conversations that end here come first, as padding does elsewhere.
        goes_on = flat["len"] > (flat["seg"] + 1) * width
        order = np.lexsort((flat["conv_id"], goes_on, *ids.T[::-1], group))
        # The neighbours of other shards adjoin the first and the last row, as Spark has ordered them.
        self.edges = np.flatnonzero((order == 0) | (order == len(order) - 1))
        self.row = {name: value[order] for name, value in flat.items()}
        self.order, self.ids, self.width = order, ids[order], width
        # Column j: before the j-th turn of the segment.
        self.prefix = [
            np.column_stack([self.row[name], self.row[name][:, None] ^ np.bitwise_xor.accumulate(keys[i][order], axis=1)]) for i, name in enumerate(("p1", "p2"))
        ]
        self.words = words[order]
        self.before = np.column_stack([self.row["before"], self.row["before"][:, None] + np.cumsum(self.words, axis=1)])
        change = np.ones((len(order), width + 1), bool)
        group = group[order]
        change[1:, 0] = group[1:] != group[:-1]
        change[1:, 1:] = self.ids[1:] != self.ids[:-1]
        self.change = np.logical_or.accumulate(change, axis=1)

    def levels(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each column: where runs of equal rows start, which of them are nodes, and which nodes may go on in other shards."""
        for column in range(self.width + 1):
            starts = np.flatnonzero(self.change[:, column])
            # The root is the only node before the first turn of a segment.
            real = self.row["seg"][starts] == 0 if column == 0 else self.ids[starts, column - 1] >= 0
            if real.any():
                partial = np.zeros(len(starts), bool)
                partial[np.searchsorted(starts, self.edges, side="right") - 1] = True
                yield column, starts, real, partial


def _numbered(rows: np.ndarray) -> np.ndarray:
    """Rows of numbers as numbers: equal ones alike."""
    if not len(rows):
        return np.zeros(0, np.int64)
    rows = np.ascontiguousarray(rows, np.int64)
    return np.unique(rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel(), return_inverse=True)[1].ravel()


def _nodes(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = Shard(batch, width)
        conv, length, (k1, k2) = shard.row["conv_id"], shard.row["len"], shard.prefix
        for column, starts, real, partial in shard.levels():
            depth = shard.row["seg"] * width + column
            above = max(0, column - 1)
            end = np.add.reduceat((length == depth).astype(np.int64), starts)
            ends = [conv[start : start + count] for start, count in zip(starts[real].tolist(), end[real].tolist())]
            texts = [",".join(map(str, ids.tolist())) for ids in ends]
            open_ = partial[real].tolist()
            columns = [
                depth[starts], k1[starts, column], k2[starts, column], k1[starts, above], k2[starts, above],
                np.diff(np.append(starts, len(conv))), np.minimum.reduceat(conv, starts), np.maximum.reduceat(length, starts),
                shard.words[starts, above] if column else np.zeros(len(starts), np.int64), shard.before[starts, above],
            ]
            arrays = [pa.array(value[real].astype(np.int64)) for value in columns] + [
                pa.array([int(ids[0]) if len(ids) else None for ids in ends], pa.int64()),
                pa.array([text if text and is_open else None for text, is_open in zip(texts, open_)], pa.string()),
                pa.array([None if is_open else hashlib.sha256(text.encode()).hexdigest() for text, is_open in zip(texts, open_)], pa.string()),
                pa.array(open_, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [field.split()[0] for field in f"{NODE}, {ENDS}".split(", ")])


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = Shard(batch, width)
        own, shared, leaf = (batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)[shard.order] for name in ("own", "shared", "leaf"))
        for column, starts, real, partial in shard.levels():
            depth = shard.row["seg"] * width + column
            above = shard.before[:, max(0, column - 1)]
            saved = np.where(depth < own, shared - above, 0)
            children = (shard.row["len"] > depth) & (own <= depth + 1)
            columns = [depth[starts], *(prefix[starts, column] for prefix in shard.prefix)]
            columns += [np.add.reduceat(value.astype(np.int64), starts) for value in (saved, leaf, children)]
            arrays = [pa.array(value[real].astype(np.int64)) for value in columns] + [pa.array(partial[real])]
            yield pa.RecordBatch.from_arrays(arrays, [field.split()[0] for field in SUMS.split(", ")])


def _hashed_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each node's pieces, which follow one another; only the running digest is held."""
    last, running_hash = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{**dict(zip(KEY, last)), "ends": running_hash.hexdigest()}], pa.schema([*((name, pa.int64()) for name in KEY), ("ends", pa.string())]))

    for batch in batches:
        for *key, piece in zip(*(batch.column(name).to_pylist() for name in [*KEY, "piece"])):
            if key != last:
                if last is not None:
                    yield done()
                last, running_hash = key, hashlib.sha256()
            else:
                running_hash.update(b",")
            running_hash.update(piece.encode())
    if last is not None:
        yield done()


def trie(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``turns`` is as ``numbered_turns`` gives it; ``conversations`` has every conv_id, also those without turns. Saved
    tokens are the words of a node's last turn for each member but one, summed over its subtree.
    """
    ship(turns.sparkSession)
    order = ["seg", "p1", "p2", "keys", "conv_id"]
    rows = written(segments(turns, conversations, width), "segments")
    found = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda batches: _nodes(batches, width), f"{NODE}, {ENDS}"), "nodes"
    )
    open_ = found.filter("partial")
    merged = open_.groupBy(*KEY).agg(
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("deepest").alias("deepest"),
        F.max("words").alias("words"), F.max("before").alias("before"),
    )
    pieces = open_.filter("piece IS NOT NULL").select(*KEY, "first_end", "piece").repartition(*KEY).sortWithinPartitions(*KEY, "first_end")
    hashed = pieces.mapInArrow(_hashed_in_order, "depth long, k1 long, k2 long, ends string")
    merged = merged.join(hashed, KEY, "left").withColumn("ends", F.coalesce("ends", F.lit(NOTHING)))
    nodes = written(found.filter("NOT partial").drop("partial", "piece", "first_end").unionByName(merged), "merged")

    top = F.min(F.struct("depth", "before")).alias("top")
    stands = nodes.groupBy(F.col("low").alias("conv_id")).agg(top, F.max(F.col("deepest") == F.col("depth")).alias("is_leaf"))
    told = rows.join(stands, "conv_id", "left").select(
        *rows.columns, F.coalesce("top.depth", F.col("len") + 1).alias("own"), F.coalesce("top.before", "all_words").alias("shared"),
        F.coalesce("is_leaf", F.lit(False)).alias("leaf"),
    )
    sums = written(told.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lambda batches: _sums(batches, width), SUMS), "sums")
    totals = ["saved", "leaves", "children"]
    joined = sums.filter("partial").groupBy(*KEY).agg(*(F.sum(name).alias(name) for name in totals))
    sums = sums.filter("NOT partial").select(*KEY, *totals).unionByName(joined)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("low").alias("parent_conv_id"))
    return nodes.join(sums, KEY).join(parents, ["depth", "p1", "p2"], "left").select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
