"""Merkle manifest of a dataset: subtrees in van Emde Boas layout, block roots hashed again.

Every row is a leaf, the digest of its columns. Within each source the leaves stand in ascending id order and
every ``FAN`` neighbours make a node, level by level, until one is left, the subroot; the subroots, ordered by source, make
the root in the same way. Aligned subtrees of ``LEVELS`` levels are blocks. A block is one row: its nodes lie in a
byte string in van Emde Boas order, that is, the tree is cut at half its height, the upper part comes first, then
one lower part after another, each laid out by the same rule. ``address`` finds a node by arithmetic alone, for building as
well as for fetching siblings. The roots of blocks are the leaves of the next tier of blocks.

Proofs go down the tiers: each block hands every child the siblings on the way to the root, so a leaf's proof takes its own
block and one such path for the block. Places come from a range partition (``running``), blocks hold at most
``FAN ** (LEVELS - 1)`` leaves, so neither a large source nor many small ones load a single task.

Defined results: a null column is ``-``; rows without source form the first source, within it as in any other; rows without id
come first in their source, rows of equal id by digest; equal rows are leaves of their own; no rows give no manifest;
further columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import ship, written
from wattline.llm.running import running

FAN, LEVELS, SIZE = 16, 4, 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of a result that are handed to Spark at once.
ROWS = 512
BLOCK = "key string, block long, root binary, n int, tree binary, ids array<long>, changed array<binary>"
STEP = "lefts array<binary>, rights array<binary>, subroot string, root string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def nodes_in(levels: int, fan: int = FAN) -> int:
    """Nodes of a whole tree."""
    return (fan**levels - 1) // (fan - 1)


def address(depth: int, index: np.ndarray, levels: int, fan: int = FAN) -> np.ndarray:
    """Where the nodes ``index`` of a depth lie in a tree of so many levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    upper = levels // 2
    if depth < upper:
        return address(depth, index, upper, fan)
    below = fan ** (depth - upper)
    start = nodes_in(upper, fan) + index // below * nodes_in(levels - upper, fan)
    return start + address(depth - upper, index % below, levels - upper, fan)


def widths(leaves: int, block: int, levels: int, fan: int = FAN) -> list[int]:
    """The number of nodes of each depth of a block, the root first. Only a lone block may be less high than ``levels``."""
    found, lone = [leaves], block == 0 and leaves < fan ** (levels - 1)
    while found[0] > 1 or (not lone and len(found) < levels):
        found.insert(0, -(-found[0] // fan))
    return found


def _hash(hexes: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(hexes)).digest()


def build(leaves: list[bytes], block: int, levels: int = LEVELS, fan: int = FAN) -> bytes:
    """The nodes of a block in van Emde Boas order, up to the last one that there is."""
    sizes = widths(len(leaves), block, levels, fan)
    places = [address(depth, np.arange(size), len(sizes), fan) for depth, size in enumerate(sizes)]
    tree = bytearray(SIZE * (max(int(place.max()) for place in places) + 1))
    nodes = leaves
    for depth in reversed(range(len(sizes))):
        for place, node in zip(places[depth].tolist(), nodes):
            tree[SIZE * place : SIZE * (place + 1)] = node
        hexes = [node.hex().encode() for node in nodes]
        nodes = [_hash(hexes[i : i + fan]) for i in range(0, len(hexes), fan)]
    return bytes(tree)


def siblings(tree: bytes, n: int, block: int, levels: int = LEVELS, fan: int = FAN) -> list[list[bytes]]:
    """The hex digests of each run, by depth from the leaves upwards, of a block's tree."""
    sizes = widths(n, block, levels, fan)
    found = []
    for depth in range(len(sizes) - 1, 0, -1):
        places = address(depth, np.arange(sizes[depth]), len(sizes), fan).tolist()
        hexes = [tree[SIZE * i : SIZE * (i + 1)].hex().encode() for i in places]
        found.append([b"".join(hexes[i : i + fan]) for i in range(0, len(hexes), fan)])
    return found


def steps(runs: list[list[bytes]], leaf: int, fan: int = FAN) -> list[tuple[bytes, bytes]]:
    """What stands left and right of a leaf's ancestors within the block, from the leaf upwards."""
    found = []
    for level in runs:
        leaf, place = divmod(leaf, fan)
        run = level[leaf]
        found.append((run[: 2 * SIZE * place], run[2 * SIZE * (place + 1) :]))
    return found


def fold(leaf: str, path: list[tuple[bytes, bytes]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        leaf = hashlib.sha256(left + leaf.encode() + right).hexdigest()
    return leaf


def digest(columns: list[Column]) -> Column:
    """The digest of a row, as 32 bytes."""

    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


@dataclass
class Manifest:
    """Tiers of blocks, the lowest first: of leaves in their source, then of subroots; ``subroots`` tells the place of each."""

    within: list[DataFrame]
    across: list[DataFrame]
    subroots: DataFrame
    levels: int
    fan: int


def _made(table: pa.Table, levels: int, fan: int) -> pa.Table:
    table = table.sort_by("at")
    key, at = table["key"][0].as_py(), table["at"][0].as_py()
    block = at // fan ** (levels - 1)
    tree = build(table["leaf"].to_pylist(), block, levels, fan)
    # Ids and changed digests belong to leaves of the dataset, not to roots of blocks.
    ids, changed = (table[name].to_pylist() if name in table.column_names else [] for name in ("id", "changed"))
    row = {"key": [key], "block": [block], "root": [tree[:SIZE]], "n": [len(table)], "tree": [tree], "ids": [ids], "changed": [changed]}
    types = [pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.table([pa.array(row[name], kind) for name, kind in zip(row, types)], names=list(row))


def _tiers(placed: DataFrame, levels: int, fan: int) -> list[DataFrame]:
    """Blocks of ``placed`` (key, at, leaf and perhaps id, changed), of their roots, and so on until one is left for each key."""
    found = []
    while True:
        of = placed.withColumn("block", F.expr(f"at div {fan ** (levels - 1)}"))
        found.append(written(of.groupBy("key", "block").applyInArrow(lambda table: _made(table.drop_columns("block"), levels, fan), BLOCK), "blocks"))
        if not found[-1].agg(F.max("block")).first()[0]:
            return found
        placed = found[-1].select("key", F.col("block").alias("at"), F.col("root").alias("leaf"))


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    changed: Column | None = None,
    levels: int = LEVELS,
    fan: int = FAN,
) -> Manifest:
    """The tree over all rows. ``changed`` is a digest to be held against the manifest later, null where there is none."""
    ship(docs.sparkSession)
    # The empty string stands for no source and sorts before all others, which begin with "=".
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    leaf = digest([F.col(f"`{name}`") for name in fields])
    row = docs.select(
        key.alias("key"), F.col(f"`{id_col}`").cast("long").alias("id"), leaf.alias("leaf"),
        (F.lit(None).cast("binary") if changed is None else changed).alias("changed"), F.monotonically_increasing_id().alias("row"),
    )
    placed = running(written(row, "leaves"), "key", ["id", "leaf", "row"])
    within = _tiers(placed.select("key", "at", "leaf", "id", "changed"), levels, fan)
    roots = within[-1].select(F.lit("").alias("key"), F.col("key").alias("name"), F.col("root").alias("leaf"))
    subroots = written(running(roots, "key", ["name"]), "subroots")
    return Manifest(within, _tiers(subroots.select("key", "at", "leaf"), levels, fan), subroots, levels, fan)


def _children(batches: Iterator[pa.RecordBatch], levels: int, fan: int) -> Iterator[pa.RecordBatch]:
    """The path of every child of a block. ``batches`` has key, block, n, tree and the path of the block itself."""
    for batch in batches:
        for key, block, n, tree, lefts, rights, subroot, root in zip(*(column.to_pylist() for column in batch.columns)):
            runs, upper = siblings(tree, n, block, levels, fan), list(zip(lefts, rights))
            for low in range(0, n, ROWS):
                paths = [steps(runs, leaf, fan) + upper for leaf in range(low, min(n, low + ROWS))]
                at = np.arange(low, low + len(paths)) + block * fan ** (levels - 1)
                columns = [
                    pa.array([key] * len(paths), pa.string()), pa.array(at, pa.int64()), pa.array([[a for a, _ in path] for path in paths], pa.list_(pa.binary())),
                    pa.array([[b for _, b in path] for path in paths], pa.list_(pa.binary())), pa.array([subroot] * len(paths), pa.string()),
                    pa.array([root] * len(paths), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["key", "at", "lefts", "rights", "subroot", "root"])


def _proofs(batches: Iterator[pa.RecordBatch], levels: int, fan: int) -> Iterator[pa.RecordBatch]:
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for batch in batches:
        for block, n, tree, ids, changed, lefts, rights, subroot, root in zip(*(column.to_pylist() for column in batch.columns)):
            runs, upper, depth = siblings(tree, n, block, levels, fan), list(zip(lefts, rights)), len(widths(n, block, levels, fan)) - 1
            above = b"".join(left + right for left, right in upper)
            place = address(depth, np.arange(n), depth + 1, fan).tolist()
            for low in range(0, n, ROWS):
                rows = []
                for i in range(low, min(n, low + ROWS)):
                    leaf, own = tree[SIZE * place[i] : SIZE * (place[i] + 1)].hex(), steps(runs, i, fan)
                    proof = hashlib.sha256(b"".join(left + right for left, right in own) + above).hexdigest()
                    folded = fold(leaf if changed[i] is None else changed[i].hex(), own + upper)
                    rows.append((ids[i], leaf, subroot, root, proof, folded, folded == root))
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names)


def proofs(tree: Manifest) -> DataFrame:
    """One row for every leaf: id, leaf, subroot, root, ``proof_sha256`` (digest of the siblings from the leaf to the root),
    ``folded_root`` (from the changed digest, if there is one, and the siblings of the manifest) and ``verified``."""
    levels, fan = tree.levels, tree.fan
    top = tree.across[-1].select(
        "key", F.col("block").alias("at"), F.array().cast("array<binary>").alias("lefts"), F.array().cast("array<binary>").alias("rights"),
        F.lit("").alias("subroot"), F.lower(F.hex("root")).alias("root"),
    )

    def down(paths: DataFrame, tier: DataFrame) -> DataFrame:
        both = tier.select("key", F.col("block").alias("at"), "n", "tree").join(paths, ["key", "at"])
        return both.mapInArrow(lambda batches: _children(batches, levels, fan), f"key string, at long, {STEP}")

    paths = top
    for tier in reversed(tree.across):
        paths = written(down(paths, tier), "paths")
    named = tree.subroots.select("at", F.col("name").alias("key"), F.lower(F.hex("leaf")).alias("subroot"))
    paths = paths.drop("key", "subroot").join(named, "at").select("key", F.lit(0).cast("long").alias("at"), "lefts", "rights", "subroot", "root")
    for tier in reversed(tree.within[1:]):
        paths = written(down(paths, tier), "paths")
    lowest = tree.within[0].select("key", F.col("block").alias("at"), "n", "tree", "ids", "changed").join(paths, ["key", "at"])
    lowest = lowest.select("at", "n", "tree", "ids", "changed", "lefts", "rights", "subroot", "root")
    return lowest.mapInArrow(
        lambda batches: _proofs(batches, levels, fan),
        "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )


def lower_case(text: Column) -> Column:
    """The text with A to Z in lower case and all else as it is."""
    return F.translate(text, UPPER, LOWER)


def tampered(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text", every: int = 5) -> Column:
    """The digest of a tampered row, one whose text came to lower case; null for rows whose id is not among one in ``every``."""
    columns = [lower_case(F.col(f"`{name}`")) if name == text_col else F.col(f"`{name}`") for name in fields]
    chosen = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % every == 0
    return F.when(chosen, digest(columns))
