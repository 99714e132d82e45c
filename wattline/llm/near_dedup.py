"""Near-duplicates by Order MinHash and banded alignment.

The words of a text (lower case, cut at white space) form k-mers of ``WORDS`` words, each labelled with
how often it occurred before. For each of ``SKETCHES`` hash functions the sketch holds
the ``ORDER`` labelled k-mers with the smallest hashes, in the order in which they stand in the
text; two texts agree in a sketch with a probability that follows their edit similarity.

Texts with the same words are one to begin with. The others meet in buckets, one for each
sketch. A bucket is not compared pair by pair: all buckets are range-partitioned in one order, by sketch,
then by the next sketch, then by length, so that a bucket of any size is spread over tasks, and each text is
compared with its neighbour. In a group of copies that chains the members; in a bucket filled by
a common passage, texts that agree elsewhere too come to stand together; and each of the
sketches gives another order. First the pairs of a few sketches are aligned, then, of the
pairs of all others, those whose texts are not yet connected. What then still shares a bucket without being
connected is compared each with each, in blocks of bounded size that are dealt over tasks: counts of
hashed words refuse most of these pairs, never one within the edits allowed, and the others are aligned within
the block, unless links found there connect them already. So no
pair of texts that share a bucket is lost, and no more links leave a block than it has texts. A pair is a link if its edit
similarity (1 - word edits / words of the longer text) is ``LEAST`` or more, decided exactly; a
document's class is the smallest id it is connected with.

Defined results: a null text is empty; all texts without words are one class; texts of fewer
than ``WORDS`` words are one k-mer; rows that repeat an id are one document if their words are the same, else one each; a row without
id is never compared, its class is that of its words, and it always stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wattline.llm.alignment import encoded, similar
from wattline.llm.common import fresh, give_back, possibly_in, ship, slices, text_of, written
from wattline.llm.graph import stars

WORDS, ORDER, SKETCHES, EARLY, LEAST = 5, 2, 96, 4, 0.8
#: Numbers in a matrix of hashes, and characters aligned together.
CELLS, AT_ONCE = 500_000, 500_000
#: Bins of the counts of words, and rows and words of a crowded bucket that form a block.
BINS, BLOCK, BLOCK_WORDS = 128, 2048, 1_000_000
#: Hashes of words that are kept between texts.
KNOWN = 100_000
MIX = np.uint64(0x9E3779B97F4A7C15)
SEEDS = np.random.default_rng(20250101).integers(0, 1 << 63, (2, 1024), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def sketch(hashes: np.ndarray, words: int, order: int, sketches: int) -> np.ndarray:
    """Order MinHash of a sequence of word hashes."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    count = max(1, len(hashes) - words + 1)
    kmer = np.zeros(count, np.uint64)
    for i in range(min(words, len(hashes))):
        kmer = _mixed(kmer * np.uint64(3) + hashes[i : i + count])
    # The label of a k-mer: how many equal ones stand before it.
    by_value = np.argsort(kmer, kind="stable")
    new = np.ones(count, bool)
    new[1:] = kmer[by_value[1:]] != kmer[by_value[:-1]]
    if not new.all():
        start = np.flatnonzero(new)
        before = np.empty(count, np.int64)
        before[by_value] = np.arange(count) - np.repeat(start, np.diff(np.append(start, count)))
        kmer = _mixed(kmer + before.astype(np.uint64) * MIX)
    taken = min(order, count)
    result = np.empty(sketches, np.uint64)
    step = max(1, CELLS // count)
    for low in range(0, sketches, step):
        some = np.arange(low, min(sketches, low + step))
        hashed = (kmer ^ SEEDS[0, some][:, None]) * SEEDS[1, some][:, None]
        rows, places = np.arange(len(some)), np.empty((len(some), taken), np.int64)
        for i in range(taken):
            places[:, i] = hashed.argmin(axis=1)
            hashed[rows, places[:, i]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        value = some.astype(np.uint64)
        for column in np.sort(places, axis=1).T:
            value = _mixed(value * np.uint64(5) + kmer[column])
        result[some] = value
    return result


def _sketched(texts: pd.Series, words: int, order: int, sketches: int) -> pd.DataFrame:
    known: dict[str, int] = {}
    rows = []
    for text in texts:
        found = words_of(text)
        if len(known) > KNOWN:
            known.clear()
        for word in set(found).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        key = hashlib.blake2b(" ".join(found).encode("utf-8", "replace"), digest_size=16).digest()
        bins = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % BINS, minlength=BINS)
        counts = np.minimum(bins, 0xFFFF).astype("<u2").tobytes()
        rows.append((key, len(found), counts, sketch(hashes, words, order, sketches).view(np.int64)))
    return pd.DataFrame(rows, columns=["words", "n_words", "counts", "sketch"])


def _neighbours(frames: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """Pairs of neighbours in a bucket, and the first and last row of the partition (kinds 0, 1, 2).

    Kind 3 are the members of buckets with three texts or more; a bucket that goes on in the next batch or
    partition may be one, so its members are given too.
    """
    part = TaskContext.get().partitionId()
    last: pd.DataFrame | None = None
    for frame in frames:
        if not len(frame):
            continue
        starts = np.flatnonzero(np.diff(frame["bucket"].to_numpy(), prepend=frame["bucket"].iloc[0] ^ 1) != 0)
        counts = np.diff(np.append(starts, len(frame)))
        crowded = counts > 2
        crowded[[0, -1]] = True
        yield _edge(frame[np.repeat(crowded, counts)], part, 3)
        if last is None:
            yield _edge(frame.iloc[:1], part, 1)
        else:
            frame = pd.concat([last, frame], ignore_index=True)
        last = frame.iloc[-1:]
        bucket, ids, size = (frame[name].to_numpy() for name in ("bucket", "id", "n_words"))
        near = (bucket[1:] == bucket[:-1]) & (ids[1:] != ids[:-1])
        near &= np.minimum(size[1:], size[:-1]) >= least * np.maximum(size[1:], size[:-1]) - 1e-9
        at = np.flatnonzero(near)
        yield pd.DataFrame(
            {
                "part": part,
                "kind": 0,
                "bucket": bucket[at],
                "a": np.minimum(ids[at], ids[at + 1]),
                "b": np.maximum(ids[at], ids[at + 1]),
                "early": frame["early"].to_numpy()[at],
            }
        )
    if last is not None:
        yield _edge(last, part, 2)


def _edge(row: pd.DataFrame, part: int, kind: int) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "part": part, "kind": kind, "bucket": row["bucket"].to_numpy(),
            "a": row["id"].to_numpy(), "b": row["id"].to_numpy(), "early": row["early"].to_numpy(),
        }
    )


def candidates(distinct: DataFrame, early: int = EARLY, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a < b`` of ids that stand together in a bucket; ``early`` if in one of the first sketches.

    Beside them, as ``bucket`` and ``id``, the members of all buckets with three texts or more: ``others`` compares
    those that are no neighbours.

    ``distinct`` has id, n_words and sketch, one row for each different text.
    """
    size = F.size("sketch")
    following = F.get("sketch", (F.col("at") + 1) % size)
    rows = distinct.select("id", "n_words", "sketch", F.posexplode("sketch").alias("at", "bucket")).select(
        "bucket", following.alias("next"), "n_words", "id", (F.col("at") < early).alias("early")
    )
    order = ["bucket", "next", "n_words", "id"]
    found = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(
            lambda frames: _neighbours(frames, least),
            "part int, kind int, bucket long, a long, b long, early boolean",
        ),
        "neighbours",
    )
    # Where a partition ends within a bucket: its last row and the first of the next one.
    across = Window.orderBy("part", "kind")
    ends = found.filter("kind IN (1, 2)").select(
        "*", F.lag("bucket").over(across).alias("bucket_before"), F.lag("a").over(across).alias("before")
    )
    ends = ends.filter("kind = 1 AND bucket = bucket_before AND a <> before").select(
        F.least("a", "before").alias("a"), F.greatest("a", "before").alias("b"), "early"
    )
    pairs = found.filter("kind = 0").select("a", "b", "early").unionByName(ends)
    crowded = found.filter("kind = 3").select("bucket", F.col("a").alias("id"))
    return pairs.groupBy("a", "b").agg(F.max("early").alias("early")), crowded


def _unlike(frames: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """Pairs within the groups of sorted rows whose roots differ and whose counts of words allow them to be similar."""
    held: pd.DataFrame | None = None
    for frame in frames:
        frame = frame if held is None else pd.concat([held, frame], ignore_index=True)
        # The last group may go on in the next batch; a group has about two blocks at most.
        keys = frame[["bucket", "low", "high"]].to_numpy()
        new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        whole = int(new[-1]) if len(new) else 0
        held = frame.iloc[whole:]
        if whole:
            yield from _group_pairs(frame.iloc[:whole], np.append(0, new[:-1]), least)
    if held is not None and len(held):
        yield from _group_pairs(held, np.zeros(1, np.int64), least)


def _group_pairs(frame: pd.DataFrame, starts: np.ndarray, least: float) -> Iterator[pd.DataFrame]:
    sizes = np.diff(np.append(starts, len(frame)))
    # How many rows of its group come after a row.
    after = np.repeat(starts + sizes, sizes) - np.arange(len(frame)) - 1
    ids, roots, words, mine, low, high = (
        frame[name].to_numpy() for name in ("id", "root", "n_words", "mine", "low", "high")
    )
    counts = np.frombuffer(b"".join(frame["counts"]), "<u2").reshape(len(frame), BINS).astype(np.int32)
    # What is connected has one name within its group.
    names = np.unique(np.stack([np.repeat(starts, sizes), roots]), axis=1, return_inverse=True)[1].ravel()
    codes = encoded([words_of(text) for text in frame["text"]]) if "text" in frame else None
    sketches = np.stack(frame["sketch"]) if "sketch" in frame else None
    bucket = frame["bucket"].to_numpy()
    at = np.flatnonzero(after > 0)
    step = 0
    while len(at):
        step += 1
        left, right = at, at + step
        # Two blocks are compared across, a single one with itself.
        open_ = (names[left] != names[right]) & ((low[left] == high[left]) | (mine[left] != mine[right]))
        left, right = left[open_], right[open_]
        longer = np.maximum(words[left], words[right])
        apart = longer - np.minimum(words[left], words[right])
        # An edit changes two counts by one, or one if it changes the length.
        spare = 2 * ((1 - least) * longer + 1e-9).astype(np.int64) - apart
        fits = spare >= apart
        left, right, spare = left[fits], right[fits], spare[fits]
        for i in range(0, len(left), 1024):
            l, r = left[i : i + 1024], right[i : i + 1024]
            near = np.abs(counts[l] - counts[r]).sum(axis=1) <= spare[i : i + 1024]
            l, r = l[near], r[near]
            if sketches is not None and len(l):
                # Texts that share several buckets are compared in the first one.
                first = (sketches[l] == sketches[r]).argmax(axis=1)
                here = sketches[l, first] == bucket[l]
                l, r = l[here], r[here]
            if codes is not None and len(l):
                alike = similar([codes[k] for k in l], [codes[k] for k in r], least)
                l, r = _connecting(names, l[alike], r[alike])
            if len(l):
                a, b = ids[l], ids[r]
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})
        at = at[after[at] > step]


def _connecting(names: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links that connect what no link before them did; ``names`` are changed to say so."""
    needed = np.zeros(len(left), bool)
    for i, (l, r) in enumerate(zip(left.tolist(), right.tolist())):
        a, b = names[l], names[r]
        if a != b:
            needed[i] = True
            names[names == b] = a
    return left[needed], right[needed]


def others(
    crowded: DataFrame,
    roots: DataFrame,
    distinct: DataFrame,
    least: float = LEAST,
    block: int = BLOCK,
    texts: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Pairs ``a < b`` of texts that share a bucket, are not connected and may be similar.

    ``roots`` has id and root of connected texts, ``distinct`` id, n_words and counts. A bucket of any
    size is cut into blocks by hashes of ids; each pair of blocks is a group of its own.

    ``texts`` gives id and text for a frame of ids. With it the pairs of a group are aligned there, and of the similar
    ones only those come that connect something: fewer than the group has rows, however many pairs it has. If ``distinct``
    has the sketches, each pair is compared in the first bucket that its texts share, and in no other. Were that one not crowded,
    the two would be neighbours in it, and compared already.
    """
    members = written(
        crowded.distinct().join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "crowded"
    )
    mixed = members.groupBy("bucket").agg(F.min("root").alias("least_root"), F.max("root").alias("last_root"))
    mixed = mixed.filter("least_root <> last_root").select("bucket")
    kept = ["counts", *(["sketch"] if "sketch" in distinct.columns else [])]
    sizes = distinct.select("id", "n_words", *kept).dropDuplicates(["id"])
    inside = written(members.join(mixed, "bucket").join(sizes.select("id", "n_words"), "id"), "mixed")
    placed = inside.join(sizes.drop("n_words"), "id")
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("n_words") / BLOCK_WORDS)).cast("int")
    if texts is not None:
        own = texts(inside.select("id").distinct()).dropDuplicates(["id"])
        placed, kept = placed.join(own, "id"), [*kept, "text"]
    dealt = (
        placed.join(inside.groupBy("bucket").agg(blocks.alias("blocks")), "bucket")
        .withColumn("mine", F.expr("CAST(pmod(xxhash64(id), blocks) AS INT)"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("mine", "other").cast("long").alias("low"), F.greatest("mine", "other").cast("long").alias("high"),
            F.col("mine").cast("long").alias("mine"), "id", "root", "n_words", *kept,
        )
    )
    by = ["bucket", "low", "high"]
    found = dealt.repartition(*by).sortWithinPartitions(*by).mapInPandas(lambda frames: _unlike(frames, least), "a long, b long")
    return found.distinct()


def linked(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are similar; ``texts`` has id and text."""
    ship(pairs.sparkSession)

    @pandas_udf("boolean")
    def aligned(left: pd.Series, right: pd.Series) -> pd.Series:
        found = [np.zeros(0, bool)]
        for part in slices([len(a) + len(b) for a, b in zip(left, right)], AT_ONCE):
            codes = encoded([words_of(text) for text in (*left[part], *right[part])])
            half = len(codes) // 2
            found.append(similar(codes[:half], codes[half:], least))
        give_back()
        return pd.Series(np.concatenate(found))

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left_text"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right_text"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.filter(aligned("left_text", "right_text")).select("a", "b")


def _placed(
    docs: DataFrame, id_col: str, text_col: str, words: int, order: int, sketches: int, early: int, least: float
) -> DataFrame:
    """One row per row of ``docs``: id, ``key`` (of its text), ``class_id``, ``copy_of`` and whether it stays."""
    ship(docs.sparkSession)

    @pandas_udf("words binary, n_words int, counts binary, sketch array<long>")
    def sketched(texts: pd.Series) -> pd.DataFrame:
        found = _sketched(texts, words, order, sketches)
        give_back()
        return found

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    digest = written(texts.select("id", text_key(F.col("text")).alias("key"), sketched("text").alias("made")).select("id", "key", "made.*"), "sketches")
    # An id that comes with different texts stands for several nodes, named by the text; any other id is its own node.
    again = written(digest.filter("id IS NOT NULL").groupBy("id").agg((F.min("words") != F.max("words")).alias("again")).filter("again"), "again")

    def noded(rows: DataFrame, key: str) -> DataFrame:
        node = F.when(F.coalesce("again", F.lit(False)), F.expr(f"xxhash64(id, {key})")).otherwise(F.col("id"))
        return rows.join(again, "id", "left").withColumn("node", node).drop("again")

    digest = noded(digest, "key")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "node"))).alias("first")
    copies = written(digest.groupBy("words").agg(first).select("words", "first.*"), "copies")
    # Rows that repeat id and words are one; any of them tells the sketch.
    distinct = digest.join(copies.select("words", F.col("node").alias("first_node")), "words").filter("node = first_node")
    nodes = distinct.select(F.col("node").alias("id"), "n_words", "counts", "sketch")
    pairs, crowded = candidates(nodes.select("id", "n_words", "sketch"), early, least)
    pairs = written(pairs, "pairs")
    in_pairs = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    named_texts = noded(texts.filter("id IS NOT NULL"), "unhex(md5(text))")

    def texts_in(ids: DataFrame) -> DataFrame:
        return written(possibly_in(named_texts.select(F.col("node").alias("id"), "text"), ids, "id"), "compared")

    compared = texts_in(in_pairs)
    begun = stars(linked(pairs.filter("early"), compared, least))
    root = {side: begun.select(F.col("id").alias(side), F.col("root").alias(f"root_{side}")) for side in "ab"}
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    rest = pairs.filter("NOT early").join(root["a"], "a", "left").join(root["b"], "b", "left").filter(apart)
    links = linked(rest, compared, least).union(begun.select("id", "root"))
    roots = stars(links)
    # Texts that share a bucket without being neighbours or connected.
    more = written(others(crowded, roots, nodes, least, texts=texts_in), "others")
    if not more.isEmpty():
        roots = stars(more.union(roots.select("id", "root")))
    roots = roots.select(F.col("id").alias("node"), "root")
    # The smallest id of a class, and the node that it stands for.
    rooted = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    heads = rooted.join(copies, "node").groupBy(F.col("root").alias("of")).agg(F.min(F.struct("id", "node")).alias("head"))
    named = copies.join(roots, "node", "left").join(heads, F.coalesce("root", "node") == F.col("of"), "left").select(
        "words", F.col("id").alias("copy_of"), F.coalesce("head.id", "id").alias("class_id"), F.coalesce("head.node", "node").alias("stays")
    )
    return digest.join(named, "words").select("id", "key", "class_id", "copy_of", (F.col("node") == F.col("stays")).alias("kept"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    order: int = ORDER,
    sketches: int = SKETCHES,
    early: int = EARLY,
    least: float = LEAST,
) -> DataFrame:
    """One row per document: id, ``class_id`` (the smallest id of its class) and ``copy_of``.

    ``copy_of`` is the smallest id with the same words. A class joins what is linked directly or
    through others.
    """
    placed = _placed(docs, id_col, text_col, words, order, sketches, early, least)
    return placed.select(F.col("id").alias(id_col), "class_id", "copy_of")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    order: int = ORDER,
    sketches: int = SKETCHES,
    early: int = EARLY,
    least: float = LEAST,
) -> DataFrame:
    """The documents with the one of smallest id for each class; columns as they came.

    Rows are chosen by id and text: where an id comes with different texts, one may go and another stay.
    """
    placed = _placed(docs, id_col, text_col, words, order, sketches, early, least)
    gone = [fresh(docs, name) for name in ("dropped_id", "dropped_key")]
    dropped = placed.filter("NOT kept").select(F.col("id").alias(gone[0]), F.col("key").alias(gone[1])).distinct()
    same = (docs[id_col].cast("long") == dropped[gone[0]]) & (text_key(text_of(text_col)) == dropped[gone[1]])
    return docs.join(dropped, same, "left_anti")
