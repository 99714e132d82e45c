"""Token ids in files of Simple-8b blocks, in ascending id order.

Documents are range-partitioned and sorted by id. Each task encodes its range with the
tokenizers library, appends the end id to every document and packs whole documents into blocks of at
least ``BLOCK_IDS`` ids. A block is a row of a Parquet file: its place (``part``, ``block``), the
documents' ids and numbers of token ids, their sum, and the packed token ids, see ``simple8b``.
Spark writes the files, so they go to any store and survive lost tasks, and reads them back
block by block. A document is never split; a task holds one block at a time.

Texts are cut at spaces where the tokenizer's own pattern always cuts, and each worker remembers the ids of
the chunks it has met, so the library sees each of them once.

Added tokens, such as ``<|endoftext|>``, are found in texts as the library finds them: a text is cut around them first.

Defined results: null text is empty and gets the end id alone; rows without id come first; rows that repeat
an id stand together, in an order given by their texts, and are each kept; without rows there are no files to read.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import ship, slices, spread_out, text_of
from wattline.llm.pieces import AT_ONCE, ChunkCache
from wattline.llm.simple8b import pack, unpack

BLOCK_IDS = 1 << 18
#: Chunks given to the library as one string, and bytes of each generation of remembered chunks.
JOINED, REMEMBERED = 10_000, 170 << 20
BLOCK = "part int, block int, doc_ids array<long>, counts array<long>, n_ids long, packed binary"

_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The library's tokenizer behind a cache of chunks."""

    def __init__(self, vocabulary: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        space = self.tokenizer.encode(" a", add_special_tokens=False).tokens[0][0]
        pieces = sorted(self.tokenizer.get_vocab(with_added_tokens=True).items(), key=lambda item: item[1])
        self.opens = np.zeros(pieces[-1][1] + 1, bool)
        self.opens[[number for piece, number in pieces if piece.startswith(space)]] = True
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile("(" + "|".join(re.escape(token.content) for token in sorted(added, key=lambda token: -len(token.content))) + ")")
        self.added = self.added if added else None
        # A token that takes white space or whole words only, or is found in normalized text, is left to the library with all its text.
        self.plain = self.tokenizer.normalizer is None and not any(token.lstrip or token.rstrip or token.single_word for token in added)
        self.joined = JOINED if not any(" " in token.content for token in added) else 1
        self.cache = ChunkCache(self.encode, REMEMBERED)

    def encode(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks whose only space is their first character, before one that is no white space, go to the library many at a
        time: it cuts before each of these spaces, so a token that opens with a space opens a chunk."""
        plain = np.fromiter((text[:1] == " " and bool(text[1:2].strip()) and text.count(" ") == 1 for text in strings), bool, len(strings))
        chunks = [text for text, is_plain in zip(strings, plain.tolist()) if is_plain]
        joined = ["".join(chunks[i : i + self.joined]) for i in range(0, len(chunks), self.joined)]
        apart = [text for text, is_plain in zip(strings, plain.tolist()) if not is_plain]
        found = [np.array(made.ids, np.int64) for made in self.tokenizer.encode_batch_fast(joined + apart, add_special_tokens=False)]
        together = np.concatenate([np.zeros(0, np.int64), *found[: len(joined)]])
        counts = np.empty(len(strings), np.int64)
        counts[plain] = np.diff(np.append(np.flatnonzero(self.opens[together]), len(together)))
        counts[~plain] = [len(ids) for ids in found[len(joined) :]]
        ids, starts = np.empty(int(counts.sum()), np.int64), np.cumsum(counts) - counts
        ids[spread_out(starts[plain], counts[plain])] = together
        rest = np.concatenate([np.zeros(0, np.int64), *found[len(joined) :]])
        ids[spread_out(starts[~plain], counts[~plain])] = rest
        return ids, counts

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For consecutive parts of the texts: all ids, one after another, and the number of each text."""
        if self.added is None or not any(map(self.added.search, texts)):
            yield from self.cache.texts(texts)
        elif self.plain:
            cut = [self.added.split(text) for text in texts]
            made = list(self.cache.texts([piece for pieces in cut for piece in pieces]))
            counts, last = np.concatenate([counts for _, counts in made]), np.cumsum([len(pieces) for pieces in cut])
            yield np.concatenate([ids for ids, _ in made]), np.add.reduceat(counts, np.append(0, last[:-1]))
        else:
            made = [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64) for text in texts]
            yield np.concatenate(made), np.array([len(ids) for ids in made])


def _encoder(vocabulary: bytes) -> Encoder:
    """Prepared once in each worker."""
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _blocks(batches: Iterator[pa.RecordBatch], vocabulary: bytes, end_id: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    encoder, part, block = _encoder(vocabulary), TaskContext.get().partitionId(), 0
    docs: list[int | None] = []
    counts: list[np.ndarray] = []
    ids: list[np.ndarray] = []
    held = 0

    def packed() -> pa.RecordBatch:
        numbers, sizes = np.concatenate(ids), np.concatenate(counts)
        columns = [
            pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([docs], pa.list_(pa.int64())),
            pa.array([sizes], pa.list_(pa.int64())), pa.array([len(numbers)], pa.int64()), pa.array([pack(numbers)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["part", "block", "doc_ids", "counts", "n_ids", "packed"])

    for batch in batches:
        names, texts = batch.column(0).to_pylist(), batch.column(1)
        sizes = pc.binary_length(texts).to_pylist()
        for rows in slices(sizes, AT_ONCE):
            start = rows.start
            for found, numbers in encoder.texts(texts.slice(rows.start, rows.stop - rows.start).to_pylist()):
                ends = np.cumsum(numbers)
                ids.append(np.insert(found, ends, end_id))
                counts.append(numbers + 1)
                docs += names[start : start + len(numbers)]
                start += len(numbers)
                held += len(ids[-1])
                if held >= block_ids:
                    yield packed()
                    block, held = block + 1, 0
                    docs, counts, ids = [], [], []
    if docs:
        yield packed()


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """The token ids of all documents, below ``folder``; the vocabulary (under 2 MB) is broadcast."""
    ship(docs.sparkSession)
    with open(vocabulary_path, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    # Rows without id, or of one id, are dealt out by their texts.
    order = ["id", F.xxhash64("text")]
    texts.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda batches: _blocks(batches, vocabulary.value, end_id, block_ids), BLOCK
    ).write.parquet(folder)


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCK).parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch], crc: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part, block, docs, counts, packed = (batch.column(i)[row].as_py() for i in range(5))
            ids, sizes = unpack(packed).astype("<u4"), np.array(counts, np.int64)
            ends = np.cumsum(sizes)
            raw = ids.tobytes()
            cut = [raw[4 * (end - size) : 4 * end] for end, size in zip(ends.tolist(), sizes.tolist())]
            value = pa.array([zlib.crc32(x) for x in cut], pa.int64()) if crc else pa.array(cut, pa.binary())
            columns = [
                pa.array([part] * len(docs), pa.int32()), pa.array([block] * len(docs), pa.int32()),
                pa.array(docs, pa.int64()), pa.array(ends - sizes), pa.array(sizes), value,
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "block", "doc_id", "at", "n_tokens", "ids_crc32" if crc else "token_ids"])


def read_tokens(spark: SparkSession, folder: str, crc: bool = False) -> DataFrame:
    """The documents in the files: doc_id, ``start`` (ids of all documents before it), n_tokens, and either
    ``token_ids`` (little-endian unsigned 32-bit integers) or their ``ids_crc32``."""
    ship(spark)
    blocks = read_blocks(spark, folder)
    value = "ids_crc32 long" if crc else "token_ids binary"
    docs = blocks.select("part", "block", "doc_ids", "counts", "packed").mapInArrow(
        lambda batches: _documents(batches, crc), f"part int, block int, doc_id long, at long, n_tokens long, {value}"
    )
    # Ids before a part, from one row for each part; before a block, within its part.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = parts.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before_part"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    starts = blocks.select("part", "block", within.alias("before_block")).join(parts, "part")
    start = (F.col("before_part") + F.col("before_block") + F.col("at")).alias("start")
    return docs.join(starts, ["part", "block"]).select("doc_id", start, "n_tokens", value.split()[0])
