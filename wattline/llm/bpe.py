"""Byte-level BPE: encoding by ranks, and decoding, in padded numpy matrices.

Pre-tokens that a worker meets for the first time go, by length, into padded matrices
of byte ranks. In each round every row merges its leftmost pair of minimum rank; the ranks of
pairs are found in an open-addressing hash table held in arrays; the row is then compacted, rows
without a further merge leave the matrix, and the matrix becomes a column narrower.

A long run of bytes is first cut where two neighbouring bytes occur together in no token: no merge
can cross such a place. What is still longer than the widest matrix merges all
places of its minimum pair at once, as long as this is what merging them one by one would give.

Ids are little-endian unsigned 32-bit integers in a binary column. Null text is empty, an empty text
has no ids; repeated rows are encoded alike; no special tokens are recognised.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from wattline.llm.common import give_back, ship, slices, spread_out
from wattline.llm.pieces import ChunkCache, Remembered

NONE = np.int64(1) << 40
EMPTY = np.int64(-1)
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 128, 256)
#: The tokenizer's white space; the pattern's \s means this.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CELLS = 200_000
#: Bytes of text that are encoded together.
AT_ONCE = 250_000
#: Bytes of a generation of remembered pre-tokens and of remembered chunks in one worker.
PIECES, CHUNKS = 8 << 20, 12 << 20


class PairTable:
    """From two ranks to the rank of their merge, in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(len(ranks) * 3).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        keys = self._keys(left, right)
        slots = self._slots(keys)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slots[rest]] == EMPTY]
            self.keys[slots[free]] = keys[free]  # of several for one slot, the last one stays
            placed = self.keys[slots[rest]] == keys[rest]
            self.ranks[slots[rest[placed]]] = ranks[rest[placed]]
            rest = rest[~placed]
            slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merges, NONE where there is none; a negative rank is padding."""
        keys = self._keys(left, right)
        slots = self._slots(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.ranks[slots], NONE)
        rest = np.flatnonzero((there != keys) & (there != EMPTY))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[rest]]
            hit = there == keys[rest]
            found[rest[hit]] = self.ranks[slots[rest[hit]]]
            rest = rest[~hit & (there != EMPTY)]
        found[(left < 0) | (right < 0)] = NONE
        return found


class Bpe:
    """A vocabulary of byte strings and ranks."""

    def __init__(self, file: bytes, pattern: str):
        pairs = (line.split() for line in file.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        for short, plain in ((r"[^\s", f"[^{WHITE}"), (r"\S", f"[^{WHITE}]"), (r"\s", f"[{WHITE}]")):
            pattern = pattern.replace(short, plain)
        self.pattern = regex.compile(pattern)
        size = max(self.rank.values()) + 1
        tokens = [b""] * size
        for token, rank in self.rank.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int64, size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.single = np.array([self.rank[bytes([byte])] for byte in range(256)], np.int64)
        # Straight into an array: a list of all merges would hold several times as much while the vocabulary loads.
        merges = (
            number
            for token, rank in self.rank.items()
            for cut in range(1, len(token))
            if token[:cut] in self.rank and token[cut:] in self.rank
            for number in (self.rank[token[:cut]], self.rank[token[cut:]], rank)
        )
        self.pairs = PairTable(*np.fromiter(merges, np.int64).reshape(-1, 3).T)
        inside = np.ones(len(self.bytes), bool)
        inside[self.starts[self.lengths > 0]] = False
        self.together = np.zeros(65536, bool)
        at = np.flatnonzero(inside)
        self.together[self.bytes[at - 1].astype(np.int64) << 8 | self.bytes[at]] = True
        self.cache, self.known = ChunkCache(self.encode_strings, CHUNKS), Remembered(self.encode_pieces, PIECES)

    def encode_strings(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings that are cut by the pattern, one string after another, and their numbers.

        Strings whose only space is their first character, before one that is no white space, are cut together: the
        pattern cuts before each of these spaces and nowhere else puts one first, so a piece that begins with a space begins a string.
        """
        plain = np.fromiter((text[:1] == " " and bool(text[1:2].strip()) and text.count(" ") == 1 for text in strings), bool, len(strings))
        together = self.pattern.findall("".join([text for text, is_plain in zip(strings, plain.tolist()) if is_plain]))
        apart = [self.pattern.findall(text) for text, is_plain in zip(strings, plain.tolist()) if not is_plain]
        opens = np.fromiter((piece[0] == " " for piece in together), bool, len(together))
        sizes = np.empty(len(strings), np.int64)
        sizes[plain] = np.diff(np.append(np.flatnonzero(opens), len(together)))
        sizes[~plain] = [len(pieces) for pieces in apart]
        self.known.turn()
        codes, starts = np.empty(int(sizes.sum()), np.int64), np.cumsum(sizes) - sizes
        codes[spread_out(starts[plain], sizes[plain])] = self.known.codes(together)
        codes[spread_out(starts[~plain], sizes[~plain])] = self.known.codes([piece for pieces in apart for piece in pieces])
        ids, counts = self.known.young.get(codes)
        ends = np.concatenate(([0], np.cumsum(counts)))
        last = np.cumsum(sizes)
        return ids, ends[last] - ends[last - sizes]

    def encode_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole pre-tokens."""
        pieces = [text.encode() for text in texts]
        whole = np.fromiter((self.rank.get(piece, -1) for piece in pieces), np.int64, len(pieces))
        counts = np.where(whole >= 0, 1, 0)
        todo = np.flatnonzero(whole < 0)
        raw = np.frombuffer(b"".join(pieces[i] for i in todo), np.uint8)
        lengths = np.fromiter((len(pieces[i]) for i in todo), np.int64, len(todo))
        owner = np.repeat(np.arange(len(todo)), lengths)
        # Runs that no merge leaves: cut between pieces, and where no token has both bytes.
        first = np.ones(len(raw), bool)
        if len(raw):
            first[1:] = (owner[1:] != owner[:-1]) | ~self.together[raw[:-1].astype(np.int64) << 8 | raw[1:]]
        run_at = np.flatnonzero(first)
        run_length = np.diff(np.append(run_at, len(raw)))
        merged, sizes = self._merge_runs(self.single[raw], run_at, run_length)
        np.add.at(counts, todo[owner[run_at]], sizes)
        ids = np.empty(int(counts.sum()), np.int64)
        starts = np.cumsum(counts) - counts
        done = whole >= 0
        ids[starts[done]] = whole[done]
        ids[spread_out(starts[todo], counts[todo])] = merged
        return ids, counts

    def _merge_runs(self, ranks: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.ones(len(at), np.int64)
        results: list[tuple[np.ndarray, np.ndarray]] = []  # places and rows
        alone = length == 1
        low = 1
        for width in WIDTHS:
            members = np.flatnonzero((length > low) & (length <= width))
            low = width
            for block in range(0, len(members), max(1, CELLS // width)):
                rows = members[block : block + max(1, CELLS // width)]
                for who, ids in self._merge_matrix(ranks, at[rows], length[rows], width):
                    sizes[rows[who]] = (ids >= 0).sum(axis=1)
                    results.append((rows[who], ids))
        long = [(i, self._merge_long(ranks[at[i] : at[i] + length[i]])) for i in np.flatnonzero(length > WIDTHS[-1])]
        for i, ids in long:
            sizes[i] = len(ids)
        merged = np.empty(int(sizes.sum()), np.int64)
        starts = np.cumsum(sizes) - sizes
        merged[starts[alone]] = ranks[at[alone]]
        for rows, ids in results:
            place = starts[rows][:, None] + np.arange(ids.shape[1])
            there = ids >= 0
            merged[place[there]] = ids[there]
        for i, ids in long:
            merged[starts[i] : starts[i] + len(ids)] = ids
        return merged, sizes

    def _merge_matrix(self, ranks, at, length, width):
        """Rows that are done, with their ids padded by -1."""
        columns = np.arange(width)
        inside = columns < length[:, None]
        ids = np.where(inside, ranks[np.minimum(at[:, None] + columns, len(ranks) - 1)], -1)
        pair = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width - 1)
        who = np.arange(len(ids))
        while len(ids):
            best = pair.argmin(axis=1)
            rows = np.arange(len(ids))
            rank = pair[rows, best]
            done = rank == NONE
            if done.any():
                yield who[done], ids[done]
                ids, pair, who, best, rank = ids[~done], pair[~done], who[~done], best[~done], rank[~done]
                rows = np.arange(len(ids))
            if not len(ids) or ids.shape[1] < 2:
                continue
            # Compaction: what stands right of the merged pair moves one to the left.
            columns = np.arange(ids.shape[1] - 1)
            right = columns > best[:, None]
            ids = np.where(right, ids[:, 1:], ids[:, :-1])
            ids[rows, best] = rank
            if ids.shape[1] == 1:
                yield who, ids
                return
            pair = np.where(right[:, :-1], pair[:, 1:], pair[:, :-1])
            inner = np.flatnonzero(best < ids.shape[1] - 1)
            pair[inner, best[inner]] = self.pairs.find(rank[inner], ids[inner, best[inner] + 1])
            inner = np.flatnonzero(best > 0)
            pair[inner, best[inner] - 1] = self.pairs.find(ids[inner, best[inner] - 1], rank[inner])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        while len(ids) > 1:
            pair = self.pairs.find(ids[:-1], ids[1:])
            rank = pair.min()
            if rank == NONE:
                break
            at = np.flatnonzero(pair == rank)
            # Of places that overlap, every second one from the left.
            start = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            run = np.repeat(start, np.diff(np.append(start, len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            both = self._merged_at(ids, at, rank)
            # All at once equals one by one unless a merge makes a pair of lower rank.
            after = np.flatnonzero(both == rank)
            near = np.concatenate((after[after < len(both) - 1], after[after > 0] - 1))
            next_to = at[at + 2 < len(ids)]
            lower = (self.pairs.find(both[near], both[near + 1]) < rank).any() or (
                self.pairs.find(np.full(len(next_to), rank), ids[next_to + 2]) < rank
            ).any()
            ids = self._merged_at(ids, at[:1], rank) if lower else both
        return ids

    @staticmethod
    def _merged_at(ids: np.ndarray, at: np.ndarray, rank: np.int64) -> np.ndarray:
        ids = ids.copy()
        ids[at] = rank
        return np.delete(ids, at + 1)

    def encode_texts(self, texts: pa.Array) -> pa.Array:
        """Texts as ids: little-endian unsigned 32-bit integers."""
        sizes, made, counts = pc.fill_null(pc.binary_length(texts), 0).to_pylist(), [], []
        for part in slices(sizes, AT_ONCE):
            some = texts.slice(part.start, part.stop - part.start).to_pylist()
            for ids, numbers in self.cache.texts([text or "" for text in some]):
                made.append(ids.astype("<u4"))
                counts.append(numbers)
        return _binary(made, 4 * np.concatenate([np.zeros(0, np.int64), *counts]))

    def decode_rows(self, rows: pa.Array) -> pa.Array:
        """Ids as the bytes of their tokens."""
        sizes, made, counts = pc.fill_null(pc.binary_length(rows), 0).to_pylist(), [], []
        for part in slices(sizes, 4 * AT_ONCE):
            some = [row or b"" for row in rows.slice(part.start, part.stop - part.start).to_pylist()]
            ids = np.frombuffer(b"".join(some), "<u4").astype(np.int64)
            lengths = self.lengths[ids]
            made.append(self.bytes[spread_out(self.starts[ids], lengths)])
            ends = np.concatenate(([0], np.cumsum(lengths)))
            last = np.cumsum([len(row) // 4 for row in some])
            counts.append(np.diff(ends[np.concatenate(([0], last))]))
        return _binary(made, np.concatenate([np.zeros(0, np.int64), *counts]))


def _binary(parts: list[np.ndarray], sizes: np.ndarray) -> pa.Array:
    """A column of byte strings of the given sizes, cut from all parts together."""
    raw = np.concatenate([np.zeros(0, np.uint8), *(part.view(np.uint8) for part in parts)])
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    long = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return long.cast(pa.binary())


_LOADED: dict[tuple[str, str], Bpe] = {}


def loaded(file: bytes, pattern: str) -> Bpe:
    """The vocabulary, prepared once in each worker."""
    key = (hashlib.sha256(file).hexdigest(), pattern)
    if key not in _LOADED:
        _LOADED[key] = Bpe(file, pattern)
        give_back()
    return _LOADED[key]


def _mapped(docs: DataFrame, path: str, pattern: str, made: list[str], kept: list[int], rows) -> DataFrame:
    """The kept columns of ``docs`` and, behind them, binary columns ``made`` by ``rows`` from slices of a batch.

    The rank file (under 1 MB) is broadcast. What is made leaves the worker slice by slice, so
    a worker never holds the ids of a whole batch.
    """
    ship(docs.sparkSession)
    with open(path, "rb") as source:
        file = docs.sparkSession.sparkContext.broadcast(source.read())
    fields = [docs.schema.fields[i] for i in kept] + [StructField(name, BinaryType()) for name in made]
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = loaded(file.value, pattern)
        for batch in batches:
            for some, new in rows(vocabulary, batch):
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in kept), *new], names)
            give_back()
        vocabulary.cache.rest()
        vocabulary.known.rest()
        give_back()

    return docs.mapInArrow(run, StructType(fields))


def _kept(docs: DataFrame, names: list[str]) -> list[int]:
    taken = {name.lower() for name in names}
    return [i for i, name in enumerate(docs.columns) if name.lower() not in taken]


def _sliced(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for part in slices(sizes, most):
        yield batch.slice(part.start, part.stop - part.start)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", drop_text: bool = False) -> DataFrame:
    """The documents with their ids; a column of that name is replaced. The text need not be carried along."""
    text = docs.columns.index(text_col)

    def rows(vocabulary: Bpe, batch: pa.RecordBatch):
        for some in _sliced(batch, text, AT_ONCE):
            yield some, [vocabulary.encode_texts(some.column(text))]

    return _mapped(docs, path, pattern, [ids_col], _kept(docs, [ids_col, *([text_col] if drop_text else [])]), rows)


def decode(docs: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """The documents with the bytes that their ids stand for; a column of that name is replaced."""
    ids = docs.columns.index(ids_col)

    def rows(vocabulary: Bpe, batch: pa.RecordBatch):
        for some in _sliced(batch, ids, 4 * AT_ONCE):
            yield some, [vocabulary.decode_rows(some.column(ids))]

    return _mapped(docs, path, pattern, [bytes_col], _kept(docs, [bytes_col]), rows)


def encode_and_decode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", bytes_col: str = "decoded"
) -> DataFrame:
    """The documents without their text, with its ids and the bytes decoded from these, in one pass."""
    text = docs.columns.index(text_col)

    def rows(vocabulary: Bpe, batch: pa.RecordBatch):
        for some in _sliced(batch, text, AT_ONCE):
            ids = vocabulary.encode_texts(some.column(text))
            yield some, [ids, vocabulary.decode_rows(ids)]

    return _mapped(docs, path, pattern, [ids_col, bytes_col], _kept(docs, [text_col, ids_col, bytes_col]), rows)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
