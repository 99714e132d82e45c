"""Splitting texts into chunks that a byte-level tokenizer treats one by one, with a cache.

A space before a character that is no white space always starts a new pre-token, so a text
may be cut there before the tokenizer's own pattern is applied. Chunks repeat often; each
worker keeps the ids of those it has met, in two generations: when the younger one is full it becomes the
older one, and what is met again moves to the new one, so frequent chunks stay.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np

from wattline.llm.common import slices, spread_out

#: A space that is not a boundary. Python knows a few more white space characters than
#: the tokenizers do, which only leaves some chunks longer.
LOOSE = re.compile(r" (?!\S)")
BOUNDARY = re.compile(r" (?=\S)")
#: Characters handled at once, and bytes (of chunks' texts, ids and tables, estimated) of a generation in one worker.
AT_ONCE, REMEMBERED = 500_000, 24 << 20
#: What a chunk costs beside its characters and ids: a string, its place in a dictionary, two numbers.
ENTRY = 170


def space_chunks(text: str) -> list[str]:
    """The chunks of a text; all but the first had a space before them."""
    return BOUNDARY.split(text) if LOOSE.search(text) else text.split(" ")


class Generation:
    """Ids of chunks, one after another, in arrays that double when they are full."""

    def __init__(self):
        self.codes: dict[str, int] = {}
        self.ids = np.zeros(1 << 12, np.int32)
        self.starts = np.zeros(1 << 10, np.int64)
        self.counts = np.zeros(1 << 10, np.int32)
        self.n_ids = self.size = 0

    def add(self, keys: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        """New keys with all their ids and the number of each."""
        n, last = len(self.codes), len(self.codes) + len(keys)
        self.ids = self._room(self.ids, self.n_ids + len(ids))
        self.starts, self.counts = self._room(self.starts, last), self._room(self.counts, last)
        self.codes.update(zip(keys, range(n, last)))
        self.starts[n:last] = self.n_ids + np.cumsum(counts) - counts
        self.counts[n:last] = counts
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self.size += ENTRY * len(keys) + sum(map(len, keys)) + 4 * len(ids)

    def get(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[codes].astype(np.int64)
        return self.ids[spread_out(self.starts[codes], counts)], counts

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        larger = np.zeros(max(size, 2 * len(array)), array.dtype)
        larger[: len(array)] = array
        return larger


class Remembered:
    """Ids of strings that were met lately; ``encode`` takes new strings and returns all their ids and the number of each."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], remembered: int):
        self.encode, self.remembered = encode, remembered
        self.young, self.old = Generation(), Generation()

    def turn(self) -> None:
        """Begin a new generation if this one is full. Codes of before are no longer valid."""
        if self.young.size > self.remembered:
            self.young, self.old = Generation(), self.young

    def rest(self) -> None:
        """Give up the older generation, for a worker that may be used for something else next."""
        self.old = Generation()

    def codes(self, keys: list[str], string: Callable[[str], str] | None = None) -> np.ndarray:
        """The young generation's codes of strings; ``string`` gives what a key stands for."""
        codes = np.fromiter(map(self.young.codes.get, keys, repeat(-1)), np.int64, len(keys))
        unknown = np.flatnonzero(codes < 0)
        if len(unknown):
            missing = [keys[i] for i in unknown.tolist()]
            distinct = list(dict.fromkeys(missing))
            before = np.fromiter(map(self.old.codes.get, distinct, repeat(-1)), np.int64, len(distinct))
            known, new = np.flatnonzero(before >= 0), np.flatnonzero(before < 0).tolist()
            if len(known):
                self.young.add([distinct[i] for i in known.tolist()], *self.old.get(before[known]))
            if new:
                new = [distinct[i] for i in new]
                self.young.add(new, *self.encode(new if string is None else [string(key) for key in new]))
            codes[unknown] = np.fromiter(map(self.young.codes.__getitem__, missing), np.int64, len(missing))
        return codes


class ChunkCache(Remembered):
    """Token ids of chunks."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        super().__init__(encode, remembered)

    def texts(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For consecutive parts of the texts: all ids, one after another, and the number of each text."""
        for part in slices([len(text) for text in texts], AT_ONCE):
            self.turn()
            cut = [space_chunks(text) for text in texts[part]]
            sizes = np.fromiter(map(len, cut), np.int64, len(cut))
            # Within the table a chunk after a space goes by its text alone, a first chunk by "\n" + text:
            # no chunk after a boundary begins with white space.
            firsts = ["\n" + chunks[0] for chunks in cut]
            later = list(chain.from_iterable(chunks[1:] for chunks in cut))
            codes = np.empty(int(sizes.sum()), np.int64)
            first_at = np.cumsum(sizes) - sizes
            is_first = np.zeros(len(codes), bool)
            is_first[first_at] = True
            codes[first_at] = self.codes(firsts, lambda key: key[1:])
            codes[~is_first] = self.codes(later, lambda key: " " + key)
            ids, counts = self.young.get(codes)
            yield ids, np.add.reduceat(counts, first_at)
