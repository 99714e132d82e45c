"""Token counts under a unigram vocabulary, by dynamic programming on a trie of words.

A word (what stands between white space, behind a word mark) is cut into pieces so that the sum of
their scores is largest; of equally good cuts the one with fewer pieces counts. Each worker
inserts the words it meets for the first time in a trie, level by level in arrays. The best score of a
prefix is computed once for all words that share it: a node looks, for every piece that can end in it, at
the score of the ancestor where that piece began. Which pieces end in a node follows from its parent:
each is a state of the vocabulary's own trie that advances by one character. Words' counts are kept and
summed by document; nothing is shuffled.

A character that is no piece costs ``UNKNOWN`` less than the worst piece and counts as its
UTF-8 bytes. Scores are kept in steps of 1 / 2 ** ``STEP_BITS``, so sums are exact and ties are ties.

Defined results: null and empty texts and those of white space have no tokens; equal texts have equal counts.
"""

from __future__ import annotations

from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wattline.llm.bpe import NONE, PairTable
from wattline.llm.common import ship, slices

MARK, UNKNOWN, STEP_BITS, COUNT_BITS = "▁", 10.0, 14, 22
AT_ONCE, REMEMBERED = 1_500_000, 1 << 19
NEVER = -(np.int64(1) << 62)


def zipf_scores(pieces: list[str]) -> list[float]:
    """Scores for a vocabulary that is listed by falling frequency and gives no probabilities: log(1 / rank)."""
    return (-np.log(np.arange(len(pieces)) + 1.0)).tolist()


class Unigram:
    """Pieces with their scores."""

    def __init__(self, pieces: list[str], scores: list[float], mark: str = MARK):
        self.mark = mark
        states: dict[tuple[int, int], int] = {}
        values = {}
        for piece, score in zip(pieces, scores):
            state = 0
            for char in piece:
                state = states.setdefault((state, ord(char)), len(states) + 1)
            if piece:
                values[state] = self._value(score, 1)
        self.worst = min(scores, default=0.0) - UNKNOWN
        edges = np.array([(*edge, state) for edge, state in states.items()], np.int64).reshape(-1, 3)
        self.next = PairTable(*edges.T)
        self.value = np.full(len(states) + 1, NEVER, np.int64)
        self.value[list(values)] = list(values.values())
        self.longest = max(map(len, pieces), default=1)
        self._clear()

    @staticmethod
    def _value(score: float, count: int) -> int:
        """A score and a number of pieces in one number whose maximum is what is sought."""
        return (round(score * (1 << STEP_BITS)) << COUNT_BITS) - count

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.totals = np.zeros((0, 2), np.int64)

    def words(self, words: list[str]) -> np.ndarray:
        """Score and number of tokens of the best cut of each word; the words are in code point order and not empty."""
        lengths = np.fromiter((len(word) + len(self.mark) for word in words), np.int64, len(words))
        text = np.frombuffer("".join(chain.from_iterable(zip(repeat(self.mark), words))).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        totals = np.empty((len(words), 2), np.int64)
        open_words = np.arange(len(words))
        node = np.zeros(len(words), np.int64)
        # Of the nodes of the level above: pieces that may go on, and the best scores from there upwards with
        # their numbers of tokens, apart from each other so that a word of any length has room for both.
        states = np.full((1, self.longest), -1, np.int64)
        best = np.full((1, self.longest), NEVER, np.int64)
        best[0, 0] = 0
        tokens = np.zeros((1, self.longest), np.int64)
        depth = 0
        while len(open_words):
            chars = text[starts[open_words] + depth].astype(np.int64)
            new = np.ones(len(chars), bool)
            new[1:] = (node[1:] != node[:-1]) | (chars[1:] != chars[:-1])
            above, chars = node[new], chars[new]
            moved = np.concatenate((np.zeros((len(chars), 1), np.int64), states[above, :-1]), axis=1)
            row, column = np.nonzero(moved >= 0)
            reached = self.next.find(moved[row, column], chars[row])
            states = np.full(moved.shape, -1, np.int64)
            states[row, column] = np.where(reached == NONE, -1, reached)
            value = np.where(states >= 0, self.value[states], NEVER)
            from_above, count = best[above], tokens[above]
            # The value of one piece is its score and one token.
            reach = np.where((value > NEVER) & (from_above > NEVER), ((value + 1) >> COUNT_BITS) + from_above, NEVER)
            total = count + 1
            alone = value[:, 0] == NEVER
            if alone.any():
                size = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
                reach[alone, 0] = from_above[alone, 0] + round(self.worst * (1 << STEP_BITS))
                total[alone, 0] = (count[:, 0] + size)[alone]
            most = reach.max(axis=1)[:, None]
            fewest = np.where(reach == most, total, -NEVER).min(axis=1)[:, None]
            best = np.concatenate((most, from_above[:, :-1]), axis=1)
            tokens = np.concatenate((fewest, count[:, :-1]), axis=1)
            depth += 1
            node = np.cumsum(new) - 1
            ended = lengths[open_words] == depth
            totals[open_words[ended], 0] = best[node[ended], 0]
            totals[open_words[ended], 1] = tokens[node[ended], 0]
            open_words, node = open_words[~ended], node[~ended]
        return totals

    def documents(self, texts: list[str]) -> pd.DataFrame:
        """n_words, n_tokens and the sum of scores of each text."""
        counts = np.zeros((len(texts), 2), np.int64)
        scores = np.zeros(len(texts))
        for part in slices([len(text) for text in texts], AT_ONCE):
            if len(self.codes) > REMEMBERED:
                self._clear()
            cut = [text.split() for text in texts[part]]
            sizes = np.fromiter(map(len, cut), np.int64, len(cut))
            words = list(chain.from_iterable(cut))
            codes = np.fromiter(map(self.codes.get, words, repeat(-1)), np.int64, len(words))
            unknown = np.flatnonzero(codes < 0)
            if len(unknown):
                missing = [words[i] for i in unknown.tolist()]
                new = sorted(set(missing))
                self.codes.update(zip(new, range(len(self.totals), len(self.totals) + len(new))))
                self.totals = np.concatenate((self.totals, self.words(new)))
                codes[unknown] = np.fromiter(map(self.codes.__getitem__, missing), np.int64, len(missing))
            score, tokens = self.totals[codes].T
            ends = np.cumsum(sizes)
            for column, values in enumerate((np.ones(len(tokens), np.int64), tokens)):
                sums = np.concatenate(([0], np.cumsum(values)))
                counts[part, column] = sums[ends] - sums[ends - sizes]
            sums = np.concatenate(([0], np.cumsum(score)))
            scores[part] = (sums[ends] - sums[ends - sizes]) / (1 << STEP_BITS)
        return pd.DataFrame({"n_words": counts[:, 0], "n_tokens": counts[:, 1], "log_score": scores})


_LOADED: dict[int, Unigram] = {}


def loaded(pieces: list[str], scores: list[float], mark: str) -> Unigram:
    """The vocabulary, prepared once in each worker."""
    key = hash((tuple(pieces), tuple(scores), mark))
    if key not in _LOADED:
        _LOADED[key] = Unigram(pieces, scores, mark)
    return _LOADED[key]


def with_token_counts(
    docs: DataFrame,
    pieces: list[str],
    scores: list[float] | None = None,
    mark: str = MARK,
    text_col: str = "text",
    out_col: str = "token_counts",
) -> DataFrame:
    """The documents with a struct of n_words, n_tokens and log_score; a column of that name is replaced.

    The vocabulary (some 10,000 pieces) is broadcast.
    """
    ship(docs.sparkSession)
    scores = zipf_scores(pieces) if scores is None else scores
    vocabulary = docs.sparkSession.sparkContext.broadcast((pieces, scores, mark))

    @pandas_udf("n_words long, n_tokens long, log_score double")
    def counted(texts: pd.Series) -> pd.DataFrame:
        return loaded(*vocabulary.value).documents([text or "" for text in texts])

    return docs.withColumn(out_col, counted(F.col(f"`{text_col}`")))
