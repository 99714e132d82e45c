"""Toxicity by two Kneser-Ney models, one of toxic and one of ordinary documents.

The words of a text (letters and digits, in lower case) are read character by character, padded by ``START`` and
``END``. For each class the highest order is its own: the count of a gram of ``ORDER`` characters, less ``DISCOUNT``, over the
count of its context. What the discount leaves over goes to the next lower order, which both classes share: continuation counts (how
many different characters stand before a gram) over all labelled documents, again interpolated down to a uniform
distribution. So an ending that neither class has seen often says little, and a rare word says as much as its parts.

A word's score is the sum of log P(toxic class) - log P(ordinary class) over its characters; where a gram is new to both
classes only the weights of the backoff of its context differ. A text's score is the sum over its words divided by the
number of words to the power of ``LENGTH``, brought to 0 .. 1 by a logistic curve. That curve is fitted to documents that its
model has not seen: the grams are counted with and without one fold of the labelled documents.

Grams are counted by Spark over all labelled documents and the model is a table, ``key`` (a gram or a context) and ``llr``, that
grows with them. Up to ``BROADCAST`` rows it is sent to the workers as two arrays (12 bytes a row); beyond that the words of
the documents are joined to it, with the same scores.

Defined results: null text is empty; a text without words has the score of a neutral one; null labels and labels without document are
ignored, repeated labels count once, a document labelled both ways counts for both; without labels of both kinds every
score is the share of toxic ones, as (toxic + 1) / (all + 2); repeated rows are scored alike; further columns are left alone.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wattline.llm.common import give_back, possibly_in, ship, slices, spread_out, text_of, written

ORDER, DISCOUNT, LENGTH = 5, 0.75, 0.5
FOLDS, TEST_FOLD, CURVE_FOLD = 5, 0, 4
#: Labelled documents that the logistic curve (two numbers) is fitted to, at most about so many, chosen by hash.
CURVE_ROWS = 100_000
#: Labels that are broadcast (some 30 MB); with more the labelled texts are shuffled to them.
MARKS = 500_000
#: Rows of a model that is broadcast, characters handled at once, words remembered by a worker in each of two generations.
BROADCAST, AT_ONCE, REMEMBERED = 2_000_000, 500_000, 200_000
WORD = re.compile(r"[^\W_]+")
START, END = "^", "$"
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams_of(word: str, order: int = ORDER) -> list[str]:
    padded = START * (order - 1) + word + END
    return [padded[i : i + order] for i in range(len(word) + 1)]


def fold_of(column: Column, folds: int = FOLDS) -> Column:
    """The fold of a document: crc32 of its id as text; -1 without id."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(-1))


def _counted(frames: Iterator[pd.DataFrame], order: int) -> Iterator[pd.DataFrame]:
    """Grams of the frames: counts in ordinary and toxic documents, and of these the counts outside the curve's fold."""
    for frame in frames:
        words: list[Counter] = [Counter() for _ in range(4)]
        for text, toxic, fold in zip(frame["text"], frame["toxic"].tolist(), frame["fold"].tolist()):
            words[2 * int(toxic) + (fold == CURVE_FOLD)].update(words_of(text))
        counts: dict[str, list[int]] = {}
        for kind, some in enumerate(words):
            for word, n in some.items():
                for gram in grams_of(word, order):
                    counts.setdefault(gram, [0, 0, 0, 0])[kind] += n
        table = np.array(list(counts.values()), np.int64).reshape(-1, 4)
        yield pd.DataFrame(
            {"gram": list(counts), "n0": table[:, 0] + table[:, 1], "n1": table[:, 2] + table[:, 3], "m0": table[:, 0], "m1": table[:, 2]}
        )


def gram_counts(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """Grams of the labelled documents (text, toxic, fold), counted by class."""
    found = labelled.mapInPandas(lambda frames: _counted(frames, order), "gram string, n0 long, n1 long, m0 long, m1 long")
    return found.groupBy("gram").agg(*(F.sum(name).alias(name) for name in ("n0", "n1", "m0", "m1")))


def _discounted(count: Column, total: Column, types: Column, below: Column, discount: float) -> Column:
    return F.greatest(count - discount, F.lit(0.0)) / total + discount * types / total * below


def log_ratios(counts: DataFrame, ordinary: str = "n0", toxic: str = "n1", order: int = ORDER, discount: float = DISCOUNT) -> DataFrame:
    """The model: ``key``, ``llr`` for all grams, and for all contexts what holds where the gram is new to both classes."""
    grams = written(counts.select("gram", F.col(ordinary).alias("c0"), F.col(toxic).alias("c1")).filter("c0 + c1 > 0"), "grams")
    # Continuations: in how many grams of the next higher order a gram is the end.
    levels, above = [], grams
    for size in range(order - 1, 0, -1):
        above = written(above.groupBy(F.substring("gram", 2, size).alias("gram")).agg(F.count("*").alias("c")), "continuations")
        levels.append(above)
    known = F.lit(1.0) / (F.lit(1.0) + levels[-1].count())  # one more for what was never seen
    shared = levels[-1].select("gram", "c", F.lit("").alias("context"), known.alias("below"))
    for size in range(1, order):
        context = shared.groupBy("context").agg(F.sum("c").alias("total"), F.count("*").alias("types"))
        value = _discounted(F.col("c"), F.col("total"), F.col("types"), F.col("below"), discount)
        shared = shared.join(context, "context").select("gram", value.alias("p"))
        if size < order - 1:
            higher = levels[order - 2 - size]
            below = shared.select(F.col("gram").alias("tail"), F.col("p").alias("below"))
            shared = higher.withColumn("tail", F.substring("gram", 2, size)).join(below, "tail")
            shared = shared.select("gram", "c", F.substring("gram", 1, size).alias("context"), "below")
    context = grams.groupBy(F.substring("gram", 1, order - 1).alias("context")).agg(
        *(F.sum(f"c{i}").alias(f"total{i}") for i in (0, 1)), *(F.sum((F.col(f"c{i}") > 0).cast("long")).alias(f"types{i}") for i in (0, 1))
    )
    context = written(context, "contexts")
    full = grams.withColumn("tail", F.substring("gram", 2, order - 1)).join(shared.select(F.col("gram").alias("tail"), "p"), "tail")
    full = full.withColumn("context", F.substring("gram", 1, order - 1)).join(context, "context")

    def of_class(i: int) -> Column:
        total = F.col(f"total{i}")
        return F.when(total > 0, _discounted(F.col(f"c{i}"), total, F.col(f"types{i}"), F.col("p"), discount)).otherwise(F.col("p"))

    def backoff(i: int) -> Column:
        return F.when(F.col(f"total{i}") > 0, discount * F.col(f"types{i}") / F.col(f"total{i}")).otherwise(F.lit(1.0))

    found = full.select(F.col("gram").alias("key"), F.ln(of_class(1) / of_class(0)).alias("llr"))
    return found.unionByName(context.select(F.col("context").alias("key"), F.ln(backoff(1) / backoff(0)).alias("llr")))


def _codes(strings: list[str]) -> np.ndarray:
    return np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes(windows: np.ndarray) -> np.ndarray:
    """One number for each row of code points; rows of another length have other numbers."""
    value = np.full(len(windows), windows.shape[1], np.uint64)
    for column in windows.T:
        value = (value ^ column) * MIX
        value ^= value >> np.uint64(29)
    return value


def hashed_keys(keys: list[str]) -> np.ndarray:
    sizes = np.fromiter(map(len, keys), np.int64, len(keys))
    codes, starts, found = _codes(keys), np.cumsum(sizes) - sizes, np.empty(len(keys), np.uint64)
    for size in np.unique(sizes).tolist():
        mine = np.flatnonzero(sizes == size)
        found[mine] = _hashes(codes[starts[mine][:, None] + np.arange(size)])
    return found


class Scorer:
    """Scores of words by a model in two arrays; words met lately are remembered."""

    def __init__(self, keys: np.ndarray, llr: np.ndarray, order: int):
        self.keys, self.llr, self.order = keys, llr, order
        self.young: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        return (self.keys[at] == hashes, self.llr[at]) if len(self.keys) else (np.zeros(len(hashes), bool), np.zeros(len(hashes)))

    def words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        padded = [START * (self.order - 1) + word + END for word in words]
        sizes = np.fromiter(map(len, padded), np.int64, len(padded))
        counts = sizes - self.order + 1
        scores, codes = np.empty(len(words)), _codes(padded)
        starts, total = np.cumsum(sizes) - sizes, 0
        for part in slices(counts.tolist(), AT_ONCE):
            at = spread_out(starts[part], counts[part])
            windows = codes[at[:, None] + np.arange(self.order)]
            known, value = self._found(_hashes(windows))
            in_context, weight = self._found(_hashes(windows[:, :-1]))
            value = np.where(known, value, np.where(in_context, weight, 0.0))
            scores[part] = np.add.reduceat(value, np.cumsum(counts[part]) - counts[part])
            total += len(at)
        return scores

    def remembered(self, words: list[str]) -> dict[str, float]:
        """The scores of words. Those of the generation before are looked up too and carried over when met again."""
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        missing = []
        for word in dict.fromkeys(words):
            if word not in self.young:
                if word in self.old:
                    self.young[word] = self.old[word]
                else:
                    missing.append(word)
        self.young.update(zip(missing, self.words(missing).tolist()))
        return self.young

    def texts(self, texts: list[str | None], length: float) -> np.ndarray:
        scores = np.zeros(len(texts))
        for part in slices([len(text or "") for text in texts], AT_ONCE):
            found = [words_of(text) for text in texts[part]]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = [word for words in found for word in words]
            known = self.remembered(flat)
            total = np.concatenate(([0.0], np.cumsum(np.fromiter(map(known.__getitem__, flat), np.float64, len(flat)))))
            ends = np.cumsum(sizes)
            scores[part] = (total[ends] - total[ends - sizes]) / np.maximum(sizes, 1) ** length
        return scores


_SCORERS: dict[str, Scorer] = {}


def _by_broadcast(docs: DataFrame, model: DataFrame, out: str, order: int, length: float) -> DataFrame:
    @pandas_udf("long")
    def hashed(keys: pd.Series) -> pd.Series:
        return pd.Series(hashed_keys(keys.tolist()).view(np.int64))

    rows = model.select(hashed("key").alias("key"), F.col("llr").cast("double")).toArrow()
    keys, llr = rows["key"].to_numpy().view(np.uint64), rows["llr"].to_numpy()
    ordered = np.argsort(keys)
    sent, name = docs.sparkSession.sparkContext.broadcast((keys[ordered], llr[ordered])), uuid.uuid4().hex

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if name not in _SCORERS:
            _SCORERS.clear()  # one model at a time
            _SCORERS[name] = Scorer(*sent.value, order)
        found = _SCORERS[name].texts(texts.tolist(), length)
        give_back()
        return pd.Series(found)

    return docs.withColumn(out, scored("text"))


def _listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in slices([len(text) for text in frame["text"]], AT_ONCE):
            rows = [(row, word, n) for row, text in zip(frame["row"].iloc[part], frame["text"].iloc[part]) for word, n in Counter(words_of(text)).items()]
            yield pd.DataFrame(rows, columns=["row", "word", "n"])


def _by_join(docs: DataFrame, model: DataFrame, out: str, order: int, length: float) -> DataFrame:
    fixed = written(docs.withColumn("row", F.monotonically_increasing_id()), "texts")
    words = written(fixed.select("row", "text").mapInPandas(_listed, "row long, word string, n long"), "words")
    padded = F.concat(F.lit(START * (order - 1)), "word", F.lit(END))
    grams = F.transform(F.sequence(F.lit(1), F.length("word") + 1), lambda i: F.substring(padded, i, F.lit(order)))
    placed = words.select("word").distinct().select("word", F.explode(grams).alias("gram")).withColumn("context", F.substring("gram", 1, order - 1))
    by_gram = model.filter(F.length("key") == order).select(F.col("key").alias("gram"), "llr")
    by_context = model.filter(F.length("key") < order).select(F.col("key").alias("context"), F.col("llr").alias("weight"))
    value = F.coalesce("llr", "weight", F.lit(0.0))
    of_word = placed.join(by_gram, "gram", "left").join(by_context, "context", "left").groupBy("word").agg(F.sum(value).alias("score"))
    of_row = words.join(of_word, "word").groupBy("row").agg((F.sum(F.col("n") * F.col("score")) / F.pow(F.sum("n"), F.lit(length))).alias(out))
    return fixed.join(of_row, "row", "left").drop("row").withColumn(out, F.coalesce(out, F.lit(0.0)))


def raw_scores(docs: DataFrame, model: DataFrame, out: str, order: int = ORDER, length: float = LENGTH, broadcast: int = BROADCAST) -> DataFrame:
    """``docs`` (with ``text``, not null) and the score of each text as column ``out``."""
    return (_by_broadcast if model.count() <= broadcast else _by_join)(docs, model, out, order, length)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton steps with halving."""
    scale = max(1e-9, float(np.abs(x).std()))
    design = np.column_stack([x / scale, np.ones(len(x))])
    weights = np.array([0.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = design @ w
        return float(np.logaddexp(0, z).sum() - z @ y + ridge / 2 * w @ w)

    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -40, 40)))
        gradient = design.T @ (p - y) + ridge * weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), gradient)
        while loss(weights - step) > loss(weights) and np.abs(step).max() > 1e-12:
            step = step / 2
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


@dataclass
class Model:
    """Grams' log ratios and the logistic curve; without ``ratios`` all scores are the same."""

    ratios: DataFrame | None
    slope: float
    intercept: float


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    curve_rows: int = CURVE_ROWS,
    broadcast: int = BROADCAST,
    most_marks: int = MARKS,
) -> Model:
    """A model of the labelled documents that are not held out."""
    ship(docs.sparkSession)
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
    marks = marks.filter("id IS NOT NULL AND toxic IN (0, 1)").distinct().withColumn("fold", fold_of(F.col("id"))).filter(F.col("fold") != TEST_FOLD)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    marks = written(marks, "labels")
    few = marks.count() <= most_marks
    found = texts.join(F.broadcast(marks), "id") if few else possibly_in(texts, marks.select("id"), "id").join(marks, "id")
    labelled = written(found, "labelled")
    total, toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, total):
        share = (toxic + 1) / (total + 2)
        return Model(None, 0.0, math.log(share / (1 - share)))
    counts = written(gram_counts(labelled), "counts")
    ratios = written(log_ratios(counts), "ratios")
    seen = labelled.filter(F.col("fold") == CURVE_FOLD)
    whole = 1 << 20
    keep = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(whole)) < int(whole * min(1.0, curve_rows / max(1, seen.count())))
    unseen = written(log_ratios(counts, "m0", "m1"), "ratios")
    found = raw_scores(seen.filter(keep).select("text", "toxic"), unseen, "x", broadcast=broadcast).select("x", "toxic").toPandas()
    x, y = found["x"].to_numpy(np.float64), found["toxic"].to_numpy(np.float64)
    if 0 < y.sum() < len(y):
        return Model(ratios, *logistic(x, y))
    return Model(ratios, 1.0, math.log(toxic / (total - toxic)))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", broadcast: int = BROADCAST) -> DataFrame:
    """One row for each document: id, ``score`` and ``predicted``."""
    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), text_of(text_col).alias("text"))
    raw = texts.withColumn("x", F.lit(0.0)) if model.ratios is None else raw_scores(texts, model.ratios, "x", broadcast=broadcast)
    score = F.lit(1.0) / (F.exp(-F.greatest(F.least(F.col("x") * model.slope + model.intercept, F.lit(500.0)), F.lit(-500.0))) + 1)
    return raw.select(id_col, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
