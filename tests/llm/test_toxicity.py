"""The two models against dictionaries, and toxic documents among clean ones."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import ROWS, documents, empty
from wattline.llm import toxicity

LABELS = "doc_id long, toxic int, score string, x int"


def labels(spark, rows):
    return spark.createDataFrame([(doc, toxic, "s", 1) for doc, toxic in rows], LABELS)


def corpus(n=400, seed=1):
    """Documents of a small vocabulary; toxic ones have a few words of a second one, clean ones at most a stray one."""
    pick = random.Random(seed)
    plain = ["".join(pick.choice("abcdeilnorst") for _ in range(pick.randrange(2, 7))) for _ in range(150)]
    nasty = ["zorgkuk", "quvvex", "zorgki", "plurxx"]
    rows, marks = [], []
    for doc in range(n):
        words = [pick.choice(plain) for _ in range(pick.randrange(5, 120))]
        toxic = int(pick.random() < 0.25)
        for _ in range(pick.randrange(3, 7) if toxic else 0):
            words.insert(pick.randrange(len(words)), pick.choice(nasty) + pick.choice(["", "a", "en"]))
        rows.append((doc, " ".join(words).capitalize() + ".", "en", "s", 1))
        marks.append((doc, toxic))
    return rows, marks


class Brute:
    """Class-conditional Kneser-Ney with dictionaries, straight from the definition."""

    def __init__(self, texts, order=5, discount=0.75):
        self.order, self.discount = order, discount
        self.top = [Counter(), Counter()]
        for text, toxic in texts:
            for word in toxicity.words_of(text):
                self.top[toxic].update(toxicity.grams_of(word, order))
        self.cont, above = {}, set(self.top[0]) | set(self.top[1])
        for size in range(order - 1, 0, -1):
            self.cont[size] = Counter(gram[1:] for gram in above)
            above = set(self.cont[size])

    def estimate(self, counts, gram, below):
        same = {g: n for g, n in counts.items() if g[:-1] == gram[:-1] and n > 0}
        total = sum(same.values())
        if not total:
            return below
        return max(same.get(gram, 0) - self.discount, 0) / total + self.discount * len(same) / total * below

    def shared(self, gram):
        if not gram:
            return 1 / (len(self.cont[1]) + 1)
        return self.estimate(self.cont[len(gram)], gram, self.shared(gram[1:]))

    def ratio(self, gram):
        below = self.shared(gram[1:])
        p = [self.estimate(self.top[i], gram, below) for i in (0, 1)]
        return math.log(p[1] / p[0])

    def text(self, text):
        words = toxicity.words_of(text)
        return sum(self.ratio(g) for word in words for g in toxicity.grams_of(word, self.order)) / max(1, len(words)) ** 0.5


SMALL = [("the cat sat", 0), ("the dog ran off", 0), ("a cat ran", 0), ("you scum", 1), ("scummy dog you", 1)]


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_scores_equal_brute_force(spark, broadcast):
    brute = Brute(SMALL)
    frame = spark.createDataFrame([(text, toxic, 1) for text, toxic in SMALL], "text string, toxic int, fold long")
    model = toxicity.log_ratios(toxicity.gram_counts(frame.repartition(3)))
    texts = ["", "the cat", "scum", "Scum-scum you!", "the zebra", "x", "dogs ran " * 50, "漢字 über 🎉", "scumscumscum"]
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "id int, text string")
    got = {row["id"]: row["found"] for row in toxicity.raw_scores(docs, model, "found", broadcast=broadcast).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx([brute.text(text) for text in texts], abs=1e-9)


def test_probabilities_add_up():
    brute = Brute(SMALL)
    letters = {gram[-1] for gram in brute.cont[1]}
    for context in ("^^^^", "^^^s", "scum", "cat"):
        unseen = 1 / (len(letters) + 1)  # the share of what was never seen, carried down through all orders
        total = sum(brute.shared((context + letter)[-4:]) for letter in letters)
        assert unseen * 1e-6 < 1 - total < 1


def test_both_ways_agree_on_a_corpus(spark):
    rows, marks = corpus(120)
    docs = documents(spark, rows)
    model, other = (toxicity.fit(docs, labels(spark, marks), most_marks=n) for n in (10**6, 0))
    assert (model.slope, model.intercept) == pytest.approx((other.slope, other.intercept), abs=1e-6)
    near, far = ({row["doc_id"]: row["score"] for row in toxicity.scores(docs, model, broadcast=n).collect()} for n in (10**7, 0))
    assert near.keys() == far.keys() == {row[0] for row in rows}
    assert all(near[doc] == pytest.approx(far[doc], abs=1e-9) for doc in near)


def test_held_out_documents(spark):
    rows, marks = corpus(700)
    found = toxicity.scores(documents(spark, rows), toxicity.fit(documents(spark, rows), labels(spark, marks)))
    got, toxic = {row["doc_id"]: row["predicted"] for row in found.collect()}, dict(marks)
    held = [doc for doc in got if zlib.crc32(str(doc).encode()) % 5 == 0]
    assert len(held) > 100
    assert np.mean([got[doc] == toxic[doc] for doc in held]) > 0.97


def test_held_out_labels_are_not_used(spark):
    rows, marks = corpus(150)
    docs, other = documents(spark, rows), [(doc, 1 - toxic if zlib.crc32(str(doc).encode()) % 5 == 0 else toxic) for doc, toxic in marks]
    a, b = (sorted(map(tuple, toxicity.scores(docs, toxicity.fit(docs, labels(spark, some))).collect())) for some in (marks, other))
    assert [row[0] for row in a] == [row[0] for row in b] and [row[1] for row in a] == pytest.approx([row[1] for row in b], abs=1e-12)


def test_dirty_documents(spark):
    docs = documents(spark)
    marks = [(1, 1), (1, 1), (1, 0), (6, 0), (8, 1), (9, 0), (10, None), (None, 1), (11, 0), (77, 1), (-12, 1)]
    found = toxicity.scores(docs, toxicity.fit(docs, labels(spark, marks))).collect()
    assert sorted(row["doc_id"] or 0 for row in found) == sorted(row[0] or 0 for row in ROWS)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5) for row in found)
    neutral = {row["score"] for row in found if row["doc_id"] in (3, 4, 5)}
    assert len(neutral) == 1


@pytest.mark.parametrize("marks,share", [([], 1 / 2), ([(1, 0), (2, 0)], 1 / 4), ([(1, 1)], 2 / 3)])
def test_without_both_kinds_of_labels(spark, marks, share):
    docs = documents(spark)
    found = toxicity.scores(docs, toxicity.fit(docs, labels(spark, marks))).collect()
    assert len(found) == len(ROWS) and {round(row["score"], 9) for row in found} == {round(share, 9)}


def test_empty(spark):
    assert toxicity.scores(empty(spark), toxicity.fit(empty(spark), labels(spark, []))).collect() == []


def test_logistic_finds_the_curve():
    pick = np.random.default_rng(1)
    x = pick.normal(size=20_000)
    y = (pick.random(20_000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    assert toxicity.logistic(x, y) == pytest.approx((2, -1), abs=0.1)
    slope, intercept = toxicity.logistic(np.array([-1.0, -2.0, 3.0, 4.0]), np.array([0.0, 0, 1, 1]))
    assert slope > 0 and math.isfinite(intercept)


def test_folds():
    column = toxicity.fold_of(F.col("doc_id"))
    assert "crc32" in str(column)
