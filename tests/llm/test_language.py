import os
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

from tests.llm.data import ROWS, documents, empty
from wattline.llm import language
from wattline.llm.catalog import QUERIES

FOLDER = "/root/testdata/sf0.01"


def grams(text):
    plain = re.sub(" +", " ", " " + "".join(x if x.isalpha() else " " for x in text.lower()) + " ")
    return [plain[i : i + 3] for i in range(len(plain) - 2)] if plain.strip() else []


@pytest.mark.parametrize("texts", [["", "a", "..", "Ab, c!", "x"], ["  a", "b "], [""], ["1"], ["über\n\nalles"], ["İx", "ß", "漢字 🎉 b"]])
def test_trigrams(texts):
    buckets, sizes = language.trigrams(texts)
    assert sizes.tolist() == [len(grams(text)) for text in texts]
    one_by_one = [language.trigrams([text])[0].tolist() for text in texts]
    assert buckets.tolist() == [bucket for text in one_by_one for bucket in text]


@pytest.fixture(scope="module")
def model():
    texts = {
        "de": "der die das und nicht ist ein eine haus garten schule straße " * 30,
        "en": "the and that with this house garden school street which from " * 30,
        "fr": "le la les et dans une maison jardin école rue qui avec pour " * 30,
    }
    counts = np.stack([np.bincount(language.trigrams([t])[0], minlength=language.BUCKETS) for t in texts.values()], axis=1)
    return language.Model(list(texts), counts)


def test_proportions_maximise_the_likelihood(model):
    text = "the house and the garden with this street der garten und das haus ist nicht das school from which"
    shares = model.proportions([text])[0]
    assert (shares > 0).tolist() == [True, True, False]
    kinds = language.trigrams([text])[0]
    grid = [(np.log(model.p[kinds] @ np.array([w, 1 - w, 0])).sum(), w) for w in np.linspace(0, 1, 2001)]
    assert abs(max(grid)[1] - shares[0]) < 0.01


def test_one_language_stays_alone(model):
    shares = model.proportions(["das haus und der garten", "the street and this school", "", "42 !"])
    assert shares[:2].tolist() == [[1, 0, 0], [0, 1, 0]]
    assert not shares[2:].any()


def test_dirty_documents(spark):
    result = language.identify(documents(spark))
    assert result.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = result.collect()
    assert len(rows) == len(ROWS)
    for row, (doc, text, *_) in zip(rows, ROWS):
        assert row["held_out"] == (zlib.crc32(("" if doc is None else str(doc)).encode()) % 3 == 1)
        assert (row["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= row["score"] <= 1
    kept = language.in_known_language(documents(spark))
    assert kept.columns == documents(spark).columns
    assert kept.count() == sum(any(c.isalpha() for c in row[1] or "") for row in ROWS)
    assert language.identify(empty(spark)).count() == 0
    assert language.in_known_language(empty(spark)).count() == 0


def test_nothing_learned(spark):
    rows = [(row[0], row[1], None, row[3], row[4]) for row in ROWS]
    assert {tuple(r) for r in language.identify(documents(spark, rows)).select("lang_pred", "score").collect()} == {("und", 0.0)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op8_language"](spark, FOLDER).filter("held_out").join(truth, "doc_id")
    right = found.filter("lang_pred = lang").count()
    assert right >= 0.97 * found.count() > 0


def test_chosen_set_is_the_best_of_all_subsets():
    """Greedy growth against every subset of four languages, on short texts mixed from one to three of them."""
    words = {
        "de": "der die das und nicht ist ein eine haus garten schule straße wasser zeit",
        "en": "the and that with this house garden school street which from water time",
        "es": "el los las y que con para una casa jardín escuela calle agua tiempo",
        "fr": "le la les et dans une maison jardin école rue qui avec pour eau temps",
    }
    counts = np.stack([np.bincount(language.trigrams([" ".join([t] * 30)])[0], minlength=language.BUCKETS) for t in words.values()], axis=1)
    model, pick, checked = language.Model(list(words), counts), random.Random(5), 0
    for _ in range(60):
        mixed = pick.sample(list(words), pick.randint(1, 3))
        text = " ".join(pick.choice(words[name].split()) for name in mixed for _ in range(pick.randint(3, 14)))
        kinds = language.trigrams([text])[0]
        reached = {}
        for size in range(1, 5):
            for subset in combinations(range(4), size):
                p, share = model.p[kinds][:, subset], np.full(size, 1 / size)
                for _ in range(400):
                    share = (p * share / (p @ share)[:, None]).mean(axis=0)
                reached[subset] = np.log(p @ share).sum() - language.PENALTY * (size - 1) * np.log(len(kinds) + 1)
        first, second = sorted(reached.values(), reverse=True)[:2]
        if first - second > 0.5:  # nearer ones hang on how far the estimation is carried
            checked += 1
            chosen = tuple(np.flatnonzero(model.proportions([text])[0] > 0).tolist())
            assert chosen == max(reached, key=reached.get)
    assert checked > 40
