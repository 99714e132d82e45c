import random

import pytest

from tests.llm.data import ROWS, documents, empty
from wattline.llm.token_counts import COUNT_BITS, MARK, STEP_BITS, Unigram, with_token_counts, zipf_scores

PIECES = [MARK, "t", "h", "e", "a", "th", "the", MARK + "the", "he", "in", "ing", "n", "i", "g", "hea", "é", "eat", "at"]


def brute(model, values, text):
    tokens = score = 0
    for word in text.split():
        word = MARK + word
        best = [0]
        for end in range(1, len(word) + 1):
            cuts = [best[start] + values[word[start:end]] for start in range(end) if word[start:end] in values]
            if word[end - 1] not in values:
                unknown = round(model.worst * (1 << STEP_BITS)) << COUNT_BITS
                cuts.append(best[end - 1] + unknown - len(word[end - 1].encode()))
            best.append(max(cuts))
        n = -best[-1] & ((1 << COUNT_BITS) - 1)
        tokens, score = tokens + n, score + ((best[-1] + n) >> COUNT_BITS)
    return len(text.split()), tokens, score / (1 << STEP_BITS)


@pytest.mark.parametrize("scores", [zipf_scores(PIECES), [-1.0] * len(PIECES)])
def test_equals_brute_force(scores):
    model = Unigram(PIECES, scores)
    values = {piece: Unigram._value(score, 1) for piece, score in zip(PIECES, scores)}
    rng = random.Random(2)
    parts = ["the", "t", "h", "e", "a", "ing", "n", " ", " ", "\n", "é", "漢", "🎉", "x", MARK]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    texts += ["", " ", "the" * 700, "x" * 3000]
    got = model.documents(texts)
    assert [tuple(row) for row in got.itertuples(index=False)] == [brute(model, values, text) for text in texts]
    assert model.documents(texts).equals(got)  # from the cache


def test_documents(spark):
    scores = zipf_scores(PIECES)
    model, values = Unigram(PIECES, scores), dict(zip(PIECES, (Unigram._value(s, 1) for s in scores)))
    counted = with_token_counts(documents(spark), PIECES)
    assert counted.columns == [*documents(spark).columns, "token_counts"]
    rows = counted.select("text", "token_counts.*").collect()
    assert len(rows) == len(ROWS)
    assert all(tuple(row)[1:] == brute(model, values, row["text"] or "") for row in rows)
    assert with_token_counts(empty(spark), PIECES).count() == 0


def test_long_runs_do_not_carry_into_the_score(monkeypatch):
    texts = ["x" * 50 + " the", "漢" * 30, "t" * 40]
    want = Unigram(PIECES, zipf_scores(PIECES)).documents(texts)
    monkeypatch.setattr("wattline.llm.token_counts.COUNT_BITS", 4)  # a run of over 15 tokens is long then
    assert Unigram(PIECES, zipf_scores(PIECES)).documents(texts).equals(want)
    assert want["n_tokens"].tolist() == [53, 91, 41]
