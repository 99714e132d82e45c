"""Language identification by a mixture of languages.

Each language is a distribution over hashed character trigrams, counted in Spark over all training
documents. A document is taken as a mixture of languages: expectation-maximisation estimates
their proportions, and the set of languages grows from the best single one as long as the gain in
likelihood exceeds a penalty for one more proportion (``PENALTY`` times the logarithm of the number
of trigrams). As the likelihood is concave in the proportions, the slope towards a language
bounds what it can gain; where no slope exceeds the penalty, no estimation is needed.

The prediction is the language with the largest proportion, the score is that proportion.

Trigrams: the text in lower case, each run of other characters than letters as one space, a
space at both ends. Whole texts are used.

Defined results: null or empty text, or a text without letters, is ``und`` with score 0, as is every
text if nothing was learned; rows without a language teach nothing; ties go to the language that comes
first in code point order; equal texts get equal results. More than ``MOST_LANGUAGES``
languages are refused with an error, for the model (``BUCKETS`` numbers each) is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wattline.llm.common import fresh, give_back, ship, slices, written

BUCKETS, MOST_LANGUAGES = 1 << 15, 200
SMOOTHING, PENALTY, ROUNDS = 0.5, 3.0, 20
AT_ONCE = 300_000
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point whether it is a letter, made once in each worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(code).isalpha() for code in range(0x110000)]))
    return _LETTERS[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all trigrams, one text after another, and their numbers; none for a text without letters."""
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer(" ".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(texts))
    # The joining space belongs to both neighbours; owner is the text that a character ends or belongs to.
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    letter = letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a letter, or the first other character after one
    keep[0] = True
    plain = np.where(letter, codes, 32)[keep].astype(np.uint64)
    whose = np.concatenate(([-1], owner))[keep]
    if len(plain) < 3:
        return np.zeros(0, np.uint16), np.zeros(len(texts), np.int64)
    key = (plain[:-2] << np.uint64(42)) ^ (plain[1:-1] << np.uint64(21)) ^ plain[2:]
    buckets = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.uint16)
    # One that ends in a text and began in it or at the space before.
    inside = (whose[2:] == whose[1:-1]) & ((whose[:-2] == whose[2:]) | (plain[:-2] == 32))
    return buckets[inside], np.bincount(whose[2:][inside], minlength=len(texts))


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for frame in frames:
        for language, rows in frame.groupby("lang", sort=False):
            texts = rows["text"].tolist()
            for part in slices([len(text) for text in texts], AT_ONCE):
                found = np.bincount(trigrams(texts[part])[0], minlength=BUCKETS)
                sums[language] = sums.get(language, 0) + found
    give_back()
    for language, found in sums.items():
        at = np.flatnonzero(found)
        yield pd.DataFrame({"lang": language, "bucket": at, "n": found[at]})


class Model:
    """Languages in code point order and the probabilities of the buckets, one column each."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        smooth = counts.astype(np.float64) + SMOOTHING
        self.p = smooth / smooth.sum(axis=0, keepdims=True)
        self.log_p = np.log(self.p)

    def proportions(self, texts: list[str]) -> np.ndarray:
        """Rows of proportions; a row of zeros for a text without letters."""
        result = np.zeros((len(texts), len(self.languages)))
        at_once = max(20_000, 4 * AT_ONCE // max(4, len(self.languages)))
        for part in slices([len(text) for text in texts], at_once):
            result[part] = self._mixtures(texts[part])
        return result

    def _mixtures(self, texts: list[str]) -> np.ndarray:
        buckets, sizes = trigrams(texts)
        result = np.zeros((len(texts), len(self.languages)))
        if not len(buckets) or not self.languages:
            return result
        kinds, times, numbers = _distinct(buckets, sizes)
        docs = np.flatnonzero(sizes)
        grams, numbers = Grams(kinds, times, numbers[docs]), sizes[docs]
        single = grams.sums(self.log_p[kinds] * times[:, None])
        chosen = np.zeros(single.shape, bool)
        chosen[np.arange(len(docs)), single.argmax(axis=1)] = True
        weights, likelihood = chosen.astype(np.float64), single.max(axis=1)
        penalty = PENALTY * np.log(numbers + 1)
        active = np.arange(len(docs))
        while len(active):
            own = grams.of(active)
            p = self.p[own.kinds]
            mixed = (p * weights[active][own.owner]).sum(axis=1)
            slope = own.sums(p * (own.times / mixed)[:, None]) - numbers[active][:, None]
            slope[chosen[active]] = -np.inf
            best = slope.argmax(axis=1)
            hopeful = slope[np.arange(len(active)), best] > penalty[active]
            active, best = active[hopeful], best[hopeful]
            if not len(active):
                break
            larger = chosen[active]
            larger[np.arange(len(active)), best] = True
            tried, reached = self._maximised(grams.of(active), larger)
            better = reached - likelihood[active] > penalty[active]
            active = active[better]
            chosen[active], weights[active], likelihood[active] = larger[better], tried[better], reached[better]
        result[docs] = weights
        return result

    def _maximised(self, grams: Grams, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expectation-maximisation over the chosen languages: proportions and log-likelihoods."""
        weights = chosen / chosen.sum(axis=1, keepdims=True)
        # The chosen columns alone: as many as the largest set has, the others are padded with weight 0.
        most = int(chosen.sum(axis=1).max())
        columns = np.argsort(~chosen, axis=1, kind="stable")[:, :most]
        rows = np.arange(len(chosen))[:, None]
        part = weights[rows, columns]
        p = self.p[grams.kinds[:, None], columns[grams.owner]]
        total = grams.sums(grams.times[:, None].astype(np.float64))
        for _ in range(ROUNDS):
            share = p * part[grams.owner]
            share *= (grams.times / share.sum(axis=1))[:, None]
            part = grams.sums(share) / total
        reached = grams.sums((grams.times * np.log((p * part[grams.owner]).sum(axis=1)))[:, None])[:, 0]
        weights = np.zeros(chosen.shape)
        weights[rows, columns] = part
        return weights, reached

    def predict(self, texts: list[str]) -> pd.DataFrame:
        shares = self.proportions(texts)
        if not self.languages:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0})
        best = shares.argmax(axis=1)
        score = np.clip(shares[np.arange(len(texts)), best], 0.0, 1.0)
        named = np.where(score > 0, np.array(self.languages, object)[best], UNKNOWN)
        return pd.DataFrame({"lang_pred": named, "score": score})


class Grams:
    """Distinct trigrams of several documents: buckets, how often, and of which document."""

    def __init__(self, kinds: np.ndarray, times: np.ndarray, numbers: np.ndarray):
        self.kinds, self.times, self.numbers = kinds, times, numbers
        self.starts = np.cumsum(numbers) - numbers
        self.owner = np.repeat(np.arange(len(numbers)), numbers)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, axis=0)

    def of(self, docs: np.ndarray) -> Grams:
        if len(docs) == len(self.numbers):
            return self
        chosen = np.zeros(len(self.numbers), bool)
        chosen[docs] = True
        here = chosen[self.owner]
        return Grams(self.kinds[here], self.times[here], self.numbers[docs])


def _distinct(buckets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different buckets of each text, how often each occurs, and how many there are."""
    ordered = np.empty_like(buckets)
    ends = np.cumsum(sizes)
    for end, size in zip(ends.tolist(), sizes.tolist()):
        ordered[end - size : end] = np.sort(buckets[end - size : end], kind="stable")
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[(ends - sizes)[sizes > 0]] = True
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(ordered)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return ordered[at].astype(np.int64), times, np.bincount(owner[at], minlength=len(sizes))


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that teach nothing: crc32 of the id as text leaves 1 when divided by 3; a null id is like an empty one."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) % 3 == 1


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of all given documents by language and bucket; their sums, bounded in number, make the model."""
    ship(docs.sparkSession)
    taught = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    sums = written(
        taught.dropna()
        .mapInPandas(_counts, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n")),
        "trigrams",
    )
    languages = sorted(row[0] for row in sums.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((BUCKETS, len(languages)))
    found = sums.toPandas()
    counts[found["bucket"], found["lang"].map({name: i for i, name in enumerate(languages)}).astype(int)] = found["n"]
    return Model(languages, counts)


def with_language(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """The documents with a struct of ``lang_pred`` and ``score``; a column of that name is replaced."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        found = shared.value.predict([text or "" for text in texts])
        give_back()
        return found

    return docs.withColumn(out_col, predict(F.col(f"`{text_col}`")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``; learned from those not held out."""
    model = learn(docs.filter(~held_out(id_col)), text_col, lang_col)
    seen = docs.select(
        F.col(f"`{id_col}`").alias("id"), held_out(id_col).alias("held_out"), F.col(f"`{text_col}`").alias("text")
    )
    return with_language(seen, model, "text", "found").select(
        F.col("id").alias(id_col), "held_out", "found.lang_pred", "found.score"
    )


def in_known_language(
    docs: DataFrame, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The documents that have a language which makes up at least ``least`` of them; columns as they came."""
    found = fresh(docs, "language_found")
    model = learn(docs.filter(~held_out(id_col)), text_col, lang_col)
    known = (F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least)
    return with_language(docs, model, text_col, found).filter(known).select(*docs.columns)
