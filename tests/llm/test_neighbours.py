import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline.llm.neighbours import CURVES, curves_for, hilbert_key, nearest


def exact(rows, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v]
    usable = [(i, v) for i, v in usable if len(v) == 6 and np.isfinite(v).all() and v.any()]
    result = set()
    for query, vector in usable:
        if query % 20 == 0:
            scores = sorted((-round(float((vector * other).sum()), 12), i) for i, other in usable if i != query)
            result |= {(query, place, i) for place, (_, i) in enumerate(scores[:k], 1)}
    return result


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_steps_to_neighbours(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = np.stack([axis.ravel() for axis in axes], axis=1)
    key = hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_equals_brute_force_where_windows_hold_all(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 2, 3, 0, 0, 1]) for i in range(120)]  # one vector many times, and ties
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 1, 1, 1, 1]), (2060, [float("nan")] + [1.0] * 5)]
    rows += [(2080, [float("inf")] * 6), (2100, [1.0, 2]), (None, [1.0] * 6), (2120, [50.0, 1, 1, 1, 1, 1]), (2140, [])]
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = nearest(df, F.col("vec_id") % 20 == 0, k=20, curves=2, window=600, block=64).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == exact(rows, 20)
    assert all(abs(r["score"]) < 1e9 for r in got)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest(df, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 3, 0.5)]
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_with_bounded_windows(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 6))
    rows = [(i, (centres[i % 40] + 0.3 * rng.normal(size=6)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") % 20 == 0, curves=8, projected=4, window=150, block=256).collect()
    want = exact(rows, 20)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(found & {(q, i) for q, _, i in want}) >= 0.9 * len(want)


def test_orders_grow_with_the_rows(spark):
    assert curves_for(1000) == curves_for(49_152) == CURVES and curves_for(200_000) == 48
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(6000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") % 60 == 0, window=64, block=1024).collect()
    scores = vectors[::60] @ vectors.T
    scores[np.arange(100), np.arange(0, 6000, 60)] = -np.inf
    want = {(60 * q, int(i)) for q, row in enumerate(np.argsort(-scores, axis=1)[:, :20]) for i in row}
    assert len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)


@pytest.mark.parametrize("lengths", ["one long", "log-normal", "two kinds"])
def test_recall_on_vectors_of_unequal_length(spark, lengths):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(6000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if lengths == "one long":
        vectors[17] *= 1000
    elif lengths == "log-normal":
        vectors *= np.exp(rng.normal(size=6000))[:, None]
    else:
        vectors[::2] *= 20
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = nearest(df, F.col("vec_id") % 60 == 0, window=64, block=1024).collect()
    scores = vectors[::60] @ vectors.T
    scores[np.arange(100), np.arange(0, 6000, 60)] = -np.inf
    want = {(60 * q, int(i)) for q, row in enumerate(np.argsort(-scores, axis=1)[:, :20]) for i in row}
    assert len({(r["query_id"], r["vec_id"]) for r in got} & want) >= 0.9 * len(want)
