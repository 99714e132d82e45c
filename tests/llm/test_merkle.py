"""The manifest against trees that are built level by level."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import ROWS, documents, empty
from wattline.llm import merkle
from wattline.llm.running import running


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return sha(*("-" if value is None else f"{len(str(value).encode())}:{value}" for value in values))


def tree_of(leaves, fan):
    """The root, and for every leaf what stands left and right of its ancestors."""
    paths, places, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        runs = [nodes[i : i + fan] for i in range(0, len(nodes), fan)]
        for path, i in zip(paths, range(len(places))):
            run, place = divmod(places[i], fan)
            path.append(("".join(runs[run][:place]), "".join(runs[run][place + 1 :])))
            places[i] = run
        nodes = [sha(*run) for run in runs]
    return nodes[0], paths


def by_brute_force(rows, fan=16, every=5):
    """rows: doc_id, text, lang, source, n_chars"""
    sources = {}
    for doc, text, lang, source, n in rows:
        changed = None
        if doc is not None and zlib.crc32(str(doc).encode()) % every == 0:
            low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            changed = leaf_of((doc, source, lang, n, low))
        sources.setdefault(source, []).append((doc, leaf_of((doc, source, lang, n, text)), changed))
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    made = {}
    for name in names:
        sources[name].sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
        made[name] = tree_of([leaf for _, leaf, _ in sources[name]], fan)
    root, above = tree_of([made[name][0] for name in names], fan)
    out = []
    for name, upper in zip(names, above):
        subroot, paths = made[name]
        for (doc, leaf, changed), path in zip(sources[name], paths):
            folded = changed or leaf
            for left, right in path + upper:
                folded = sha(left, folded, right)
            proof = sha(*(left + right for left, right in path + upper))
            out.append((doc, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def found(docs, every=5, **options):
    return sorted(map(tuple, merkle.proofs(merkle.manifest(docs, changed=merkle.tampered(docs, every=every), **options)).collect()), key=repr)


@pytest.mark.parametrize("levels,fan", [(4, 16), (2, 2), (3, 2), (2, 3), (1, 2)])
def test_addresses_fill_a_tree_once(levels, fan):
    places = [merkle.address(depth, np.arange(fan**depth), levels, fan) for depth in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.nodes_in(levels, fan)))


def test_lower_subtrees_lie_together():
    # Two levels above, two below: the children of a node of depth 2 follow it.
    for node in (0, 7, 255):
        start = int(merkle.address(2, np.array([node]), 4)[0])
        assert merkle.address(3, np.arange(16 * node, 16 * node + 16), 4).tolist() == list(range(start + 1, start + 17))


def test_dirty_documents(spark):
    assert found(documents(spark), every=2) == by_brute_force([row[:5] for row in ROWS], every=2)


@pytest.mark.parametrize("levels,fan", [(4, 16), (2, 16), (2, 3)])
def test_tiers_equal_brute_force(spark, levels, fan):
    # One source has most rows, some have one; 40 sources make several tiers of subroots where blocks are small.
    rows = [(i * 7 % 401, f"Text {i}", "en", f"s{i % 40}" if i % 3 else "hot", i) for i in range(400)]
    assert found(documents(spark, rows).repartition(7), levels=levels, fan=fan) == by_brute_force(rows, fan)


@pytest.mark.parametrize("n", [1, 16, 17, 257])
def test_whole_and_lone_blocks(spark, n):
    rows = [(i, "T", "en", "s", i) for i in range(n)]
    assert found(documents(spark, rows), levels=3) == by_brute_force(rows)


def test_empty(spark):
    assert found(empty(spark)) == []


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = [(1, "Same", "en", "s", 4)] * 300
    assert found(documents(spark, rows).repartition(5), levels=2) == by_brute_force(rows)


def test_any_change_shows(spark):
    docs = documents(spark, [(i, f"plain {i}", "en", "s", 1) for i in range(40)])
    changed = merkle.digest([F.col(name) if name != "n_chars" else F.col(name) + 1 for name in merkle.FIELDS])
    assert not any(row["verified"] for row in merkle.proofs(merkle.manifest(docs, changed=changed)).collect())
    assert all(row["verified"] for row in merkle.proofs(merkle.manifest(docs)).collect())


def test_running_totals_of_a_hot_key(spark):
    rows = [(("hot" if i % 3 else f"k{i % 50}"), i % 17, i, (i * 7919) ^ (i << 40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, o long, n long, x long").repartition(6)
    got = running(df, "key", ["o", "n"], sums=["n"], xors=["x"]).collect()
    want = {}
    for key, _, n, x in sorted(rows):
        at, total, mix = want.get(key, (0, 0, 0))
        want[key] = (at + 1, total + n, mix ^ x)
        want[key, n] = (at, total, mix)
    assert len(got) == len(rows)
    assert all((row["at"], row["before_n"], row["before_x"]) == want[row["key"], row["n"]] for row in got)
