import hashlib
import re
from collections import defaultdict

import pytest

from tests.llm.data import ROWS, documents, empty
from wattline.llm.mixing import mix, mixed_documents


def expected(rows):
    """Sort by hash and take the cut that lies nearest to what is left of the target."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")) for row in rows]
    sums = defaultdict(int)
    for row, n in zip(rows, size):
        sums[row[3]] += n
    order = sorted(sums, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {source: i % 3 + 1 for i, source in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        level = (sum(sums.values()) - sum(3 * sums[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sums[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * sums[s] if s in capped else level * weight[s] for s in order}
    place = [int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:15], 16) >> 10 for r in rows]
    result = []
    for source in order:
        rounds = int(target[source] // sums[source]) if sums[source] else 0
        budget, reached, last = target[source] - rounds * sums[source], 0, -1
        leaves = defaultdict(int)
        for row, n, p in zip(rows, size, place):
            if row[3] == source and n:
                leaves[p] += n
        for p in sorted(leaves):
            if reached + leaves[p] <= budget or reached < budget and reached + leaves[p] - budget < budget - reached:
                last = p
            reached += leaves[p]
        result += [
            (row[0], n, sums[source], target[source], n * (rounds + (p <= last)))
            for row, n, p in zip(rows, size, place)
            if row[3] == source
        ]
    return sorted(map(repr, result))


@pytest.mark.parametrize("extra", [0, 400])
def test_equals_sorting(spark, extra):
    rows = [*ROWS, *((1000 + i, "w " * (i * 7 % 90), "en", f"s{i % 11}" if i % 3 else "hot", 1) for i in range(extra))]
    got = [tuple(row) for row in mix(documents(spark, rows), bits=10, levels=5).collect()]
    want = expected(rows)
    assert sorted(map(repr, got)) == want


def test_documents_are_repeated_as_taken(spark):
    rows = [(i, "w " * (1 + i % 5), "en", "ab"[i % 4 == 0], 1) for i in range(300)]
    taken = {row.doc_id: row.taken // row.size for row in mix(documents(spark, rows)).collect()}
    mixed = mixed_documents(documents(spark, rows))
    assert mixed.columns == documents(spark).columns
    counts = {row.doc_id: row["count"] for row in mixed.groupBy("doc_id").count().collect()}
    assert counts == {doc: times for doc, times in taken.items() if times}


def test_near_target_and_empty(spark):
    rows = [(i, "w " * 3, "en", f"s{i % 3}", 1) for i in range(1000)]
    by = mix(documents(spark, rows)).groupBy("source_size", "target").sum("taken").collect()
    assert all(abs(row["sum(taken)"] - row["target"]) <= 3 for row in by)
    assert mix(empty(spark)).count() == 0
    assert mixed_documents(empty(spark)).count() == 0
