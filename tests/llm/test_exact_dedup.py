import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.data import ROWS, documents, empty
from wattline.llm.exact_dedup import copies, drop_copies


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for number, row in enumerate(rows):
        groups[bare(row[1])].append((*row, number))
    result = []
    for text, members in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        for member in members:
            result.append((member[0], best[0], len(members), member[-1] == best[-1], digest))
    return Counter(result)


def found(df):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(tuple(row) for row in df.select(*names).collect())


@pytest.mark.parametrize("clashing", [False, True])
def test_equals_brute_force(spark, clashing):
    rows = [*ROWS, *((100 + i, "ab" * (i % 7) + "cd" * (i % 5), "en", "b", 1) for i in range(60))]
    # With two names for all chunks, different texts share recipes, and their texts must tell them apart.
    name = (lambda c: F.pmod(F.xxhash64(c), F.lit(2))) if clashing else F.xxhash64
    assert found(copies(documents(spark, rows), shortest=4, longest=8, name=name)) == expected(rows)


def test_stage_keeps_one_row_of_each_group(spark):
    kept = drop_copies(documents(spark))
    assert kept.columns == documents(spark).columns
    texts = [bare(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted({bare(row[1]) for row in ROWS})


def test_empty_table(spark):
    assert copies(empty(spark)).count() == 0
    assert drop_copies(empty(spark)).count() == 0
