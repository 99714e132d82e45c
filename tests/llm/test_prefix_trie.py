"""The trie against one that is built turn by turn."""

import hashlib
import random
import re
import zlib

import pytest

from wattline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, at int, n int, len int, k1 string, seg string, words string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, 3, "k", "s", "w") for row in rows], SCHEMA)


def sequences(rows, every=None, most=4):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda row: (row[1] is not None, row[1] or 0, _tie(row))):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    if every is None:
        return own
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % most
        base = conv - (abs(conv) % every) * (1 if conv >= 0 else -1)
        made[conv] = own.get(base, [])[:h] + turns[h:]
    return made


def _tie(row):
    role, text = row[2] or "", row[3] or ""
    digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
    return [int.from_bytes(digest[i : i + 8], "big", signed=True) for i in (0, 8)]


def by_brute_force(made):
    members = {}
    for conv, turns in made.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    children = {node: [] for node in members}
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[child] for child in below) or 1
        saved[node] = sum(saved[child] for child in below) + (len(members[node]) - 1) * words
    rows = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(conv for conv in convs if len(made[conv]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(convs), len(node), parent, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def found(spark, rows, every=None, width=16):
    turns = prefix_trie.numbered_turns(conversations(spark, rows).repartition(5))
    convs = turns.select("conv_id").distinct()
    return sorted(map(tuple, prefix_trie.trie(turns if every is None else prefix_trie.grafted(turns, every), convs, width).collect()), key=repr)


def random_rows(n, longest, seed, words=3):
    pick = random.Random(seed)
    rows = []
    for conv in range(n):
        kind = pick.random()
        length = 0 if kind < 0.05 else pick.randrange(1, longest)
        for turn in range(length):
            text = "same start" if turn < 2 and kind < 0.6 else " ".join(pick.choice("ab") for _ in range(pick.randrange(words)))
            rows.append((conv - 10, turn if pick.random() < 0.95 else None, pick.choice(["user", None, ""]) if turn > 2 else "user", text))
    return rows


@pytest.mark.parametrize("width,every", [(16, None), (2, 5), (3, 20)])
def test_equals_brute_force(spark, width, every):
    rows = random_rows(150, 9, width)
    assert found(spark, rows, every, width) == by_brute_force(sequences(rows, every))


def test_hot_conversations_over_many_shards(spark):
    # Most conversations are the same one, one is long, and a shard has seven rows.
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(5)] + [(1000, t, "user", f"turn {t} of many") for t in range(100)]
    rows += [(c, t, "user", f"turn {t}") for c in range(2000, 2040) for t in range(c % 9)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert found(spark, rows, None, 4) == by_brute_force(sequences(rows))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_dirty_conversations(spark):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, None, None), (1, None, None, None), (1, 2, "user", "x y"), (1, 2, "user", "x y"), (1, 2, "bot", "z"),
        (2, 5, "", ""), (2, None, "", ""), (-3, 0, "a", "b c"), (-3, 1, "ab", "c"), (4, 0, "ab", " c"), (5, 0, "long", "wort " * 50_000),
        (6, 0, "long", "wort " * 50_000), (6, 1, "\n", "é 漢字 🎉"),
    ]
    assert found(spark, rows) == by_brute_force(sequences(rows))
    assert found(spark, rows, 2) == by_brute_force(sequences(rows, 2))


def test_empty(spark):
    assert found(spark, []) == []


def test_a_conversation_without_turns_ends_at_the_root(spark):
    rows = [(c, 0, "user", "hi") for c in range(1, 8)]  # none has a base, so those with h > 0 lose their turn
    made = sequences(rows, 20)
    assert [] in made.values()
    assert found(spark, rows, 20) == by_brute_force(made)
