import base64
import hashlib
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tests.llm.data import ROWS, documents, empty
from wattline.llm import bpe
from wattline.llm.pieces import ChunkCache

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "漢", "1", "23", "!", "?!", "\x1c", "\x85", "\xa0", "🎉", "qx", "the", " the", "\r\n", "ſ", "́"]


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return bpe.Bpe(file.read(), public_tokenizers.PATTERN)


def test_equals_the_library(own, reference):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 1000, "ab" * 3000, " " * 3000, "\n" * 777, "é" * 2000, "=-" * 2000, "漢字" * 1500]
    texts += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20000))]
    texts += ["".join(rng.choice("theraniosd") for _ in range(700)) for _ in range(30)]
    ids = own.encode_texts(pa.array(texts))
    decoded = own.decode_rows(ids).to_pylist()
    for text, packed, back in zip(texts, ids.to_pylist(), decoded):
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == reference.encode_ordinary(text)
        assert back == text.encode()


def test_long_runs_merge_as_one_by_one(own):
    """The rule that merges many places at once against merging the leftmost lowest pair alone."""
    rng = random.Random(7)
    for alphabet in ("ab", "the", "aaab", "ha!", "noi"):
        raw = "".join(rng.choice(alphabet) for _ in range(300)).encode()
        ids = [own.rank[bytes([byte])] for byte in raw]
        token = {rank: value for value, rank in own.rank.items()}
        while True:
            ranks = [own.rank.get(token[a] + token[b], 1 << 40) for a, b in zip(ids, ids[1:])]
            if not ranks or min(ranks) == 1 << 40:
                break
            at = ranks.index(min(ranks))
            ids[at : at + 2] = [ranks[at]]
        assert own._merge_long(own.single[np.frombuffer(raw, np.uint8)]).tolist() == ids


def test_documents(spark, reference):
    docs = documents(spark)
    both = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert both.columns == [*docs.columns, "token_ids", "decoded"]
    rows = both.select("text", "token_ids", "decoded", bpe.n_tokens(both["token_ids"]).alias("n")).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        want = reference.encode_ordinary(row["text"] or "")
        assert bytes(row["token_ids"]) == struct.pack(f"<{len(want)}I", *want)
        assert row["n"] == len(want)
        assert hashlib.sha256(row["decoded"]).digest() == hashlib.sha256((row["text"] or "").encode()).digest()
    at_once = bpe.encode_and_decode(docs, PATH, public_tokenizers.PATTERN)
    assert at_once.columns == [name for name in both.columns if name != "text"]
    columns = ["doc_id", "source", "n_chars", "token_ids", "decoded"]
    assert sorted(map(repr, at_once.select(columns).collect())) == sorted(map(repr, both.select(columns).collect()))
    without = bpe.encode(docs.withColumn("Token_Ids", docs["doc_id"]), PATH, public_tokenizers.PATTERN, drop_text=True)
    assert without.columns == [*(name for name in docs.columns if name != "text"), "token_ids"]
    assert bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


class Letters:
    """A vocabulary of letters that counts what it is asked for."""

    def __init__(self):
        self.asked = Counter()

    def __call__(self, strings):
        self.asked.update(strings)
        found = [[ord(letter) for letter in text] for text in strings]
        return np.array([code for ids in found for code in ids], np.int64), np.array([len(ids) for ids in found], np.int64)


def test_frequent_chunks_are_encoded_once():
    letters = Letters()
    cache = ChunkCache(letters, remembered=40_000)
    rng = random.Random(3)
    for _ in range(200):
        texts = [" ".join(["the", "of", *(f"rare{rng.randrange(10**9)}" for _ in range(20))]) for _ in range(5)]
        made = list(cache.texts(texts))
        ids = np.concatenate([ids for ids, _ in made])
        assert "".join(map(chr, ids)) == "".join(texts)
        assert sum(int(counts.sum()) for _, counts in made) == len(ids)
        assert cache.young.size + cache.old.size < 200_000
    assert letters.asked[" of"] == 1 and letters.asked["the"] == 1


def test_a_worker_remembers_a_bounded_number_of_bytes():
    with open(PATH, "rb") as file:
        vocabulary = bpe.Bpe(file.read(), public_tokenizers.PATTERN)
    most = 0
    for part in range(40):
        vocabulary.encode_texts(pa.array([" ".join(f"{(part * 8000 + i) * 7919:x}q" for i in range(8000))]))
        held = [getattr(cache, name).size for cache in (vocabulary.cache, vocabulary.known) for name in ("young", "old")]
        most = max(most, sum(held))
    assert 30 << 20 < most < 48 << 20
