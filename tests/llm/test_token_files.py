import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.data import ROWS, documents, empty
from wattline.llm.simple8b import RUN, pack, unpack
from wattline.llm.token_files import read_blocks, read_tokens, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("size", [0, 1, RUN - 1, RUN, RUN + 1, 5000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 1 << 29, 1 << 60, (1 << 64) - 1])
def test_simple8b_round_trip(size, top):
    rng = np.random.default_rng(size)
    numbers = rng.integers(0, top, size, dtype=np.uint64)
    numbers[::3] = 0
    numbers[4::7] = top
    assert (unpack(pack(numbers)) == numbers).all()


def test_small_numbers_take_little_room():
    assert len(pack(np.ones(6000))) < 1200
    assert len(pack(np.full(6000, 50256))) < 2.8 * 6000


SPECIAL = [
    "<|endoftext|>", " <|endoftext|>", "a  <|endoftext|>  b", "<|endoftext|><|endoftext|> x", "x<|endoftext|>\n", "<|endoftext|", "a <|endoftext|>" * 300,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 18])
def test_round_trip(spark, out, tokenizer, block_ids):
    rows = [*ROWS, (50, "a <|endoftext|> b", "en", "b", 1), (51, " leading  and trailing ", "en", "b", 1)]
    rows += [(i, text, "en", "b", 1) for i, text in enumerate(SPECIAL, 200)]
    rows += [(i, f"text {i}'ll go\n\n on " * (i % 5), "en", "b", 1) for i in range(60, 160)]
    write_tokens(documents(spark, rows), out, PATH, end_id=2, block_ids=block_ids)
    got = sorted((tuple(r) for r in read_tokens(spark, out).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    want = {}
    for row in rows:
        want.setdefault(row[0], []).append([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2])
    start = 0
    for doc, at, n, ids in got:
        assert at == start
        assert np.frombuffer(ids, "<u4").tolist() in want[doc] and n == len(ids) // 4
        start += n
    crc = {(r["start"], r["ids_crc32"]) for r in read_tokens(spark, out, crc=True).collect()}
    assert crc == {(at, zlib.crc32(ids)) for _, at, _, ids in got}
    if block_ids == 1:
        assert read_blocks(spark, out).count() >= 2


def test_empty_table(spark, out):
    write_tokens(empty(spark), out, PATH, end_id=2)
    assert read_tokens(spark, out).count() == 0


def test_rows_without_id_are_dealt_out(spark, out):
    rows = [(None if i % 2 else 7, f"text {i}", "en", "b", 1) for i in range(6000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one part
    try:
        write_tokens(documents(spark, rows), out, PATH, end_id=2)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = read_blocks(spark, out).select("part", "doc_ids").collect()
    assert len({row["part"] for row in parts if None in row["doc_ids"]}) > 1
    assert len({row["part"] for row in parts if 7 in row["doc_ids"]}) > 1
    got = sorted(read_tokens(spark, out).collect(), key=lambda row: row["start"])
    assert [row["doc_id"] for row in got] == [None] * 3000 + [7] * 3000
