"""The registered queries on the small test tables: SQL, and the contracts that SQL can't express."""

import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_near_dedup import classes_by_brute_force
from wattline.llm.catalog import QUERIES, SQL
from wattline.llm.common import table, written

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in ("documents", "pages", "conversations"):
        duck.execute(f"CREATE VIEW {file} AS SELECT * FROM '{FOLDER}/{file}.parquet'")
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    found = duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    rows = result.select(*columns).collect()
    assert sorted(tuple(map(repr, row)) for row in rows) == sorted(tuple(map(repr, row)) for row in found)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(SQL) <= set(oracle_sql())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}


def test_token_files_hold_what_the_library_makes(spark):
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = sorted((row["doc_id"], row["text"] or "") for row in table(spark, FOLDER, "documents").collect())
    want, start = [], 0
    for doc, text in docs:
        ids = np.array([*made.encode(text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = QUERIES["op7_token_files"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == want


def test_byte_bpe_decodes_to_the_text(spark):
    texts = {row["doc_id"]: row["text"] or "" for row in table(spark, FOLDER, "documents").collect()}
    rows = QUERIES["op2_byte_bpe"](spark, FOLDER).collect()
    assert {row["doc_id"]: row["decoded_sha256"] for row in rows} == {
        doc: hashlib.sha256(text.encode()).hexdigest() for doc, text in texts.items()
    }


def test_neighbours_reach_nine_tenths(spark):
    rows = table(spark, FOLDER, "embeddings").collect()
    ids, vectors = np.array([row["vec_id"] for row in rows]), np.array([row["embedding"] for row in rows], float)
    got = QUERIES["op6_neighbours"](spark, FOLDER).collect()
    asked = np.flatnonzero(ids % 20 == 0)
    assert len(got) == 20 * len(asked)
    found, hits = {(row["query_id"], row["vec_id"]) for row in got}, 0
    for i in asked:
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        hits += sum((ids[i], ids[j]) in found for j in np.argsort(-scores)[:20])
    assert hits >= 0.9 * len(got)


def test_pipeline_stages(spark):
    docs = table(spark, FOLDER, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], FOLDER), "stage"))
    assert all(frame.columns == docs.columns for frame in frames[:-1])
    start, language, exact, near, mixed = ([(r["doc_id"], r["text"]) for r in f.collect()] for f in frames[:-1])
    letters = {doc for doc, text in start if any(c.isalpha() for c in text or "")}
    assert {doc for doc, _ in language} == letters
    bare = {doc: "".join((text or "").split()) for doc, text in language}
    assert sorted(bare[doc] for doc, _ in exact) == sorted(set(bare.values()))
    label = classes_by_brute_force(exact)
    assert {doc for doc, _ in near} >= {doc for doc in label if label[doc] == doc}
    assert len(near) <= 1.05 * len(set(label.values()))
    assert {doc for doc, _ in mixed} <= {doc for doc, _ in near}
    assert sorted(row["doc_id"] for row in frames[-1].collect()) == sorted(doc for doc, _ in mixed)
    assert all(row["n_tokens"] * 4 == len(row["token_ids"]) for row in frames[-1].collect())


def test_run(spark):
    first = corpus_pipeline.run(spark, FOLDER).select("doc_id", "n_tokens", "decoded_sha256")
    again = queries()["pipeline"](spark, FOLDER).select("doc_id", "n_tokens", "decoded_sha256")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
