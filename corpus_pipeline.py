"""From raw documents to token ids: language, exact copies, near copies, mix of sources, ids.

Each stage takes the session, the documents its predecessor kept and the folder of the
tables, and returns what it keeps; the last one returns ids in place of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, exact_dedup, language, mixing, near_dedup
from wattline.llm.common import table, written

RANKS, PATTERN = "byte_bpe_50k.tiktoken", public_tokenizers.PATTERN


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go."""
    return language.in_known_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text that they decode to."""
    path = public_tokenizers.path(RANKS)
    encoded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), path, PATTERN)
    return encoded.select(
        "doc_id",
        "source",
        bpe.n_tokens(F.col("token_ids")).alias("n_tokens"),
        "token_ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", identify_language),
    ("exact copies", drop_exact_copies),
    ("near copies", drop_near_copies),
    ("mix", mix_sources),
    ("byte-level BPE", encode),
]

# Trained models, alignments and merges are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
