"""Helpers that the text operators share."""

import pytest
from pyspark.sql import functions as F

from wattline.llm.common import possibly_in


@pytest.mark.parametrize("bits", [None, 7, 22])
def test_bitmap_loses_no_key(spark, bits):
    rows = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("cell")).unionByName(spark.sql("SELECT CAST(NULL AS LONG) k, 'y' cell"))
    keys = spark.range(0, 5000, 10).select(F.col("id").alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS LONG) k"))
    found = possibly_in(rows, keys, "k", bits)
    assert found.columns == rows.columns
    got = {row["k"] for row in found.collect()}
    assert got >= set(range(0, 5000, 10))
    if bits != 7:  # seven bits are all set
        assert len(got) < 600 and None not in got


def test_no_keys(spark):
    assert possibly_in(spark.range(10), spark.range(0), "id").count() == 0
