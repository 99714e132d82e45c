"""Small documents with everything that real ones bring along."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
        StructField("source", StringType()), StructField("n_chars", LongType()),
        # names that operators use for columns of their own
        StructField("kept", StringType()), StructField("size", IntegerType()), StructField("word", StringType()),
        StructField("root", StringType()), StructField("row", StringType()),
    ]
)
LONG = " ".join(f"wort{i % 977} und{i % 31}" for i in range(30_000))
ROWS = [
    (1, "one two three four five six seven eight", "en", "b", 3),
    (2, "one two three  four five six seven\neight ", "en", "b", 3),
    (3, None, "en", None, None),
    (4, "", None, "a", 0),
    (5, " \t\n\x0b\x0c\r ", "de", "a", 0),
    (6, LONG, "de", "c", 5),
    (7, LONG + " ende", "de", "c", 5),
    (8, "onetwothreefourfivesixseveneight", None, "é", 3),
    (9, "12 34 — !", "en", "", 1),
    (9, "12 34 — !", "en", "", 1),
    (9, "another text with the same id", "en", "", 1),
    (None, "a row without an id", "en", "b", 1),
    (None, "one two three four five six seven eight", "en", "b", 1),
    (10, "x", "en", "b", 1),
    (11, "ünïcödé 漢字 🎉 text", "de", "𝄞", 1),
    (-12, "ÜNÏCÖDÉ 漢字 🎉 text", "de", "￼", 1),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*row, "x", 1, "y", "z", "r") for row in rows], SCHEMA)


def empty(spark):
    return documents(spark, [])
