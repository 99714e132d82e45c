"""What the text operators share: written tables, code for the workers, plain columns."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import wattline
from wattline.session import shared_folder

#: White space as the contracts define it, inside a character class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, safe from lost executors."""
    folder = shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_of(column: str) -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of the frame has."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of the bitmap of ``possibly_in`` for each key, and the fewest and most of all (as powers of two).
BITS_A_KEY, FEWEST, MOST = 16, 22, 27


def possibly_in(rows: DataFrame, keys: DataFrame, column: str, bits: int | None = None) -> DataFrame:
    """The rows whose ``column`` is among ``keys``, and perhaps some others, without shuffling the rows.

    A bitmap of the keys' hashes, in rows of 64 bits, is broadcast. It has ``BITS_A_KEY`` bits a key, so about one other
    row in sixteen passes, but 2 ** ``MOST`` bits (2 million rows, 32 MB) at most: with more than eight million keys more of the
    others pass. None with a key is lost. Null is no key. Keys are read twice, to be counted and to be set.
    """
    if bits is None:
        bits = min(MOST, max(FEWEST, (BITS_A_KEY * keys.count()).bit_length()))
    place = f"shiftrightunsigned(xxhash64(`{column}`), {64 - bits})"
    cell, bit = F.expr(f"shiftright({place}, 6)"), F.expr(f"shiftleft(1L, CAST({place} & 63 AS INT))")
    names = fresh(rows, "cell"), fresh(rows, "cell_bits")
    bitmap = keys.filter(F.col(column).isNotNull()).groupBy(cell.alias(names[0])).agg(F.bit_or(bit).alias(names[1]))
    kept = rows.withColumn(names[0], cell).join(F.broadcast(bitmap), names[0])
    return kept.filter(F.col(names[1]).bitwiseAND(bit) != 0).select(*rows.columns)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers through the shared folder, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_wattline_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(wattline.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, files in os.walk(root):
            for file in sorted(files):
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark, 'code')}/wattline.zip")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(path.toString())
    context._wattline_shipped = True


def give_back() -> None:
    """Return freed memory to the system, so that workers that wait for their next task stay small."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def slices(sizes: list[int], most: int) -> Iterator[slice]:
    """Consecutive rows of about ``most`` in total size; a larger row stands alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def spread_out(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i] .. starts[i] + counts[i] - 1 of every i, one after another."""
    total = int(counts.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift
