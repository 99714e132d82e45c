"""Places and running totals within a key, without bringing the rows of a key together.

Rows are range-partitioned by key, then by the given order, so a key of any size is spread over many tasks.
Each task counts on its own; what stands before a task's first key is then added from one row
for the first and one for the last key of each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ship, written


def _local(batches: Iterator[pa.RecordBatch], key: str, sums: list[str], xors: list[str]) -> Iterator[pa.RecordBatch]:
    part, last, count = TaskContext.get().partitionId(), None, 0
    total = dict.fromkeys([*sums, *xors], np.int64(0))
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        keys, index = batch.column(key), np.arange(rows)
        new = np.ones(rows, bool)
        new[0] = last is None or keys[0].as_py() != last
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
        begin = np.maximum.accumulate(np.where(new, index, -1))
        carried, begin = begin < 0, np.maximum(begin, 0)
        at = index - begin + np.where(carried, count, 0)
        before = []
        for name in [*sums, *xors]:
            value = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
            if name in sums:
                run = np.cumsum(value) - value
                run = run - np.where(carried, -total[name], run[begin])
                total[name] = run[-1] + value[-1]
            else:
                run = np.bitwise_xor.accumulate(value) ^ value
                run = run ^ np.where(carried, total[name], run[begin])
                total[name] = run[-1] ^ value[-1]
            before.append(pa.array(run))
        last, count = keys[rows - 1].as_py(), int(at[-1]) + 1
        added = [pa.array(np.full(rows, part, np.int32)), pa.array(at), *before]
        names = ["part", "at", *(f"before_{name}" for name in [*sums, *xors])]
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, *names])


def running(rows: DataFrame, key: str, order: list[str], sums: list[str] = (), xors: list[str] = ()) -> DataFrame:
    """The rows with ``at``, the number of rows before them in their key, and for each column of ``sums`` and ``xors`` its
    sum or exclusive or over those rows as ``before_...``. Key and totalled columns (long) have no nulls.

    Rows that tie in ``order`` stand in any order; give an order that leaves no ties between rows that differ.
    """
    ship(rows.sparkSession)
    sums, xors = list(sums), list(xors)
    found = [f"before_{name}" for name in [*sums, *xors]]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "part int", "at long", *(f"{name} long" for name in found)])
    counted = written(
        rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInArrow(lambda batches: _local(batches, key, sums, xors), schema),
        "running",
    )
    # One row for the first key of a part, which asks, and one for its last key, which tells what the part has of it.
    tells = {"at": F.col("at") + 1}
    tells |= {f"before_{name}": F.col(f"before_{name}") + F.col(name) for name in sums}
    tells |= {f"before_{name}": F.col(f"before_{name}").bitwiseXOR(F.col(name)) for name in xors}
    last = F.struct(F.col(key).alias("key"), *(value.alias(f"add_{name}") for name, value in tells.items()))
    ends = counted.groupBy("part").agg(F.min(key).alias("first"), F.max_by(last, F.struct(key, "at")).alias("last"))
    asking = ends.select("part", F.lit(0).alias("kind"), F.col("first").alias("key"), *(F.lit(0).cast("long").alias(f"add_{name}") for name in tells))
    rest = asking.unionByName(ends.select("part", F.lit(1).alias("kind"), "last.*"))
    earlier = Window.partitionBy("key").orderBy("part", "kind").rowsBetween(Window.unboundedPreceding, -1)
    total = {name: F.sum for name in ["at", *(f"before_{name}" for name in sums)]} | {f"before_{name}": F.bit_xor for name in xors}
    offsets = rest.select("part", "kind", "key", *(F.coalesce(f(f"add_{name}").over(earlier), F.lit(0)).alias(f"add_{name}") for name, f in total.items()))
    # At most one row for each part, so its size is bounded by the number of tasks.
    offsets = F.broadcast(offsets.filter("kind = 0 AND add_at > 0").select(F.col("part").alias("in_part"), F.col("key").alias("in_key"), *(f"add_{name}" for name in total)))
    joined = counted.join(offsets, (F.col("part") == F.col("in_part")) & (F.col(key) == F.col("in_key")), "left")

    def added(name: str):
        more = F.coalesce(F.col(f"add_{name}"), F.lit(0).cast("long"))
        return (F.col(name).bitwiseXOR(more) if total[name] is F.bit_xor else F.col(name) + more).alias(name)

    return joined.select(*(F.col(f"`{name}`") for name in rows.columns), *map(added, total))
