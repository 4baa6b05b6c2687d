"""Operator 6: longest-processing-time sharding of groups that stay together.

Rows with equal texts form a group. Groups sorted by size, largest first, go
to the shard with the least load, kept in a heap. Groups of one size are
interchangeable, so the heap runs over the histogram of group sizes (at most
sqrt(2 * total bytes) rows, whatever the number of documents), and each size
hands its groups out by their rank, which is computed in salted parts.

Defined results: null text is the empty text (size 16 bytes, CRC 0, one group
with other empty texts); rows that repeat keep one row each, in one shard,
with slots of their own; null ids sort first; an empty table has no rows;
other columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

ROW_OVERHEAD = 16


def level(loads: np.ndarray, size: int, count: int) -> np.ndarray:
    """How many of `count` items of `size` each shard gets, one after another to the least loaded.

    The first items are handed out together, up to the last level that surely
    lies below the final one; a heap gives out the rest, ties to the lower shard.
    """
    given = np.zeros(len(loads), dtype=np.int64)
    surely = (int(loads.sum()) + size * count) // len(loads) - size
    if size * count > 2 * size * len(loads) and surely > int(loads.min()):
        given = np.maximum(0, (surely - loads) // size)
        if given.sum() > count:
            given[:] = 0
    heap = [(int(load), i) for i, load in enumerate(loads + given * size)]
    heapq.heapify(heap)
    for _ in range(count - int(given.sum())):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        given[i] += 1
    return given


def plan_sizes(histogram: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """(size, running totals by shard) for (size, groups) rows that come largest size first."""
    loads = np.zeros(shards, dtype=np.int64)
    for size, count in histogram:
        given = level(loads, size, count)
        loads += given * size
        yield size, np.cumsum(given).tolist()


def assign(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): slots run from 0 without gaps within a shard."""
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = text_or_empty(text_col)
    rows = staged(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group")), "shard-rows")

    groups = rows.groupBy("group").agg(F.sum("size").alias("total"))
    groups = staged(groups.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts))), "shard-groups")
    histogram = groups.groupBy("total").agg(F.count(F.lit(1)).alias("groups"))
    ordered = histogram.repartition(1).sortWithinPartitions(F.desc("total"))

    def lay_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = ((int(t), int(n)) for b in batches for t, n in zip(b["total"], b["groups"], strict=True))
        block = []
        for row in plan_sizes(sizes, shards):
            block.append(row)
            if len(block) == 2000:
                yield pd.DataFrame(block, columns=["total", "ends"])
                block = []
        if block:
            yield pd.DataFrame(block, columns=["total", "ends"])

    plan = staged(ordered.mapInPandas(lay_out, "total long, ends array<long>"), "shard-plan")

    # Rank of a group among those of its size: groups before its part, and before it in its part.
    before = (groups.groupBy("total", "part").agg(F.count(F.lit(1)).alias("n"))
              .select("total", "part", (F.sum("n").over(
                  Window.partitionBy("total").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).alias("before")))
    within = F.row_number().over(Window.partitionBy("total", "part").orderBy("group")) - 1
    placed = (groups.withColumn("within", within).join(before, ["total", "part"])
              .withColumn("rank", F.col("within") + F.coalesce("before", F.lit(0)))
              .join(plan, "total")
              .select("group", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).alias("shard")))

    rows = rows.join(placed, "group").select(
        "id", "size", "text_crc32", "shard",
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).alias("part"))
    rows = staged(rows, "shard-placed")  # from here on the salt is a stored column
    offsets = (rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("shard", "part", F.sum("n").over(
                   Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("offset")))
    in_part = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size")) - 1
    return (rows.withColumn("in_part", in_part).join(offsets, ["shard", "part"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                    (F.coalesce("offset", F.lit(0)) + F.col("in_part")).cast("long").alias("slot")))
