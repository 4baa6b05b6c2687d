import heapq
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import DOCS, odd_texts, with_clashes

from visitscope.llm import sharding as S
from visitscope.llm.catalog import op6_sharding


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=8), st.integers(1, 60), st.integers(0, 300))
def test_level_is_the_heap(loads, size, count):
    heap = sorted((load, i) for i, load in enumerate(loads))
    for _ in range(count):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
    given_out = S.level(np.array(loads, dtype=np.int64), size, count)
    assert given_out.sum() == count
    assert sorted(np.array(loads) + given_out * size) == sorted(load for load, _ in heap)


def lpt(sizes, shards):
    heap = [0] * shards
    for s in sorted(sizes, reverse=True):
        heapq.heapreplace(heap, heap[0] + s)
    return sorted(heap)


def check(rows, found, shards):
    """Loads are those of plain LPT, equal texts share a shard, slots have no gaps."""
    groups, load, slots, where = defaultdict(int), defaultdict(int), defaultdict(list), defaultdict(set)
    for _, text in rows:
        groups[text or ""] += len((text or "").encode()) + 16
    for r in found:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted([load[s] for s in range(shards)]) == lpt(groups.values(), shards)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    texts = defaultdict(set)
    for i, t in rows:
        texts[i].add((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())))
    for r in found:
        assert (r.size, r.text_crc32) in texts[r.doc_id]
        where[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert len(found) == len(rows)


def test_odd_rows(spark):
    rows = odd_texts()
    check(rows, S.assign(with_clashes(spark, rows), shards=5).collect(), 5)
    assert S.assign(spark.createDataFrame([], DOCS)).count() == 0


def test_hot_group_and_many_equal_sizes(spark):
    rows = [(k, "the same text") for k in range(300)] + [(1000 + k, f"{k:05d}") for k in range(500)]
    check(rows, S.assign(spark.createDataFrame(rows, DOCS).repartition(6), shards=7).collect(), 7)


def test_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = op6_sharding(spark, sf).collect()
    check(rows, found, 40)
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
