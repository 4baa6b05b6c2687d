"""Operator 10: benchmark decontamination by size-partitioned MinHash containment search.

Test items are parted by the number of their distinct 5-word shingles, a class
for each power of two. An item's sketch holds its least shingle hashes, as
many as a document may miss at the largest size of the class, and one more.
A document that contains the demanded share of an item therefore holds at
least one hash of its sketch, however long it is: the search loses nothing.
Documents that meet a sketch are verified by exact containment of shingles.

Words are lower case, runs of other than space and 0x09-0x0D. An item of
fewer than five words has one shingle of all its words.

On Spark: items, their sketches and the texts that meet one are written tables.
A bitmap of at most `FILTER_BITS` bits over the sketch hashes, which is all of
the benchmark that reaches the driver and every worker, tells most shingles of a
document apart in one map over the texts. Hashes that pass are joined to the
sketch table, so what the bitmap lets through by chance falls away; Spark
splits a hash that very many documents hold. Candidate pairs bring each
document and its items together, one item at a time, for the exact check.

Defined results: an item without words (null, empty) matches nothing; items
that repeat are reported each; a null id of an item or a document is reported
as it is; rows that repeat are reported each; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, staged, text_or_empty, texts
from .wordhash import ngrams, pieces, words_of

SHINGLE = 5
CONTAINMENT = 0.8
FILTER_BITS = 1 << 27   # 16 MB, whatever the benchmark's size
BITS_A_HASH = 1 << 14  # so that few documents pass by chance
CHUNK_BYTES = 2 << 20


def missing(size: int, share: float) -> int:
    """How many of `size` shingles a document may lack and still contain `share` of them."""
    return size - math.ceil(share * size - 1e-9)


def words_in(text: str) -> list[bytes]:
    return text.lower().encode().split()


def distinct_shingles(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set()


def sketch(text: str, share: float = CONTAINMENT, shingle: int = SHINGLE) -> tuple[int, int, list[int]]:
    """(words of a shingle, distinct shingles, least hashes) of an item; a longer sketch for a larger class of sizes."""
    data = text.lower().encode()
    words = data.split()
    n = min(shingle, len(words))
    if not n:
        return 0, 0, []
    size = len(distinct_shingles(words, n))
    largest = (1 << size.bit_length()) - 1
    hashes = np.unique(ngrams(words_of([data]).hashes, n))
    return n, size, hashes[:missing(largest, share) + 1].view(np.int64).tolist()


def _sketch_table(items: DataFrame, share: float) -> DataFrame:
    """(item, n, size_class, hash): every sketch hash of every item."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
            n, size, hashes = sketch(text, share)
            rows += [(item, n, size.bit_length(), h) for h in hashes]
        item, n, size_class, hashes = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.record_batch([pa.array(item, pa.int64()), pa.array(n, pa.int32()), pa.array(size_class, pa.int32()),
                                pa.array(hashes, pa.int64())], names=["item", "n", "size_class", "hash"])

    return staged(map_batches(items.select("item", "text"), run, "item long, n int, size_class int, hash long"), "sketches")


class Bitmap:
    """Which hashes may be in a table: one bit for each value of their last bits."""

    def __init__(self, sketches: DataFrame, hashes: int, most: int):
        self.bits = max(64, min(most, 1 << (BITS_A_HASH * max(1, hashes)).bit_length()))
        place = F.col("hash").bitwiseAND(F.lit(self.bits - 1))
        # At most one row for 64 bits comes to the driver.
        held = (sketches.select((place / 64).cast("long").alias("word"), F.expr("shiftleft(1L, CAST(hash & 63 AS INT))").alias("bit"))
                .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
        self.words = np.zeros(self.bits // 64, dtype=np.uint64)
        self.words[held.column("word").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & np.uint64(self.bits - 1)
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _hits(batch: list[bytes], bitmap: Bitmap, sizes: list[int]) -> dict[int, list[tuple[int, int]]]:
    """By text, the distinct (words of a shingle, hash) that may be in a sketch."""
    words, found = words_of(batch), {}
    for n in sizes:
        grams = ngrams(words.hashes, n)
        at = np.flatnonzero(bitmap.may_hold(grams))
        text = np.searchsorted(words.first, at, side="right") - 1
        whole = at + n <= words.first[text + 1]
        for t, h in sorted(set(zip(text[whole].tolist(), grams[at[whole]].view(np.int64).tolist(), strict=True))):
            found.setdefault(t, []).append((n, h))
    return found


def _near_texts(rows: DataFrame, bitmap, sizes: list[int]) -> DataFrame:
    """(doc, doc_id, text, hits): the texts with a shingle that may be in a sketch, numbered by the written table."""
    schema = "doc long, doc_id long, text string, hits array<struct<n:int,hash:long>>"
    hit = pa.list_(pa.struct([("n", pa.int32()), ("hash", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        held = bitmap.value
        at, hits = [], []
        for begin, part in pieces([t.lower().encode() for t in texts(batch.column("text"))], CHUNK_BYTES):
            for t, found in sorted(_hits(part, held, sizes).items()):
                at.append(begin + t)
                hits.append([{"n": n, "hash": h} for n, h in found])
        kept = batch.take(pa.array(at, pa.int64()))
        return pa.record_batch([*kept.columns, pa.array(hits, hit)], names=[*kept.schema.names, "hits"])

    return staged(map_batches(rows.withColumn("doc", F.monotonically_increasing_id()).select("doc", "doc_id", "text"), run, schema),
                  "near-texts")


def _verify(share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one document after another: the document, then its items."""
        doc, doc_id, words, held = None, None, [], {}
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["item"] is None:
                    doc, doc_id, words, held = row["doc"], row["id"], words_in(row["text"]), {}
                    continue
                if row["doc"] != doc:
                    raise RuntimeError("an item without its document")
                own = words_in(row["text"])
                n = min(SHINGLE, len(own))
                shingles = distinct_shingles(own, n)
                if n not in held:
                    held[n] = distinct_shingles(words, n)
                shared = len(shingles & held[n])
                if shared >= len(shingles) - missing(len(shingles), share):
                    out.append((doc_id, row["id"], shared, len(shingles), shared / len(shingles)))
            if out:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                      names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, share: float = CONTAINMENT, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of every document that contains `share` of an item."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"
    items = staged(benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"),
                                    text_or_empty(item_text_col).alias("text")), "items")
    sketches = _sketch_table(items, share)
    held = sketches.agg(F.count(F.lit(1)).alias("hashes"), F.sort_array(F.collect_set("n")).alias("sizes")).first()
    if not held["hashes"]:
        return spark.createDataFrame([], schema)
    bitmap = spark.sparkContext.broadcast(Bitmap(sketches, held["hashes"], filter_bits))
    near = _near_texts(rows, bitmap, held["sizes"])
    met = near.select("doc", F.inline("hits"))
    pairs = met.join(sketches, ["n", "hash"]).select("doc", "item").distinct()
    asked = pairs.join(items, "item").select("doc", "item", F.col("item_id").alias("id"), "text")
    shown = near.select("doc", F.lit(None).cast("long").alias("item"), F.col("doc_id").alias("id"), "text")
    together = shown.unionByName(asked).repartition("doc").sortWithinPartitions("doc", F.col("item").asc_nulls_first())
    return together.mapInArrow(_verify(share), schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, share: float = CONTAINMENT, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose text contains `share` of a test item; null ids and columns stay as they are."""
    key = F.xxhash64(text_or_empty(text_col))
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), key.alias("key"))
    # Texts stand for themselves, so rows with a null or repeated id are judged one by one.
    bad = find_items(packed.select(F.col("key").alias("k"), F.col(f"row.`{text_col}`").alias("t")), benchmark, share, "k", "t")
    bad = staged(bad.select(F.col("doc_id").alias("key")).distinct(), "contaminated")
    return packed.join(bad, "key", "left_anti").select("row.*")
