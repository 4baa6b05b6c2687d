"""Operator 2: document fingerprints by randomised edit embedding.

A shared random walk reads a text: at every step it notes the character it
stands on, and a coin that depends on the step and the character decides
whether it moves on. Texts that differ in a few edits fall back into step, so
edit distance becomes Hamming distance of the walks. A fingerprint samples the
walk: of all steps of the walk the `SAMPLES` with the least random rank. As
ranks are shared, walks of different lengths sample the same steps where both
have them, and the share of agreeing samples is the texts' likeness.

Coins repeat every `PERIOD` steps and characters fall into `CLASSES` classes,
so the steps spent on a character are one look-up. Sampled characters are
noted as 8-bit hashes.

Candidate pairs share a band, a few sampled characters taken by bit sampling;
pairs are verified by their likeness. Defined results: null text is the empty
text, whose fingerprint is empty; two empty fingerprints have likeness 1, one
has likeness 0; the text after the last is the first (itself, if alone); rows
with equal ids follow each other by text, null ids come first; an empty table
gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, text_or_empty

SAMPLES = 64
PERIOD = 1 << 13
CLASSES = 1 << 7
SEED = 20240229
CHUNK = 1 << 20     # characters of the texts that walk together
FEW = 24            # so few texts walk faster one by one
BAND = 3            # sampled characters in a band
LEAST_LIKENESS = 0.8

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
Notes = tuple[np.ndarray, np.ndarray, int]


def _rank(steps: np.ndarray) -> np.ndarray:
    """The shared random rank of each step."""
    h = (steps.astype(np.uint64) + np.uint64(SEED)) * _GOLDEN
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _classes(points: np.ndarray) -> np.ndarray:
    return ((points.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(57)).astype(np.int32)


class Walks:
    """The shared coins and sampled steps, made from the seed alone."""

    def __init__(self, samples: int = SAMPLES):
        coins = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (CLASSES, PERIOD), dtype=np.uint8)
        stay = np.zeros((CLASSES, PERIOD), dtype=np.int64)
        ahead = np.full(CLASSES, PERIOD, dtype=np.int64)
        for at in [*reversed(range(PERIOD))] * 2:  # twice, as the coins repeat
            ahead = np.where(coins[:, at] == 1, 1, ahead + 1)
            stay[:, at] = ahead
        self.stay = stay.reshape(-1)  # steps a character takes from a step on, by class and step
        self.rows = [row.tolist() for row in stay]
        self.samples = samples
        self._least: dict[int, np.ndarray] = {}

    def sampled(self, length: int) -> np.ndarray:
        """The sampled steps of a walk of `length`, least rank first."""
        if length <= self.samples:
            steps = np.arange(length)
            return steps[np.argsort(_rank(steps), kind="stable")]
        reach = 1 << (length - 1).bit_length()
        if reach not in self._least:
            kept = np.zeros(0, dtype=np.int64)
            for at in range(0, reach, 1 << 20):  # over half of the steps lie below the length, so spares suffice
                kept = np.concatenate([kept, np.arange(at, min(reach, at + (1 << 20)))])
                kept = kept[np.argsort(_rank(kept), kind="stable")[:self.samples * 16]]
            self._least[reach] = kept
        kept = self._least[reach]
        return kept[kept < length][:self.samples]

    def arrivals(self, codes: list[np.ndarray], start: list[int]) -> list[np.ndarray]:
        """For each text (character classes), the step at which each character is reached, and the end."""
        order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
        sizes = np.array([len(codes[i]) for i in order], dtype=np.int64)
        flat = np.concatenate([codes[i] for i in order]) * np.int32(PERIOD) if order else np.zeros(0, dtype=np.int32)
        begin = np.cumsum(sizes) - sizes
        out = begin + np.arange(len(order))
        steps = np.zeros(len(flat) + len(order), dtype=np.int64)
        steps[out] = [start[i] for i in order]
        # Longest text first; each round moves all that still have a character by one.
        longest = int(sizes[0]) if order else 0
        live = np.searchsorted(-sizes, -np.arange(longest), side="left").tolist()
        together = next((c for c, n in enumerate(live) if n < FEW), longest)
        now = steps[out]
        for c in range(together):
            n = live[c]
            now = now[:n]
            now = now + self.stay[flat[begin[:n] + c] + (now & (PERIOD - 1))]
            steps[out[:n] + c + 1] = now
        for k in range(live[together] if together < longest else 0):
            at, own = int(steps[out[k] + together]), []
            for code in (flat[begin[k] + together:begin[k] + sizes[k]] // PERIOD).tolist():
                at += self.rows[code][at & (PERIOD - 1)]
                own.append(at)
            steps[out[k] + together + 1:out[k] + sizes[k] + 1] = own
        found: list[np.ndarray] = [steps[:0]] * len(codes)
        for k, i in enumerate(order):
            found[i] = steps[out[k]:out[k] + sizes[k] + 1]
        return found

    def note(self, points: np.ndarray, arrivals: np.ndarray) -> Notes:
        """(sampled steps, noted characters, length) of a walked text."""
        length = int(arrivals[-1])
        steps = self.sampled(length)
        which = np.searchsorted(arrivals, steps, side="right") - 1
        return steps, ((points[which].astype(np.uint64) * _GOLDEN) >> np.uint64(56)).astype(np.uint8), length

    def read(self, fingerprint: str) -> Notes:
        length, _, noted = fingerprint.partition("-")
        return self.sampled(int(length, 16)), np.frombuffer(bytes.fromhex(noted), dtype=np.uint8), int(length, 16)


_WALKS: dict[int, Walks] = {}


def walks(samples: int = SAMPLES) -> Walks:
    if samples not in _WALKS:
        _WALKS[samples] = Walks(samples)
    return _WALKS[samples]


def as_text(notes: Notes) -> str:
    """A fingerprint: the walk's length, which tells the sampled steps, and the noted characters, in hex."""
    return f"{notes[2]:x}-{notes[1].tobytes().hex()}"


def likeness(a: Notes, b: Notes) -> float:
    """Share of the longer walk's sampled steps at which the other notes the same character."""
    if a[2] < b[2]:
        a, b = b, a
    if not a[2] or not b[2]:
        return float(a[2] == b[2])
    if a[2] == b[2]:
        return float((a[1] == b[1]).mean())
    order = np.argsort(b[0])
    at = order[np.minimum(np.searchsorted(b[0], a[0], sorter=order), len(order) - 1)]
    return float(((b[0][at] == a[0]) & (b[1][at] == a[1])).mean())


def prints(texts: list[str], walk: Walks) -> tuple[list[np.ndarray], list[np.ndarray], list[Notes]]:
    """Characters, arrivals and notes of texts that walk together."""
    points = [_points(t) for t in texts]
    arrivals = walk.arrivals([_classes(p) for p in points], [0] * len(texts))
    return points, arrivals, [walk.note(p, a) for p, a in zip(points, arrivals, strict=True)]


def chunks(texts: list[str], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of texts of at most `most` characters; a longer text goes alone."""
    at = size = 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield at, i
            at = i
            size = 0
        size += len(t)
    if len(texts) > at:
        yield at, len(texts)


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every text."""
    small_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("fingerprint", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = walks(samples)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                found = [as_text(n) for n in prints(texts[a:b], walk)[2]]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(found)], names=schema.names)

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(run, schema)


def _bands(prints_: DataFrame, samples: int) -> DataFrame:
    """(band, fingerprint): the groups of sampled characters of every distinct fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = walks(samples)
        for batch in batches:
            band, owner = [], []
            for fp in batch.column(0).to_pylist():
                steps, noted, length = walk.read(fp)
                for k in range(0, len(steps) - BAND + 1, BAND) or [0]:
                    part = zip(steps[k:k + BAND].tolist(), noted[k:k + BAND].tolist(), strict=True)
                    band.append(hashlib.blake2b(repr(list(part)).encode(), digest_size=12).hexdigest())
                    owner.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(band, pa.string()), pa.array(owner, pa.string())],
                                             names=["band", "fingerprint"])

    return prints_.select("fingerprint").distinct().mapInArrow(run, "band string, fingerprint string")


def near(queries: DataFrame, prints_: DataFrame, least: float = LEAST_LIKENESS, samples: int = SAMPLES) -> DataFrame:
    """(query, fingerprint, likeness): pairs of distinct fingerprints that share a band and are alike.

    `queries` and `prints_` have a fingerprint column; equal texts are one fingerprint. Each band is a
    bit sample of `BAND` noted characters; pairs that share one are verified by their likeness.
    """
    pairs = (_bands(queries, samples).withColumnRenamed("fingerprint", "query").join(_bands(prints_, samples), "band")
             .where("query <> fingerprint").select("query", "fingerprint").distinct())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = walks(samples)
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            value = pa.array([likeness(walk.read(a), walk.read(b)) for a, b in rows], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, value], names=["query", "fingerprint", "likeness"])

    return pairs.mapInArrow(verify, "query string, fingerprint string, likeness double").where(F.col("likeness") >= least)


def _followed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, borrowed, id, text) sorted within ranges of ids, each with a copy of the row after its last.

    Ranges are cut at quantiles of the ids, a few for each shuffle partition; the last is followed by the first.
    """
    from pyspark.ml.feature import Bucketizer  # only the driver needs it, workers import this module too

    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    cuts = sorted(set(rows.approxQuantile("id", [k / parts for k in range(1, parts)], 0.1 / parts)))
    at = F.coalesce(F.col("id").cast("double"), F.lit(-float("inf")))
    rows = rows.withColumn("at", at)
    if cuts:
        rows = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol="at", outputCol="in").transform(rows)
    else:
        rows = rows.withColumn("in", F.lit(0))
    rows = rows.select(F.col("in").cast("int").alias("range"), F.lit(False).alias("borrowed"), "id", "text")
    heads = rows.groupBy("range").agg(F.min(F.struct(F.col("id").isNotNull().alias("has"), "id", "text")).alias("head"))
    ranges = sorted(r["range"] for r in rows.select("range").distinct().collect())  # a few for each partition
    before = spark.createDataFrame([(r, ranges[k - 1]) for k, r in enumerate(ranges)], "range int, before int")
    borrowed = heads.join(before, "range").select(
        F.col("before").alias("range"), F.lit(True).alias("borrowed"), "head.id", "head.text")
    return rows.unionAll(borrowed).repartition("range").sortWithinPartitions("range", "borrowed", "id", "text")


def edit_report(docs: DataFrame, share: int = 4, samples: int = SAMPLES, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of its edited text and of the next one.

    Edited: the last n_chars // share characters replaced by the first as many (or all) of the next text by
    ascending id. (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_chars", T.LongType(), False),
                           *(T.StructField(c, T.StringType(), False) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
                           *(T.StructField(c, T.DoubleType(), False) for c in ("near_edited", "near_next"))])

    def report(rows: list[tuple[int, bool, int | None, str]], walk: Walks) -> pa.RecordBatch:
        """Of all rows but the last, whose text is the last one's next."""
        texts = [r[3] for r in rows]
        points, arrivals, notes = prints(texts, walk)
        owned = [i for i, r in enumerate(rows[:-1]) if not r[1]]
        cut = {i: len(texts[i]) - len(texts[i]) // share for i in owned}
        tails = {i: texts[i + 1][:len(texts[i]) // share] for i in owned}
        tail_points = [_points(tails[i]) for i in owned]
        goes_on = walk.arrivals([_classes(p) for p in tail_points], [int(arrivals[i][cut[i]]) for i in owned])
        out = []
        for i, p, a in zip(owned, tail_points, goes_on, strict=True):
            edited = walk.note(np.concatenate([points[i][:cut[i]], p]), np.concatenate([arrivals[i][:cut[i]], a]))
            digest = hashlib.sha256((texts[i][:cut[i]] + tails[i]).encode()).hexdigest()
            out.append((rows[i][2], len(texts[i]), digest, as_text(notes[i]), as_text(edited),
                        likeness(notes[i], edited), likeness(notes[i], notes[i + 1])))
        columns = zip(*out, strict=True) if out else [[]] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, held = walks(samples), []
        for batch in batches:
            rows = held + list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for a, b in chunks([r[3] for r in rows]):
                if len(rows[a:b + 1]) > 1:
                    yield report(rows[a:b + 1], walk)
            held = rows[-1:]

    return _followed(docs, id_col, text_col).mapInArrow(run, schema)
