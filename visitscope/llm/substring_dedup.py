"""Operator 8: substring dedup by relative Lempel-Ziv parsing.

Every document is parsed against those with smaller ids. Reference blocks are
cut by content: the least 8-word hash of a 50-word window anchors it, and the
consecutive windows with one anchor form a block of 50 to 92 words. Blocks are
indexed by the anchor's hash, spread over the cluster, so a document meets
every reference block that shares an anchor with it, and no others. A block
whose every copy is the same refers as a whole to its first copy; where blocks
around one anchor differ, each 50-word window refers to its own first place.

The parse goes greedily over a document's matches: it takes one and goes on as
long as the next match continues it in the same reference, through block after
block. That is a factor: start, length, reference and start there. Factors of
fewer than 50 words do not arise, since matches are whole windows; a window that
stands across two factors' border was looked up as any other and makes a factor
of its own. Matches are found by two 64-bit hashes (anchor and window), so each
factor is then checked from border to border against the words of its reference
by a 128-bit hash of them. Words of factors that hold are duplicate spans.

Defined results: null text has no words; a null id counts as the largest id;
rows with one id are one document and do not remove each other's words (equal
rows get equal results); a text under 50 words loses nothing; the empty table
gives the empty table. `dedup` keeps all columns and rows of its input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, small_batches, staged, text_or_empty
from .wordhash import Words, joined, mix, ngrams, pieces, sliding_min, words_of

WINDOW = 50
ANCHOR = 8
CHUNK_BYTES = 2 << 20
LAST_ID = 2**63 - 1


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, anchor, hash) of every window that lies within one text, starts from the batch's first word."""
    anchors = ngrams(words.hashes, ANCHOR)
    # The hash's upper half decides, the earlier word wins a tie; the lower half says where.
    ranked = (mix(anchors.copy()) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(anchors), dtype=np.uint64)
    least = sliding_min(ranked, window - ANCHOR + 1)
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(least))
    text = np.searchsorted(words.first, start, side="right") - 1
    whole = start + window <= words.first[text + 1]
    start, text, at = start[whole], text[whole], at[whole]
    return text, start, at, ngrams(words.hashes, window)[start]


def blocks_of(texts: list[bytes], window: int = WINDOW) -> dict[str, np.ndarray]:
    """Reference blocks of texts: which text, first window, number of windows, anchor and block hash."""
    words = words_of(texts)
    text, start, at, code = _windows(words, window)
    if not len(start):
        return {k: np.zeros(0, dtype=np.int64) for k in ("text", "start", "n", "anchor", "block")}
    fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([fresh[1:], [len(start)]]) - 1
    n = last - fresh + 1
    # First and last window overlap, so together with the places they tell the whole block.
    places = (n * 256 + at[fresh] - start[fresh]).astype(np.uint64)
    block = joined(joined(code[fresh], code[last]), mix(places))
    anchor = ngrams(words.hashes, ANCHOR)[at[fresh]]
    return {"text": text[fresh], "start": start[fresh] - words.first[text[fresh]], "n": n,
            "anchor": anchor.view(np.int64), "block": block.view(np.int64)}


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord"),
                       F.xxhash64(text).alias("key"), text.alias("text"))


def find_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, key, marks): the windows of each text that a smaller id holds, as runs of n windows and their first place.

    A mark is (start, n, ref_ord, ref_key, ref_start), in words. `ord` is the id (null: the largest), `key` the text's xxhash64. Texts without such windows have no row.
    """
    if not 2 * ANCHOR < window <= 128:
        raise ValueError("a window has 17 to 128 words")
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, key = (batch.column(k).to_numpy() for k in (0, 1))
            for at, texts in pieces([t.encode() for t in batch.column(2).to_pylist()], CHUNK_BYTES):
                b = blocks_of(texts, window)
                if len(b["text"]):
                    row = b["text"] + at
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b["anchor"]), pa.array(b["block"]), pa.array(owner[row]), pa.array(key[row]),
                         pa.array(b["start"].astype(np.int32)), pa.array(b["n"].astype(np.int32))],
                        names=["anchor", "block", "ord", "key", "start", "n"])

    blocks = staged(keyed.mapInArrow(index, "anchor long, block long, ord long, key long, start int, n int"), "lz-blocks")
    # Written before it is joined, so that both sides are shuffled for the join and a hot anchor can be split.
    place = F.struct("ord", "key", "start").alias("origin")
    shared = staged(blocks.groupBy("anchor")
                    .agg(F.min(place).alias("origin"), F.max("ord").alias("last"), F.min("block").alias("lo"), F.max("block").alias("hi"))
                    .where("origin.ord < last").select("anchor", "origin", F.col("lo").eqNullSafe(F.col("hi")).alias("alike")), "lz-shared")
    # Blocks alike everywhere are settled here; others are looked up window by window.
    hits = staged(blocks.join(shared, "anchor").where("not alike or ord > origin.ord"), "lz-hits")
    whole = hits.where("alike").select("ord", "key", "start", "n", *_reference("origin"))

    # Equal blocks stand or fall together: the one of the least id speaks for its copies.
    unsure = hits.where("not alike")
    spoken = (unsure.groupBy("anchor", "block").agg(F.min(F.struct("ord", "key", "start", "n")).alias("least"))
              .select("anchor", "block", "least.*").groupBy("ord", "key")
              .agg(F.collect_list(F.struct("start", "n", "anchor", "block")).alias("parts")))
    texts = keyed.join(spoken, ["ord", "key"]).select("ord", "key", "text", "parts")

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, key, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes = ngrams(words_of([text.encode()]).hashes, window)
                n = np.array([p["n"] for p in parts])
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat([p["start"] for p in parts], n) + at
                anchor, block = (np.repeat(np.array([p[k] for p in parts], dtype=np.int64), n) for k in ("anchor", "block"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(block), pa.array(at.astype(np.int32)), pa.array(codes[start].view(np.int64)),
                     pa.array(np.full(len(start), owner)), pa.array(np.full(len(start), key)), pa.array(start.astype(np.int32))],
                    names=["anchor", "block", "at", "code", "ord", "key", "start"])

    windows = staged(texts.mapInArrow(single, "anchor long, block long, at int, code long, ord long, key long, start int"), "lz-windows")
    first = staged(windows.groupBy("anchor", "code").agg(F.min(place).alias("origin")), "lz-first")
    # Windows of a block that go on in one reference are one run.
    known = (windows.select("anchor", "block", "at", "code").join(first, ["anchor", "code"])
             .withColumn("shift", F.col("origin.start") - F.col("at")))
    together = ["anchor", "block", "origin.ord", "origin.key", "shift"]
    in_run = Window.partitionBy(*together).orderBy("at")
    runs = (known.repartition("anchor", "block").withColumn("run", F.col("at") - F.row_number().over(in_run))
            .groupBy("anchor", "block", "run", "shift", F.col("origin.ord").alias("o"), F.col("origin.key").alias("k"))
            .agg(F.min("at").alias("at"), F.count(F.lit(1)).cast("int").alias("m")).groupBy("anchor", "block")
            .agg(F.collect_list(F.struct("at", "m", F.struct(F.col("o").alias("ord"), F.col("k").alias("key"),
                                                             (F.col("shift") + F.col("at")).alias("start")).alias("origin"))).alias("runs")))
    earlier = F.filter("runs", lambda r: r["origin"]["ord"] < F.col("ord"))
    found = (unsure.join(staged(runs, "lz-known"), ["anchor", "block"]).select("ord", "key", "start", F.explode(earlier).alias("run"))
             .select("ord", "key", (F.col("start") + F.col("run.at")).alias("start"), F.col("run.m").alias("n"), *_reference("run.origin")))
    return staged(whole.unionAll(found).groupBy("ord", "key")
                  .agg(F.collect_set(F.struct("start", "n", "ref_ord", "ref_key", "ref_start")).alias("marks")), "lz-marks")


def _reference(origin: str) -> list:
    return [F.col(f"{origin}.{c}").alias(f"ref_{c}") for c in ("ord", "key", "start")]


def parse(marks: list[dict], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Factors (start, length, ref_ord, ref_key, ref_start) of a document's matches (start, n windows, reference).

    Greedy from left to right: a match is continued by the next one as long as
    that begins right after it, in the text as in the reference.
    """
    factors: list[list[int]] = []
    for m in sorted(marks, key=lambda m: m["start"]):
        last = factors[-1] if factors else None
        if (last and (last[2], last[3]) == (m["ref_ord"], m["ref_key"]) and m["start"] - last[0] == m["ref_start"] - last[4]
                and m["start"] <= last[0] + last[1] - window + 1):
            last[1] = max(last[1], m["start"] - last[0] + m["n"] + window - 1)
        else:
            factors.append([m["start"], m["n"] + window - 1, m["ref_ord"], m["ref_key"], m["ref_start"]])
    return [tuple(f) for f in factors]


def span_digest(words: list[bytes], start: int, length: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:start + length]), digest_size=16).digest()


FACTOR = "start int, length int, ref_ord long, ref_key long, ref_start int"


def factors(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, key, start, length, ref_ord, ref_key, ref_start, digest): the factors of every text, with their reference's words hashed.

    Positions and lengths are in words; `ord` and `key` name a text as in `find_windows`.
    """
    marks = find_windows(docs, window, id_col, text_col)

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(o, k, *f) for o, k, m in zip(*(c.to_pylist() for c in batch.columns), strict=True) for f in parse(m, window)]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                          names=["ord", "key", "start", "length", "ref_ord", "ref_key", "ref_start"])

    found = staged(map_batches(marks.select("ord", "key", "marks"), split, f"ord long, key long, {FACTOR}"), "lz-factors")
    # The references' words are hashed once for each span that is referred to.
    spans = (found.select("ref_ord", "ref_key", "ref_start", "length").distinct().groupBy("ref_ord", "ref_key")
             .agg(F.collect_list(F.struct("ref_start", "length")).alias("spans")))
    sources = _keyed(docs, id_col, text_col).withColumnsRenamed({"ord": "ref_ord", "key": "ref_key"})
    asked = sources.join(spans, ["ref_ord", "ref_key"]).select("ref_ord", "ref_key", "text", "spans")

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for o, k, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = text.encode().split()
            rows += [(o, k, w["ref_start"], w["length"], span_digest(words, w["ref_start"], w["length"])) for w in wanted]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                          names=["ref_ord", "ref_key", "ref_start", "length", "digest"])

    read_back = map_batches(asked, read, "ref_ord long, ref_key long, ref_start int, length int, digest binary").distinct()
    return found.join(staged(read_back, "lz-references"), ["ref_ord", "ref_key", "ref_start", "length"])


def duplicate_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(ord, key, marks): the factors of each text as (start, length, digest); texts without factors have no row."""
    return staged(factors(docs, window, id_col, text_col).groupBy("ord", "key")
                  .agg(F.collect_list(F.struct("start", "length", "digest")).alias("marks")), "lz-spans")


def _doomed(words: list[bytes], marks: list[dict] | None) -> np.ndarray:
    """Which of `words` lie in a marked span; a span with a digest counts only if its words have it."""
    held = [m for m in marks or [] if m.get("digest") is None or m["digest"] == span_digest(words, m["start"], m["length"])]
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, [m["start"] for m in held], 1)
    np.add.at(depth, [m["start"] + m["length"] for m in held], -1)
    return np.cumsum(depth[:-1]) > 0


def remove_digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256): kept words joined by one space."""
    marks = duplicate_spans(docs, window, id_col, text_col)
    own_id, text = F.col(id_col).cast("long"), text_or_empty(text_col)
    keyed = docs.select(own_id.alias("id"), F.coalesce(own_id, F.lit(LAST_ID)).alias("ord"), F.xxhash64(text).alias("key"), text.alias("text"))
    rows = keyed.join(marks, ["ord", "key"], "left").select("id", "text", "marks")
    schema = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_words", T.LongType(), False),
                           T.StructField("n_removed", T.LongType(), False), T.StructField("kept_sha256", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest = [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept = text.encode().split()
                total.append(len(kept))
                if own:
                    doomed = _doomed(kept, own)
                    kept = [w for w, gone in zip(kept, doomed, strict=True) if not gone]
                removed.append(total[-1] - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                names=schema.names)

    return rows.mapInArrow(run, schema)


def cut(text: str, marks: list[dict]) -> str:
    """`text` without its marked words; each gap leaves the white space before it."""
    data = text.encode()
    words = words_of([data])
    doomed = _doomed(data.split(), marks)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], doomed, [False]]).astype(np.int8)))
    out, at = [], 0
    for a, b in zip(edges[0::2], edges[1::2], strict=True):
        out.append(data[at:words.begins[a]])
        at = words.begins[b] if b < len(words.begins) else len(data)
    return b"".join([*out, data[at:]]).decode()


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with the duplicate spans cut from the text column; all rows and columns stay."""
    marks = duplicate_spans(docs, window, id_col, text_col)
    names, at = docs.columns, docs.columns.index(text_col)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("ord"),
                       F.xxhash64(text_or_empty(text_col)).alias("key"))
    rows = rows.join(marks, ["ord", "key"], "left").select("row.*", F.col("marks").alias("__marks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, kept = batch.columns[:-1], batch.column(at).to_pylist()
            for i, own in enumerate(batch.columns[-1].to_pylist()):
                if own:
                    kept[i] = cut(kept[i], own)
            columns[at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, docs.schema)
