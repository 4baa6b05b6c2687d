"""Hard-negative mining by inner product over cover trees.

Candidates are norm-augmented: with M the largest norm of a tree, a vector x
gains the component sqrt(M^2 - |x|^2), so all lie on one sphere, a query gains
0, and inner products stay what they were. A node of a cover tree is a
candidate with a covering radius r; from its inner product with a query the
angle between them is known, every descendant lies within the angle that r
spans on the sphere, and that bounds the descendants' inner products from both
sides. A descent opens the nodes with the highest upper bounds first (one, then
four, sixteen ... at once, so that products run over whole blocks), skips nodes
whose bounds miss every open score window (or fall below its k-th best so far,
or whose candidates all have the wrong label), and computes the score of every
candidate it reaches as an exact integer.

On Spark: rows are dealt to cells by the nearest of at most `CENTRES` centres
(a sample by hash), cells over `SHARD` rows (fewer of long vectors) are split by a hash of the row, so
a vector with very many copies is no hot group, and one tree is built for each
shard and written to the shared folder. Trees are bundled (up to `BUNDLE` of
them); anchors travel once to every bundle, sorted behind its trees, and stream
past them in Arrow batches: a task holds the trees of one bundle and a batch of
anchors. The first pass finds positives, starting from the score that an anchor
reaches in its own tree; the second finds negatives in the positives' windows.
Each bundle returns the first few of an anchor or window, a window function
over those rows picks the first of all.

Defined results. Rows with a null label, a null vector or a null or non-finite
component take no part (`quantised`). Vectors of unlike length are compared as
if the shorter ended in zeros; an empty vector has only zeros. Integer
components beyond 2^24 stand at that bound, so that scores are exact. Rows with
a null vec_id take part as candidates, last among equal scores, and are no
anchors. Repeated rows are rows of their own: the copy of an anchor is one of
its other rows, and each copy is an anchor. An empty table gives an empty one.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

CENTRES = 256     # most cells, and rows of the sample on the driver
SHARD = 4096      # rows a tree is meant to hold
LEAF = 256        # a node of no more candidates has them as children
BASE = 1.3        # covering radii of two levels
SPREAD = 64       # bundles hold more than one tree only beyond so many trees
BUNDLE = 16       # most trees of a bundle
NUMBERS = 1 << 20  # components of a tree, about, where vectors are long
LIMIT = 1 << 24   # largest integer component
NO_SCORE = -(1 << 62)


def quantised(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, vec array<int>): rows that take part, components as floor(scale * x)."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    bounded = F.transform("e", lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))).cast("int"))
    return rows.where(F.col("label").isNotNull() & F.col("e").isNotNull() & fine).select("vec_id", "label", bounded.alias("vec"))


# Trees -----------------------------------------------------------------------

def _matrix(vectors: list[bytes]) -> np.ndarray:
    """Integer vectors as rows of doubles, shorter ones filled with zeros."""
    width = max((len(v) for v in vectors), default=0) // 4
    out = np.zeros((len(vectors), max(1, width)))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v) // 4] = np.frombuffer(v, dtype="<i4")
    return out


def _products(points: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products; in doubles where no sum can reach 2^53."""
    width = min(points.shape[1], len(query))
    a, b = points[:, :width], query[:width]
    return (a @ b).astype(np.int64) if exact else a.astype(np.int64) @ b.astype(np.int64)


def _distances(points: np.ndarray) -> tuple[np.ndarray, float]:
    """Distances of the augmented vectors, exactly 0 between equal ones, and their common norm."""
    squares = (points * points).sum(axis=1)
    top = squares.max(initial=0.0)
    lift = np.sqrt(np.maximum(top - squares, 0.0))
    apart = points @ points.T
    apart *= -2
    apart += squares[:, None]
    apart += squares
    apart += (lift[:, None] - lift) ** 2
    np.fill_diagonal(apart, 0.0)
    return np.sqrt(np.maximum(apart, 0.0, out=apart), out=apart), float(np.sqrt(top))


class CoverTree:
    """Nodes breadth first: `at` their candidate, `begin`/`end` their children, `radius`, `only` their one label's number or -1."""

    FIELDS = ("points", "uids", "ids", "no_id", "labels", "at", "begin", "end", "radius", "only", "norm")

    def __init__(self, **fields: np.ndarray) -> None:
        for name in self.FIELDS:
            setattr(self, name, fields[name])
        self.largest = np.abs(self.points).max(initial=0.0)

    @classmethod
    def build(cls, points: np.ndarray, uids: np.ndarray, ids: np.ndarray, no_id: np.ndarray, labels: np.ndarray) -> CoverTree:
        apart, norm = _distances(points)
        root = int(apart.max(axis=1).argmin())
        at, begin, end, radius, only = [root], [0], [0], [0.0], [True]
        waiting = [(0, np.arange(len(points)))]
        for node, members in waiting:  # grows as nodes get children
            centre = at[node]
            reach = apart[centre, members]
            radius[node] = float(reach.max())
            only[node] = bool((labels[members] == labels[centre]).all())
            if len(members) == 1:
                continue
            begin[node] = len(at)
            if len(members) <= LEAF or radius[node] == 0.0:
                groups = [(int(m), members[k:k + 1]) for k, m in enumerate(members) if m != centre]
            else:
                level = np.ceil(np.log(radius[node]) / np.log(BASE)) - 1
                groups = _cover(apart, members, centre, BASE ** level)
            for point, group in groups:
                at.append(point)
                begin.append(0)
                end.append(0)
                radius.append(0.0)
                only.append(True)
                if len(group) > 1:
                    waiting.append((len(at) - 1, group))
            end[node] = len(at)
        # Rounding may leave a radius a little short.
        wide = np.asarray(radius) * (1 + 1e-9) + 1e-6 * (np.asarray(radius) > 0)
        return cls(points=points, uids=uids, ids=ids, no_id=no_id, labels=labels, at=np.asarray(at), begin=np.asarray(begin),
                   end=np.asarray(end), radius=wide, only=np.asarray(only), norm=np.float64(norm))

    def dump(self) -> bytes:
        out = io.BytesIO()
        fields = {n: getattr(self, n) for n in self.FIELDS}
        np.savez(out, **fields | {"points": self.points.astype("<i4")})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as held:
            fields = {n: held[n] for n in cls.FIELDS}
        return cls(**fields | {"points": fields["points"].astype(np.float64)})

    def first(self, query: np.ndarray, label: int, alike: bool, uid: int, windows: list[tuple[int, int]], k: int
              ) -> list[list[tuple[int, bool, int, int]]]:
        """For every window (low, high) the first k (-score, id is null, id, uid) with a score in it.

        `alike` asks for candidates of the label, else for those of others;
        the candidate `uid` itself is left out.
        """
        open_ = [max(low, NO_SCORE) for low, _ in windows]  # least score that still counts
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        size = float(np.sqrt(query @ query)) * float(self.norm)
        slack = 1e-7 * size + 1e-6
        exact = self.largest * np.abs(query).max(initial=0.0) * len(query) < 2.0 ** 53
        tops = np.array([high for _, high in windows], dtype=np.int64)
        highs = tops.astype(np.float64)

        def offer(scores: np.ndarray, at: np.ndarray) -> None:
            fit = np.flatnonzero((scores >= min(open_)) & (scores <= tops.max()))
            scores, at = scores[fit], at[fit]
            fit = ((self.labels[at] == label) == alike) & (self.uids[at] != uid)
            scores, at = scores[fit], at[fit]
            if not len(at):
                return
            order = np.argsort(-scores, kind="stable")
            scores, at = scores[order], at[order]
            begins = np.searchsorted(-scores, -tops)
            ends = np.searchsorted(-scores, -np.array(open_), side="right")
            for w in np.flatnonzero(begins < ends).tolist():
                i, j = begins[w], ends[w]
                if j - i > k:  # equal scores stay for the ids to decide
                    j = np.searchsorted(-scores, -scores[i + k - 1], side="right")
                s, p = scores[i:j], at[i:j]
                if len(found[w][0]):
                    s, p = np.concatenate([found[w][0], s]), np.concatenate([found[w][1], p])
                if len(s) >= k:
                    kth = int(np.partition(s, len(s) - k)[len(s) - k])
                    open_[w] = max(open_[w], kth)
                    s, p = s[s >= kth], p[s >= kth]
                found[w] = (s, p)

        def bounds(scores: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if size == 0.0:
                return np.zeros(len(nodes)), np.zeros(len(nodes))
            angle = np.arccos(np.clip(scores / size, -1.0, 1.0))
            span = 2 * np.arcsin(np.clip(self.radius[nodes] / (2 * float(self.norm)), 0.0, 1.0))
            return (size * np.cos(np.minimum(np.pi, angle + span)) - slack, size * np.cos(np.maximum(0.0, angle - span)) + slack)

        def wanted(nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            alive = self.end[nodes] > self.begin[nodes]
            alive &= ~self.only[nodes] | ((self.labels[self.at[nodes]] == label) == alike)
            return alive & ((high[:, None] >= np.array(open_, dtype=np.float64)) & (low[:, None] <= highs)).any(axis=1)

        root = np.array([0])
        scores = _products(self.points[self.at[root]], query, exact)
        offer(scores, self.at[root])
        nodes, (low, high), width = root, bounds(scores, root), 1
        while len(nodes):
            near = wanted(nodes, low, high)
            nodes, low, high = nodes[near], low[near], high[near]
            # The nodes with the highest upper bounds, four times as many in each step, are opened at once.
            order = np.argsort(-high, kind="stable")
            now, rest = nodes[order[:width]], order[width:]
            width *= 4
            sizes = self.end[now] - self.begin[now]
            children = np.arange(sizes.sum()) + np.repeat(self.begin[now] - np.cumsum(sizes) + sizes, sizes)
            at = self.at[children]
            scores = _products(self.points.take(at, axis=0), query, exact)
            new = at != np.repeat(self.at[now], sizes)  # a node's own candidate was scored with the node
            offer(scores[new], at[new])
            inner = self.end[children] > self.begin[children]
            below = children[inner]
            more_low, more_high = bounds(scores[inner], below)
            nodes = np.concatenate([nodes[rest], below])
            low, high = np.concatenate([low[rest], more_low]), np.concatenate([high[rest], more_high])
        return [sorted((-int(s), bool(self.no_id[p]), int(self.ids[p]), int(self.uids[p])) for s, p in zip(*f, strict=True))[:k]
                for f in found]


def _cover(apart: np.ndarray, members: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray]]:
    """Centres more than `radius` apart, `centre` first, each with the members nearest to it, all within `radius`."""
    centres, left = [centre], members[apart[centre, members] > radius]
    while len(left):
        centres.append(int(left[0]))
        left = left[apart[left[0], left] > radius]
    nearest = apart[np.ix_(centres, members)].argmin(axis=0)
    place = {int(m): k for k, m in enumerate(members)}
    for c, point in enumerate(centres):  # a centre stays its own, also beside an equal vector
        nearest[place[point]] = c
    order = np.argsort(nearest, kind="stable")
    cuts = np.searchsorted(nearest[order], np.arange(len(centres) + 1))
    return [(point, members[order[cuts[c]:cuts[c + 1]]]) for c, point in enumerate(centres)]


# Spark -----------------------------------------------------------------------

def _shards(rows: DataFrame) -> tuple[DataFrame, int]:
    """(uid, vec_id, label, vec binary, shard), written to the shared folder, and the number of shards."""
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    n, most = found["n"], max(1, min(SHARD, NUMBERS // max(1, found["width"] or 0)))
    sample = rows.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(CENTRES).collect()
    few = min(CENTRES, max(1, -(-n // most)))
    vectors = list(dict.fromkeys(np.asarray(r["vec"], dtype="<i4").tobytes() for r in sample))[:few] or [b""]
    centres = _matrix(vectors)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            packed = [np.asarray(v, dtype="<i4").tobytes() for v in batch.column("vec").to_pylist()]
            points = _matrix(packed)
            width = max(points.shape[1], centres.shape[1])
            a, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (points, centres))
            cells = ((c * c).sum(axis=1) - 2 * (a @ c.T)).argmin(axis=1)
            yield pa.record_batch([batch.column("uid"), batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary()),
                                   pa.array(cells.astype(np.int32))], names=["uid", "vec_id", "label", "vec", "cell"])

    celled = staged(rows.withColumn("uid", F.monotonically_increasing_id())
                    .mapInArrow(deal, "uid long, vec_id long, label long, vec binary, cell int"), "vectors")
    parts = dict.fromkeys(range(len(centres)), 1)
    for cell, count in celled.groupBy("cell").count().collect():  # at most CENTRES rows
        parts[cell] = -(-count // most)
    first = np.concatenate([[0], np.cumsum(list(parts.values()))]).tolist()

    def of(values: list[int]) -> Column:
        return F.get(F.array(*(F.lit(v) for v in values)), F.col("cell"))

    shard = of(first[:-1]) + F.pmod(F.xxhash64("uid"), of(list(parts.values())))
    return celled.withColumn("shard", shard.cast("int")).drop("cell"), first[-1]


def _plant(table: pa.Table) -> pa.Table:
    ids = table.column("vec_id").combine_chunks()
    tree = CoverTree.build(_matrix(table.column("vec").to_pylist()), table.column("uid").to_numpy(), ids.fill_null(0).to_numpy(),
                           ids.is_null().to_numpy(zero_copy_only=False), table.column("label").to_numpy())
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "tree": pa.array([tree.dump()], pa.binary())})


def cover_trees(rows: DataFrame) -> tuple[DataFrame, int]:
    """(bundle, tree) of `rows` (vec_id, label, vec) in the shared folder, one tree a shard, and the number of bundles."""
    small_batches(rows.sparkSession)
    sharded, shards = _shards(rows)
    size = min(BUNDLE, max(1, shards // SPREAD))
    planted = sharded.groupBy("shard").applyInArrow(_plant, "shard int, tree binary")
    return staged(planted.select((F.col("shard") / size).cast("int").alias("bundle"), "tree"), "cover-trees"), -(-shards // size)


def _own_anchors(trees: DataFrame, every: int, positives: int) -> DataFrame:
    """Anchors of every tree, with the score of their last positive there (null if there are too few)."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("tree"):
                tree = CoverTree.load(data.as_py())
                mine = np.flatnonzero(~tree.no_id & (tree.ids % every == 0))
                floors = []
                for p in mine:
                    best = tree.first(tree.points[p], tree.labels[p], True, int(tree.uids[p]), [(NO_SCORE, 1 << 62)], positives)[0]
                    floors.append(-best[-1][0] if len(best) == positives else None)
                yield pa.record_batch([pa.array(tree.uids[mine]), pa.array(tree.ids[mine]), pa.array(tree.labels[mine]),
                                       pa.array([v.astype("<i4").tobytes() for v in tree.points[mine]], pa.binary()),
                                       pa.array(floors, pa.int64())], names=["uid", "vec_id", "label", "vec", "floor"])

    return staged(trees.mapInArrow(find, "uid long, vec_id long, label long, vec binary, floor long"), "anchors")


def _past_trees(trees: DataFrame, bundles: int, queries: DataFrame, alike: bool, k: int) -> DataFrame:
    """(uid, nth, score, vec_id, other): the first k rows of every bundle of trees in every window of every query.

    `queries` has uid, label, vec, lows, highs; nth counts the windows.
    """
    planted = trees.select(
        "bundle", F.lit(None).cast("long").alias("uid"), F.lit(None).cast("long").alias("label"), F.col("tree").alias("data"),
        F.lit(None).cast("array<long>").alias("lows"), F.lit(None).cast("array<long>").alias("highs"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"), "uid", "label",
                           F.col("vec").alias("data"), "lows", "highs")
    stream = (planted.unionByName(asked).repartitionById(bundles, F.col("bundle"))
              .sortWithinPartitions("bundle", F.col("uid").asc_nulls_first()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            out: dict[str, list] = {n: [] for n in ("uid", "nth", "score", "vec_id", "other")}
            for r in batch.to_pylist():
                if r["uid"] is None:
                    held = held if r["bundle"] == at else []
                    at = r["bundle"]
                    held.append(CoverTree.load(r["data"]))
                    continue
                query = np.frombuffer(r["data"], dtype="<i4").astype(np.float64)
                windows = list(dict.fromkeys(zip(r["lows"], r["highs"], strict=True)))
                best: dict[tuple[int, int], list] = {w: [] for w in windows}
                for tree in held if r["bundle"] == at else []:
                    # What earlier trees of the bundle reached narrows the windows for this one.
                    now = [(max(low, -best[low, high][-1][0]) if len(best[low, high]) == k else low, high) for low, high in windows]
                    for w, more in zip(windows, tree.first(query, r["label"], alike, r["uid"], now, k), strict=True):
                        best[w] = sorted(best[w] + more)[:k]
                for nth, w in enumerate(zip(r["lows"], r["highs"], strict=True)):
                    for score, no_id, vec_id, other in best[w]:
                        for name, value in zip(out, (r["uid"], nth, -score, None if no_id else vec_id, other), strict=True):
                            out[name].append(value)
            if out["uid"]:
                yield pa.record_batch([pa.array(out["uid"], pa.int64()), pa.array(out["nth"], pa.int32()), pa.array(out["score"], pa.int64()),
                                       pa.array(out["vec_id"], pa.int64()), pa.array(out["other"], pa.int64())], names=list(out))

    return stream.mapInArrow(search, "uid long, nth int, score long, vec_id long, other long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    first = Window.partitionBy("uid", "nth").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "other")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank, anchor_row) by cover trees.

    `rows` has vec_id, label, vec (array<int>). Anchors are the rows whose
    vec_id is divisible by `every`; a negative scores between `low` and `high`
    percent of the positive.
    """
    trees, bundles = cover_trees(rows)
    anchors = _own_anchors(trees, every, positives)
    whole = anchors.select("uid", "label", "vec", F.array(F.coalesce("floor", F.lit(NO_SCORE))).alias("lows"),
                           F.array(F.lit(1 << 62)).alias("highs"))
    best = staged(_ranked(_past_trees(trees, bundles, whole, True, positives), positives)
                  .select("uid", "rank", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    # The score windows: low * positive <= 100 * negative <= high * positive, as integer bounds.
    def hundredth(percent: int) -> Column:
        scaled = F.col("positive_score") * percent
        return F.call_function("div", scaled - F.pmod(scaled, F.lit(100)), F.lit(100))

    bounds = F.array_sort(F.collect_list(F.struct("rank", (-hundredth(-low)).alias("low"), hundredth(high).alias("high"))))
    asked = best.groupBy("uid").agg(bounds.alias("b")).join(anchors.select("uid", "label", "vec"), "uid").select(
        "uid", "label", "vec", F.col("b.low").alias("lows"), F.col("b.high").alias("highs"))
    hard = _ranked(_past_trees(trees, bundles, asked, False, negatives), negatives)
    named = best.join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid").select(
        F.col("uid").alias("anchor_row"), (F.col("rank") - 1).alias("at"), "anchor_id", "positive_id", "positive_score")
    return hard.join(named, (F.col("uid") == F.col("anchor_row")) & (F.col("nth") == F.col("at"))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"), (F.col("at") + 1).alias("positive_rank"), "anchor_row")
