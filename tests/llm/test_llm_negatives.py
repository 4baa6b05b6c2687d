"""Hard negatives against all pairs, and the bounds of the trees."""

import random

import numpy as np
import pytest

from visitscope.llm import hard_negatives as H
from visitscope.llm.catalog import QUERIES, read_table

ROWS = "vec_id long, embedding array<float>, label int, uid string, bundle int, score string"


def brute(rows, every=100, positives=5, negatives=10):
    """(vec_id, label, integer vector) rows; an answer as a sorted list."""
    width = max((len(v) for _, _, v in rows), default=0)
    flat = [(i, label, [*map(int, v), *[0] * (width - len(v))]) for i, label, v in rows]
    out = []
    for a, (i, label, v) in enumerate(flat):
        if i is None or i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j is None, j or 0, m == label)
                        for b, (j, m, w) in enumerate(flat) if b != a)
        for rank, (p, no_id, pid, _) in enumerate([s for s in scored if s[3]][:positives], 1):
            window = [s for s in scored if not s[3] and -30 * p <= -100 * s[0] <= -90 * p]
            out += [(i, None if no_id else pid, rank, k, None if n else nid, -p, -s) for k, (s, n, nid, _) in enumerate(window[:negatives], 1)]
    return sorted(out, key=str)


def answer(df):
    return sorted(((r.anchor_id, r.positive_id, r.positive_rank, r.rank, r.negative_id, r.positive_score, r.negative_score)
                   for r in df.collect()), key=str)


def integers(rows):
    return [(i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, label in rows
            if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]


def random_rows(seed, n, dims, labels=4, spread=1.0):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, dims))
    return [(i, (centres[rnd.integers(6)] + spread * rnd.normal(size=dims)).astype("f4").tolist(), int(rnd.integers(labels)))
            for i in range(n)]


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_many_shards_and_bundles(spark, monkeypatch, spread):
    monkeypatch.setattr(H, "SHARD", 40)
    monkeypatch.setattr(H, "SPREAD", 4)
    rows = random_rows(1, 700, 8, spread=spread)
    df = spark.createDataFrame([(*r, "u", 1, "s") for r in rows], ROWS).repartition(3)
    assert answer(H.mine(H.quantised(df), every=50)) == brute(integers(rows), every=50)


def test_long_vectors_make_small_shards(spark, monkeypatch):
    monkeypatch.setattr(H, "NUMBERS", 320)
    rows = random_rows(6, 200, 16)
    sharded, shards = H._shards(H.quantised(spark.createDataFrame([(*r, "u", 1, "s") for r in rows], ROWS)))
    assert shards >= 10 and max(r["count"] for r in sharded.groupBy("shard").count().collect()) <= 60


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD", 16)
    rows = random_rows(2, 60, 3, labels=2)
    rows += [(100, [0.5, 0.5, 0.5], 1)] * 40 + [(200, [0.5, 0.5, 0.5], 0)] * 3  # copies, of an anchor too
    rows += [(None, [0.6, 0.5, 0.5], 1), (None, [0.4, 0.5, 0.4], 0), (300, [], 1), (301, [0.0], 0), (302, [1.0, 2.0, 3.0, 4.0], 1),
             (400, None, 1), (500, [1.0, 1.0, 1.0], None), (600, [None, 1.0, 1.0], 0), (700, [float("nan"), 1.0, 1.0], 0),
             (800, [float("inf"), 1.0, 1.0], 0), (900, [-1.0, -1.0, -1.0], 1), (1000, [0.0, 0.0, 0.0], 1), (1100, [1e-40, 60000.0, 1.0], 0)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame([(*r, "u", 1, "s") for r in rows], ROWS).repartition(4)
    assert answer(H.mine(H.quantised(df))) == brute(integers(rows))


def test_large_components_stand_at_the_bound(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [3e4, 1.0], 2)]
    df = spark.createDataFrame([(*r, "u", 1, "s") for r in rows], ROWS)
    bounded = [(i, label, [min(x, H.LIMIT) for x in v]) for i, label, v in integers(rows)]
    assert answer(H.mine(H.quantised(df))) == brute(bounded)


def test_no_rows(spark):
    assert H.mine(H.quantised(spark.createDataFrame([], ROWS))).count() == 0


def test_radii_cover_and_descents_skip_nodes():
    rnd = np.random.default_rng(4)
    points = np.floor(256 * np.vstack([c + 0.02 * rnd.normal(size=(100, 16)) for c in rnd.normal(size=(8, 16))]))
    n = len(points)
    tree = H.CoverTree.load(H.CoverTree.build(points, np.arange(n), np.arange(n), np.zeros(n, bool), np.arange(n) % 3).dump())
    apart, _ = H._distances(points)
    seen = []

    def below(node):
        found = {int(tree.at[node])}
        for child in range(tree.begin[node], tree.end[node]):
            found |= below(child)
        seen.append(node)
        assert apart[tree.at[node], list(found)].max() <= tree.radius[node] + 1e-9
        return found

    assert below(0) == set(range(n)) and len(seen) == len(tree.at)
    counted = []
    plain = H._products
    H._products = lambda p, q, e: counted.append(len(p)) or plain(p, q, e)
    try:
        for q in points[::97]:
            best = tree.first(q, 0, True, -1, [(H.NO_SCORE, 1 << 62)], 5)[0]
            exact = sorted((-int(points[k] @ q), False, k, k) for k in range(0, n, 3))[:5]
            assert best == exact
    finally:
        H._products = plain
    assert sum(counted) < 0.6 * n * len(points[::97])  # nodes outside the window were skipped


def test_query_against_all_pairs(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in read_table(spark, path, "embeddings").collect()]
    want = brute([(i, (m + 1) % 10 if i % 7 == 0 else m, v) for i, m, v in integers(rows)])
    found = QUERIES["op11_hard_negatives"](spark, path)
    assert sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in found.collect()), key=str) \
        == sorted(((a, p, k, n, ps, ns) for a, p, _, k, n, ps, ns in want), key=str)
