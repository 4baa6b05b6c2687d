import hashlib
import random

import numpy as np
from llm_helpers import DOCS, by_value, odd_texts, with_clashes

from visitscope.llm import edit_embedding as X
from visitscope.llm.catalog import op2_edit_fingerprints


def brute_print(text):
    """The walk, step by step."""
    coins = np.random.Generator(np.random.PCG64(X.SEED)).integers(0, 2, (X.CLASSES, X.PERIOD), dtype=np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    classes = X._classes(points)
    at = step = 0
    noted = []
    while at < len(points):
        noted.append((int(points[at]) * 0x9E3779B97F4A7C15 % 2**64) >> 56)
        at += int(coins[classes[at], step % X.PERIOD])
        step += 1
    kept = np.argsort(X._rank(np.arange(max(1, step)))[:step], kind="stable")[:X.SAMPLES]
    return f"{step:x}-" + bytes(noted[k] for k in kept).hex()


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    prints = {t: brute_print(t) for _, t in rows}
    walk, out = X.walks(), []
    for k, (i, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        m = len(t) // 4
        edited = t[:len(t) - m] + following[:m]
        fp = brute_print(edited)
        read = {f: walk.read(f) for f in (prints[t], fp, prints[following])}
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[t], fp, X.likeness(read[prints[t]], read[fp]),
                    X.likeness(read[prints[t]], read[prints[following]])))
    return out


def test_odd_rows(spark):
    rows = odd_texts()
    assert by_value(X.edit_report(with_clashes(spark, rows).repartition(3)).collect()) == by_value(brute(rows))
    assert X.edit_report(spark.createDataFrame([], DOCS)).count() == 0
    assert by_value(X.edit_report(spark.createDataFrame([(1, "alone é")], DOCS)).collect()) == by_value(brute([(1, "alone é")]))
    assert X.fingerprints(spark.createDataFrame([], DOCS)).count() == 0


def test_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = op2_edit_fingerprints(spark, sf).collect()
    assert by_value(found) == by_value(brute(rows))
    assert all(r.near_edited > r.near_next for r in found)


def test_likeness_falls_with_edits():
    rnd = random.Random(3)
    text = "".join(rnd.choices("abcdefghijklmnop rst", k=4000))
    walk, values = X.walks(), []
    for edits in (0, 4, 40, 400, 4000):
        other = list(text)
        for _ in range(edits):
            at = rnd.randrange(len(other))
            other[at:at + rnd.choice([0, 1])] = rnd.choice(["", "q", "zz"])
        _, _, (a, b) = X.prints([text, "".join(other)], walk)
        values.append(X.likeness(a, b))
        assert X.likeness(a, b) == X.likeness(b, a)
    assert values[0] == 1.0 and values[1] > 0.7 and values[-1] < 0.3
    assert all(a >= b - 0.1 for a, b in zip(values, values[1:], strict=False))


def test_bands_find_near_texts(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(0, 200, 2):
        text = "".join(rnd.choices("abcdefghijklmnop rst", k=rnd.randint(300, 900)))
        rows += [(k, text), (k + 1, text[:-8] + "changed.")]
    prints = X.fingerprints(spark.createDataFrame(rows, DOCS)).cache()
    own = {r.fingerprint: r.doc_id for r in prints.collect()}
    pairs = {(own[r.query], own[r.fingerprint]) for r in X.near(prints.where("doc_id % 50 = 0"), prints).collect()}
    # An edit that meets no sampled step leaves the fingerprint as it is: one class, no pair.
    by_id = {r.doc_id: r.fingerprint for r in prints.collect()}
    assert pairs == {(k, k + 1) for k in range(0, 200, 50) if by_id[k] != by_id[k + 1]} and len(pairs) >= 3
    prints.unpersist()


def test_band_recall_against_brute_force(spark):
    rnd = random.Random(9)
    rows = []
    for k in range(40):
        text = "".join(rnd.choices("abcdefghijklmnop rst", k=rnd.randint(400, 1200)))
        rows.append((50 * k, text))
        for j in range(1, 6):  # copies with ever more edits
            other = list(text)
            for _ in range(6 * j):
                other[rnd.randrange(len(other))] = rnd.choice("xyzw")
            rows.append((50 * k + j, "".join(other)))
    prints = {r.fingerprint for r in X.fingerprints(spark.createDataFrame(rows, DOCS)).collect()}
    walk = X.walks()
    queries = sorted({X.as_text(n) for n in X.prints([t for i, t in rows if i % 50 == 0], walk)[2]})
    want = {(q, p) for q in queries for p in prints if q != p and X.likeness(walk.read(q), walk.read(p)) >= X.LEAST_LIKENESS}
    near = X.near(spark.createDataFrame([(q,) for q in queries], "fingerprint string"),
                  spark.createDataFrame([(p,) for p in prints], "fingerprint string"))
    found = {(r["query"], r["fingerprint"]) for r in near.collect()}
    assert len(want) > 40 and found <= want and len(found & want) >= 0.95 * len(want)
