import hashlib
import random
import re

import pytest
from llm_helpers import DOCS, by_value, odd_texts, with_clashes

from visitscope.llm import substring_dedup as S
from visitscope.llm.catalog import op8_substring_dedup


def brute(rows, window):
    """(id, words, removed, hash of the kept words), window by window."""
    first, words = {}, []
    for i, t in rows:
        i = S.LAST_ID if i is None else i
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        words.append((i, w))
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for (own, _), (i, w) in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((own, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def made_rows(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(150)]
    passages = [rnd.choices(vocabulary, k=rnd.randint(18, 70)) for _ in range(6)]
    rows = []
    for k in range(70):
        words = []
        for _ in range(rnd.randint(0, 4)):
            words += rnd.choices(vocabulary, k=rnd.randint(0, 30))
            p = rnd.choice(passages)
            a = rnd.randint(0, 10)
            words += p[a:rnd.randint(a, len(p))]
        rows.append((rnd.choice([k, k, k, None, k // 2]), " ".join(words)))
    return rows + rows[:5] + [(100 + k, "a a a a " * 30) for k in range(3)] + [(200, rows[3][1]), (0, rows[3][1]), (None, rows[3][1])]


@pytest.mark.parametrize("seed,window", [(1, 17), (2, 20), (3, 33)])
def test_random_rows(spark, seed, window):
    rows = made_rows(seed)
    want = brute(rows, window)
    assert any(r[2] for r in want)
    found = S.remove_digest(spark.createDataFrame(rows, DOCS).repartition(4), window).collect()
    assert by_value(found) == by_value(want)


def test_odd_rows_keep_their_columns(spark):
    rows = odd_texts()
    df = with_clashes(spark, rows)
    assert by_value(S.remove_digest(df).collect()) == by_value(brute(rows, 50))
    kept = S.dedup(df)
    assert kept.columns == df.columns and kept.count() == len(rows)
    found = [(r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in kept.collect()]
    assert by_value(found) == by_value([(i, h) for i, _, _, h in brute(rows, 50)])
    untouched = {r.doc_id: r.text for r in kept.collect()}
    assert untouched[10] == dict(rows)[10] and untouched[1] is None and untouched[3] == " \n\t "
    assert S.dedup(df.limit(0)).count() == 0 and S.remove_digest(df.limit(0)).count() == 0


def test_cut_keeps_white_space_outside():
    assert S.cut(" a b\tc  d\ne ", [{"start": 1, "length": 2}]) in (" a   d\ne ", " a d\ne ")


def test_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert by_value(op8_substring_dedup(spark, sf).collect()) == by_value(brute(rows, 50))


def test_window_bounds(spark):
    with pytest.raises(ValueError):
        S.find_windows(spark.createDataFrame([], DOCS), window=10)


def test_factors_at_the_least_length(spark):
    rnd = random.Random(8)
    passage = [f"p{k}" for k in range(60)]

    def around(part):
        return " ".join([f"x{rnd.random()}" for _ in range(30)] + part + [f"y{rnd.random()}" for _ in range(30)])

    rows = [(1, around(passage)), (2, around(passage[:49])), (3, around(passage[5:55])), (4, around(passage[5:56])), (5, around(passage))]
    found = {r.ord: (r.start, r.length, r.ref_ord, r.ref_start) for r in S.factors(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {3: (30, 50, 1, 35), 4: (30, 51, 1, 35), 5: (30, 60, 1, 30)}


def test_a_factor_goes_on_through_blocks_and_ends_with_its_reference(spark):
    rnd = random.Random(9)
    one, two = ([f"{c}{rnd.randrange(10**6)}" for _ in range(400)] for c in "ab")
    rows = [(1, " ".join(one)), (2, " ".join(two)), (3, " ".join(one[100:300] + two[50:250])), (4, " ".join(one[:120] + ["gap"] + one[120:]))]
    found = sorted((r.ord, r.start, r.length, r.ref_ord, r.ref_start) for r in S.factors(spark.createDataFrame(rows, DOCS)).collect())
    assert found == [(3, 0, 200, 1, 100), (3, 200, 200, 2, 50), (4, 0, 120, 1, 0), (4, 121, 280, 1, 120)]


def test_parse_joins_matches_of_one_reference():
    def mark(start, n, ref, at):
        return {"start": start, "n": n, "ref_ord": ref, "ref_key": 0, "ref_start": at}

    marks = [mark(10, 3, 1, 110), mark(0, 10, 1, 100), mark(13, 2, 1, 113), mark(15, 2, 1, 200), mark(17, 4, 2, 202), mark(30, 1, 2, 215)]
    assert S.parse(marks, 50) == [(0, 64, 1, 0, 100), (15, 51, 1, 0, 200), (17, 53, 2, 0, 202), (30, 50, 2, 0, 215)]


def test_a_span_without_its_reference_words_stays():
    words = [b"a", b"b", b"c"]
    held = {"start": 0, "length": 2, "digest": S.span_digest(words, 0, 2)}
    false = {"start": 1, "length": 2, "digest": S.span_digest(words, 0, 2)}
    assert S._doomed(words, [held]).tolist() == [True, True, False] and not S._doomed(words, [false]).any()
