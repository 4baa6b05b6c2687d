import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import DOCS, by_value, odd_texts, with_clashes

from visitscope.llm import decontamination as D
from visitscope.llm.catalog import op10_decontamination

ITEMS = "item_id long, text string, doc_id string"


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if n else set()


def brute(rows, items, share=0.8):
    out = []
    for i, t in rows:
        for item, q in items:
            n = min(5, len(re.findall(r"[^\x20\x09-\x0D]+", q or "")))
            own = shingles(q, n)
            shared = len(own & shingles(t, n))
            if own and shared >= share * len(own) - 1e-9:
                out.append((i, item, shared, len(own), shared / len(own)))
    return out


def made(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rnd.choices(words, k=rnd.choice([1, 3, 4, 5, 6, 9, 15, 30, 60])))) for k in range(40)]
    items += [(100, None), (101, ""), (102, items[7][1]), (None, items[9][1]), (103, "Mixed CASE Words Are Lowered here")]
    rows = []
    for k in range(60):
        parts = [rnd.choices(words, k=rnd.randint(0, 200))]
        for _ in range(rnd.randint(0, 3)):
            own = (rnd.choice(items)[1] or "").split()
            for _ in range(rnd.choice([0, 0, 1, 2])):  # a few words changed
                if own:
                    own[rnd.randrange(len(own))] = "zz"
            parts += [own, rnd.choices(words, k=rnd.randint(0, 20))]
        rows.append((rnd.choice([k, k, None]), " ".join(w for p in parts for w in p)))
    return rows + [(500, "x mixed case\nwords are  lowered HERE y"), rows[3], rows[3], (501, None), (502, "")], items


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows, items = made(seed)
        want = brute(rows, items)
        assert any(r[4] < 1 for r in want) and any(r[4] == 1 for r in want)
        benchmark = spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)
        docs = spark.createDataFrame(rows, DOCS).repartition(3)
        assert by_value(D.find_items(docs, benchmark).collect()) == by_value(want)
        # A bitmap that is full, and tells nothing apart, finds the same.
        assert by_value(D.find_items(docs, benchmark, filter_bits=64).collect()) == by_value(want)


def test_odd_rows(spark):
    rows, items = odd_texts(), [(1, "w1 w2 w3 w4 w5 w6 w7"), (2, "one two"), (3, "no id here")]
    benchmark = spark.createDataFrame([(i, t, "c") for i, t in items], ITEMS)
    df = with_clashes(spark, rows)
    assert by_value(D.find_items(df, benchmark).collect()) == by_value(brute(rows, items))
    kept = D.remove_contaminated(df, benchmark)
    bad = {t for _, t in rows if brute([(0, t)], items)}
    assert kept.columns == df.columns
    assert by_value((r.doc_id, r.text) for r in kept.collect()) == by_value(r for r in rows if r[1] not in bad)
    assert D.find_items(df, benchmark.limit(0)).count() == 0 and D.find_items(df.limit(0), benchmark).count() == 0
    assert D.remove_contaminated(df, benchmark.limit(0)).count() == len(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.sampled_from([0.5, 0.8, 0.9, 1.0]))
def test_a_sketch_meets_every_document_that_contains_enough(size, share):
    # A document may miss missing(size) shingles; the sketch holds one more, for the largest size of the class.
    largest = (1 << size.bit_length()) - 1
    assert D.missing(largest, share) >= D.missing(size, share)
    assert (size - D.missing(size, share)) >= share * size - 1e-9 > size - D.missing(size, share) - 1 - 1e-6


def test_query_over_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert by_value(op10_decontamination(spark, sf).collect()) == by_value(brute(rows, items))
