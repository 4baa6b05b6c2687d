import zlib

from llm_helpers import DOCS, odd_texts, with_clashes

from visitscope.llm import toxicity as X
from visitscope.llm.catalog import op1_toxicity

LABELS = "doc_id long, quality int, toxic int"


def area(pairs):
    """Probability that a toxic text scores above another, ties half."""
    good = [s for s, y in pairs if not y]
    bad = [s for s, y in pairs if y]
    return sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = {r.doc_id: r for r in op1_toxicity(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(found) == 10000
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    held = [(found[i].score, y) for i, y in labels.items() if found[i].held_out]
    assert area(held) > 0.95
    hits = sum(s >= 0.3 and y for s, y in held)
    assert hits / sum(y for _, y in held) > 0.85 and hits / sum(s >= 0.3 for s, _ in held) > 0.85


def test_held_out_labels_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(X, "TREES", 5)
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", X.F.when(X.fold("doc_id") == X.HELD_OUT, 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    # Names and columns beside the text make no difference either.
    other = docs.withColumn("lang", X.F.lit("xx")).withColumn("source", X.F.lit("s"))
    assert sorted(X.scores(docs, labels).collect()) == sorted(X.scores(other, turned).collect())


def test_odd_rows_and_no_labels(spark):
    rows = [*odd_texts(), (20, "you are an idiot"), (21, "you are an 1d10t, m*o*r*o*n"), (22, "you are kind")]
    df = with_clashes(spark, rows)
    none = spark.createDataFrame([(4, 1, None), (None, 1, 1)], LABELS)
    found = X.scores(df, none).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(i) for i, _ in rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].score == 0 and by_id[20].predicted == 1 and by_id[21].predicted == 1 and by_id[22].predicted == 0
    assert by_id[None].held_out is False
    kept = X.keep_clean(df, none)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    one_class = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert X.scores(df, one_class).count() == len(rows)
    assert X.scores(spark.createDataFrame([], DOCS), none).count() == 0


def test_features():
    scanner = X.Scanner(X.Lexicon({"idiot": 3.0, "trash*": 2.0}))
    got = dict(zip(X.FEATURES, scanner.features("You IDIOT ! trashy 1d10t a b c d e f g h trashes"), strict=True))
    n = 14
    assert got["hit_rate"] == 4 / n and got["near_second_person"] == 3 / n and got["capitals_rate"] == 1 / n
    assert got["top_weight"] == 3.0 and got["exclaim_rate"] == 1 / n and got["obfuscated_rate"] == 1 / n
    assert scanner.features("") == scanner.features(" \n") == [0.0] * len(X.FEATURES)
    text = "You idiot " * 30000 + "x" * 1000
    whole = scanner.features(text)
    scanner.clear()
    X_SLICE, X.SLICE = X.SLICE, 1000  # slices make no difference
    assert [round(a, 9) for a in scanner.features(text)] == [round(a, 9) for a in whole]
    X.SLICE = X_SLICE


def test_slices_make_no_difference_wherever_words_stand(monkeypatch):
    scanner = X.Scanner(X.Lexicon({"idiot": 3.0}))
    for before in range(0, 40):
        for text in ("a " * before + "you idiot", "a " * before + "idiot b c you", "a " * before + "idiot " + "b " * 4 + "you " + "c " * 30):
            found = []
            for size in (1, 2, 7, 10, 1000):
                monkeypatch.setattr(X, "SLICE", size)
                scanner.clear()
                found.append([round(x, 9) for x in scanner.features(text)])
            assert all(f == found[0] for f in found) and dict(zip(X.FEATURES, found[0]))["near_second_person"] > 0, (before, text)


def test_one_weighted_row_a_margin_gives_the_same_curve(spark):
    rows = spark.createDataFrame([(k % 7 / 7, float((k * k) % 5 < k % 7)) for k in range(400)], "margin double, toxic double")
    grouped = rows.groupBy("margin").agg(X.F.avg("toxic").alias("toxic"), X.F.count(X.F.lit(1)).cast("double").alias("texts"))
    plain = X.IsotonicRegression(featuresCol="margin", labelCol="toxic").fit(rows)
    weighted = X.IsotonicRegression(featuresCol="margin", labelCol="toxic", weightCol="texts").fit(grouped)
    for at in (-1.0, 0.0, 0.1, 0.3, 0.5, 0.77, 1.0):
        assert abs(plain.predict(at) - weighted.predict(at)) < 1e-9
