"""Operator 1: toxicity by boosted trees over dense features, calibrated by isotonic regression.

Features are rates over a text's tokens: hits of a lexicon (density, weight,
distinct words), hits that stand near a second-person word, capitals,
punctuation, obfuscated spellings. The lexicon is a short fixed list and what
the labels teach: words and word beginnings that toxic texts hold far more
often than others do. Trees and calibration are fitted on different rows.

Labels are read only from rows whose crc32 of the id (as text) modulo
`FOLDS` is not `HELD_OUT`. Of those, the rows of remainder `CALIBRATION` (at
most `CALIBRATION_ROWS`) calibrate, the others (at most `FIT_ROWS`, by a hash of the id)
teach the lexicon and the trees; both bounds are samples of labelled rows.
Every text is scored whole, from its text alone.

Defined results: null text is the empty text; null ids are not held out, and
their labels are not read; a document with several labels is toxic if one says
so; without both classes among the fitted rows the score is 1 - exp(-hits of
the lexicon); rows that repeat are scored each; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, small_batches, staged, text_or_empty, texts

FOLDS, HELD_OUT, CALIBRATION = 4, 2, 3
FIT_ROWS = 20_000
CALIBRATION_ROWS = 10_000
THRESHOLD = 0.3
TREES, DEPTH = 30, 4
LEAST_TOXIC = 3          # toxic texts that must hold a unit of the lexicon, and
LEAST_SHARE = 0.0025     # the share of them
LEAST_ODDS = 1.0         # lower bound of its log odds ratio
PREFIXES = range(4, 9)   # lengths of word beginnings
NEAR = 5                 # tokens between a hit and a second-person word
REMEMBERED = 300_000     # tokens a Python worker remembers
SLICE = 100_000

# Insults and second-person words of the four languages.
INSULTS = frozenset("""idiot idiots moron morons stupid trash pathetic worthless disgusting clown clowns scum loser losers
    dumb fool fools jerk imbecile garbage filth filthy vermin freak freaks creep ugly
    dumm dummkopf trottel abschaum versager arschloch hurensohn ekelhaft
    idiote imbécile crétin connard salaud ordure débile abruti
    idiota estúpido estúpida imbécil basura asqueroso asquerosa payaso perdedor escoria""".split())
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur du dich dir dein deine deiner euch euer ihr
    tu te toi ton ta tes vous votre vos tú ti usted ustedes""".split())
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasiie")
SEED_WEIGHT = 3.0

COLUMNS = ("weight", "hit", "second", "capitals", "obfuscated", "obfuscated_hit", "punctuation", "exclaims", "digits", "length")
FEATURES = ("hit_rate", "hits", "weight_rate", "top_weight", "distinct_hits", "near_second_person", "second_person_rate",
            "capitals_rate", "punctuation_rate", "exclaim_rate", "obfuscated_rate", "obfuscated_hits", "digit_rate",
            "mean_length", "log_tokens")


def word_of(token: str) -> str:
    """A token's word: lower case, without signs around it."""
    word = token.lower()
    if not word.isalpha():
        a, b = 0, len(word)
        while a < b and not word[a].isalnum():
            a += 1
        while b > a and not word[b - 1].isalnum():
            b -= 1
        word = word[a:b]
    return word


def units(words: set[str]) -> set[str]:
    """Whole words and their beginnings, the latter marked by a star."""
    out = set(words)
    for w in words:
        for k in PREFIXES:
            if len(w) <= k:
                break
            out.add(w[:k] + "*")
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.weights.get(word, 0.0)
        for k in PREFIXES:
            if len(word) <= k:
                break
            found = max(found, self.weights.get(word[:k] + "*", 0.0))
        return found


class Scanner(dict):
    """Feature rows of tokens, remembered; the value of a token is its row's number."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon
        self.table = np.zeros((REMEMBERED + SLICE, len(COLUMNS)), dtype=np.float32)

    def __missing__(self, token: str) -> int:
        word = word_of(token)
        weight = self.lexicon.weight(word)
        inner = not word.isalpha() and word != ""
        obfuscated = obfuscated_hit = 0
        if inner and not word.isdigit():
            plain = "".join(c for c in word.translate(LOOKALIKES) if c.isalpha())
            obfuscated = int(any(c.isalpha() for c in word))
            again = self.lexicon.weight(plain)
            if again > weight:
                weight, obfuscated_hit = again, 1
        row = len(self)
        signs = sum(not c.isalnum() for c in token) if not token.isalnum() else 0
        self.table[row] = (weight, weight > 0, word in SECOND_PERSON, len(token) > 1 and token.isupper(), obfuscated,
                           obfuscated_hit, signs, token.count("!"), any(map(str.isdigit, token)) if not token.isalpha() else 0,
                           len(token))
        self[token] = row
        return row

    def features(self, text: str) -> list[float]:
        tokens = text.split()
        n = len(tokens)
        if not n:
            return [0.0] * len(FEATURES)
        total, top, distinct, hits, second = np.zeros(len(COLUMNS)), 0.0, set(), [], []
        for at in range(0, n, SLICE):
            if len(self) > REMEMBERED:
                self.clear()
            rows = np.array([self[t] for t in tokens[at:at + SLICE]])
            own = self.table[rows]
            total += own.sum(axis=0, dtype=np.float64)
            hit = np.flatnonzero(own[:, 1])
            if len(hit):
                top = max(top, float(own[hit, 0].max()))
                distinct.update(tokens[at + i] for i in hit.tolist())
                hits.append(hit + at)
            second.append(np.flatnonzero(own[:, 2]) + at)  # also without a hit: one may stand beyond the slice's edge
        sums = dict(zip(COLUMNS, total.tolist(), strict=True))
        near = 0
        if hits:
            hit, them = np.concatenate(hits), np.concatenate(second)
            near = int((np.searchsorted(them, hit + NEAR, side="right") > np.searchsorted(them, hit - NEAR)).sum())
        return [sums["hit"] / n, math.log1p(sums["hit"]), sums["weight"] / n, top, math.log1p(len(distinct)), near / n,
                sums["second"] / n, sums["capitals"] / n, sums["punctuation"] / max(1.0, sums["length"]), sums["exclaims"] / n,
                sums["obfuscated"] / n, math.log1p(sums["obfuscated_hit"]), sums["digits"] / n, sums["length"] / n, math.log(n)]


def with_features(rows: DataFrame, lexicon: Lexicon, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep` of `rows` and `features`, an array of doubles made from the text column."""
    small_batches(rows.sparkSession)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField("features", T.ArrayType(T.DoubleType(), False), False)])
    read = [*keep, *([text_col] if text_col not in keep else [])]
    at = read.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(lexicon)
        for batch in batches:
            found = [scanner.features(t) for t in texts(batch.column(at))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(found, pa.list_(pa.field("element", pa.float64(), False)))], names=schema.names)

    return rows.select(*read).mapInArrow(run, schema)


def _unit_counts(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """(unit, n): texts that hold each unit; `only` those given."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for text in texts(batch.column(0)):
            own = units({word_of(t) for t in set(text.split())})
            counts.update(own if only is None else own & only)
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["unit", "n"])

    return map_batches(rows.select("text"), run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """The lexicon that `rows` (text, toxic), a bounded sample, teach beside the fixed words."""
    by_class = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = by_class.get(1, 0), by_class.get(0, 0)
    weights = dict.fromkeys(INSULTS, SEED_WEIGHT)
    if toxic and clean:
        least = max(LEAST_TOXIC, math.ceil(LEAST_SHARE * toxic))
        held = {r.unit: r.n for r in _unit_counts(rows.where("toxic = 1"), None).where(F.col("n") >= least).collect()}
        other = {r.unit: r.n for r in _unit_counts(rows.where("toxic = 0"), frozenset(held)).collect()}
        for unit, a in held.items():
            b = other.get(unit, 0)
            odds = math.log((a + 0.5) / (toxic - a + 0.5)) - math.log((b + 0.5) / (clean - b + 0.5))
            spread = math.sqrt(sum(1 / (x + 0.5) for x in (a, b, toxic - a, clean - b)))
            if odds - 1.64 * spread >= LEAST_ODDS:
                weights[unit] = max(weights.get(unit, 0.0), odds - 1.64 * spread)
    return Lexicon(weights)


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None

    def score(self, rows: DataFrame, kept: list[str], text_col: str = "text") -> DataFrame:
        """The columns `kept` of `rows` and the `score` of its text column."""
        found = with_features(rows, self.lexicon, kept, text_col)
        if self.trees is None:
            return found.select(*kept, (1 - F.exp(-F.expm1(F.col("features")[1]))).alias("score"))
        found = self.trees.transform(found.withColumn("vector", array_to_vector("features")))
        found = found.withColumn("margin", vector_to_array("rawPrediction")[1])
        raw = vector_to_array("probability")[1]
        if self.calibration is None:
            return found.select(*kept, raw.alias("score"))
        # Calibration has steps; a fiftieth of the uncalibrated score orders the texts on one step.
        found = self.calibration.transform(found)
        return found.select(*kept, (F.col("calibrated") * 0.98 + raw * 0.02).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        fit_rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS, seed: int = 7) -> Model:
    """A model fitted on the labelled rows that are not held out."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
             .where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("fold", fold("doc_id")).where(F.col("fold") != HELD_OUT))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = staged(known.where(F.col("fold") != CALIBRATION).orderBy(*order).limit(fit_rows).unionAll(
        known.where(F.col("fold") == CALIBRATION).orderBy(*order).limit(calibration_rows)), "toxicity-chosen")
    # Bounded by the two sample sizes, so it may be broadcast.
    sample = staged(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
                    .join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "fold", "text"), "toxicity-sample")
    fitted = F.col("fold") != CALIBRATION
    lexicon = learn_lexicon(sample.where(fitted))
    rows = staged(with_features(sample, lexicon, ["doc_id", "toxic", "fold"]), "toxicity-features").withColumn("vector", array_to_vector("features"))
    classes = {(r.c, r.toxic): r.n for r in rows.groupBy((~fitted).alias("c"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(classes.get((False, k)) for k in (0, 1)):
        return Model(lexicon, None, None)
    trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=4,
                          subsamplingRate=1.0, seed=seed).fit(rows.where(fitted).repartition(2, "doc_id").sortWithinPartitions("doc_id"))
    calibration = None
    if all(classes.get((True, k)) for k in (0, 1)):
        # One weighted row for each margin, as many texts share one: the fit deals rows by margin.
        margins = (trees.transform(rows.where(~fitted)).select(vector_to_array("rawPrediction")[1].alias("margin"), "toxic")
                   .groupBy("margin").agg(F.avg("toxic").alias("toxic"), F.count(F.lit(1)).cast("double").alias("texts")))
        calibration = IsotonicRegression(featuresCol="margin", labelCol="toxic", weightCol="texts", predictionCol="calibrated").fit(margins)
    return Model(lexicon, trees, calibration)


def fold(id_col: str):
    """The id's fold: crc32 of its decimal text modulo `FOLDS`."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(FOLDS))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows whose text scores `threshold` or more, by a model fitted on `labels`."""
    model = fit(docs, labels, id_col, text_col)
    plain = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    scored = model.score(docs.toDF(*plain), plain, plain[docs.columns.index(text_col)])
    return scored.where(F.col("score") < threshold).select(*plain).toDF(*docs.columns)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) of every document, by a model fitted on `labels`."""
    model = fit(docs, labels, id_col, text_col)
    scored = model.score(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")), ["doc_id"])
    return scored.select(F.col("doc_id").alias(id_col), F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
