"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A text is described by rates, never by its words: how dense the words of a small
lexicon and of a lexicon learnt from the labelled rows are, how near they stand to
a second person, how much is written in capitals, how dense exclamation and symbol
runs are, and how many words are disguised (digits and symbols for letters, or
letters spelled apart) and belong to the lexicon once that is undone.

The labelled rows (``TRAIN_ROWS`` at most, those with the smallest hash of their
id) teach the second lexicon and the trees; a fifth of them, which the trees do not
see, calibrates the scores.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import least_hashes, staged

# At most so many labelled rows train the model.
TRAIN_ROWS = 50_000

# Learnt words occur in at least so many toxic texts and this share of them, and are so much likelier there.
LEARNT_TEXTS = 5
LEARNT_SHARE = 0.01
LEARNT_RATIO = 8.0
LEARNT_WORDS = 500

# Common insults of English, German, French and Spanish.
INSULTS = (
    "idiot idiots stupid moron morons loser losers trash scum clown pathetic worthless disgusting dumb jerk fool "
    "bastard bitch asshole crap shit fuck fucking retard freak creep pig filth garbage vermin "
    "dummkopf arschloch scheiße trottel abschaum versager wichser "
    "imbécile connard connasse salaud merde crétin ordure raclure "
    "idiota estúpido estúpida imbécil gilipollas basura escoria mierda cabrón payaso"
).split()

# Second persons of the same languages.
SECOND_PERSONS = "you your yours u ur du dich dir dein deine ihr euch tu toi te ton ta vous votre tú te ti usted tus vosotros".split()

# What stands for a letter in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": ""})

FEATURES = [
    "log_words",
    "insults",
    "insult_share",
    "learnt",
    "learnt_share",
    "learnt_distinct",
    "near_second_person",
    "second_person",
    "capitals",
    "capital_words",
    "exclamations",
    "symbol_runs",
    "disguised",
    "disguised_insults",
    "spelled_apart",
]

_WORDS = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"\b(?=\w*[^\W\d_])[^\W_]*[0134578@$!*][^\W_]+\b")
_APART = re.compile(r"\b(?:[^\W\d_][ .-]){3,}[^\W\d_]\b")
_RUNS = re.compile(r"[!?#$%&*@]{2,}")
_CAPITALS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")


def text_features(text: str, insults: frozenset[str], learnt: frozenset[str], seconds: frozenset[str]) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; an empty text has zeros."""
    words = _WORDS.findall(text.lower())
    n = max(len(words), 1)
    rude = [i for i, w in enumerate(words) if w in insults]
    known = [w for w in words if w in learnt]
    seconds_at = np.array([i for i, w in enumerate(words) if w in seconds])
    near = 0.0
    if rude and len(seconds_at):
        places = np.array(rude)
        after = np.searchsorted(seconds_at, places)
        gaps = np.minimum(
            np.abs(places - seconds_at[np.minimum(after, len(seconds_at) - 1)]),
            np.abs(places - seconds_at[np.maximum(after - 1, 0)]),
        )
        near = float((1 / gaps.clip(1)).sum())
    masked = _DISGUISED.findall(text.lower())
    bare = [w.translate(DISGUISE) for w in masked]
    apart = [re.sub(r"[ .-]", "", w) for w in _APART.findall(text.lower())]
    length = max(len(text), 1)
    return [
        float(np.log1p(len(words))),
        float(len(rude)),
        len(rude) / n * 100,
        float(len(known)),
        len(known) / n * 100,
        float(len(set(known))),
        near,
        len(seconds_at) / n * 100,
        sum(map(str.isupper, text)) / length * 100,
        len(_CAPITALS.findall(text)) / n * 100,
        text.count("!") / length * 100,
        len(_RUNS.findall(text)) / n * 100,
        len(masked) / n * 100,
        float(sum(w in insults or w in learnt for w in bare)),
        float(sum(w in insults or w in learnt for w in apart)),
    ]


def with_features(rows: DataFrame, learnt: list[str], keep: list[str]) -> DataFrame:
    """The columns ``keep``, which must not be named like features, then every feature; a null text counts as empty."""
    insults, seconds, known = frozenset(INSULTS), frozenset(SECOND_PERSONS), frozenset(learnt)

    @F.pandas_udf(", ".join(f"{f} double" for f in FEATURES))
    def measure(texts: pd.Series) -> pd.DataFrame:
        found = [text_features(t, insults, known, seconds) for t in texts]
        return pd.DataFrame(np.array(found, dtype=float).reshape(-1, len(FEATURES)), columns=FEATURES)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(*keep, measure(text).alias("measured")).select(*keep, "measured.*")


def in_fold(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, label) of the labelled rows outside fold 0, staged; at most ``train_rows`` documents.

    Labels that contradict each other for one id count with their mean, from 0.5 up as 1.
    """
    marked = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .where(in_fold(F.col("doc_id"), 5) != 0)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("toxic") >= 0.5).cast("double").alias("label"))
    )
    marked = staged(marked.withColumn("hash", F.xxhash64("doc_id")), "labelled-ids")
    chosen = least_hashes(marked, "hash", train_rows).drop("hash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return staged(texts.join(F.broadcast(chosen), "doc_id"), "training-texts")


def learnt_words(rows: DataFrame) -> list[str]:
    """The words that are much likelier in toxic texts than in others, by their share of texts."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)))
    n_toxic, n_clean = rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not n_toxic or not n_clean:
        return []
    per_word = (
        rows.select("label", F.explode(words).alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )
    ratio = ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
    found = per_word.where((F.col("toxic") >= max(LEARNT_TEXTS, LEARNT_SHARE * n_toxic)) & (ratio >= LEARNT_RATIO))
    return [r["word"] for r in found.orderBy(ratio.desc(), "word").limit(LEARNT_WORDS).collect()]


class Model:
    """The trees, the calibration and the learnt lexicon; without trees a fixed rate."""

    def __init__(self, learnt: list[str], trees=None, calibration=None, rate: float = 0.0):
        self.learnt, self.trees, self.calibration, self.rate = learnt, trees, calibration, rate

    def score(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` of ``rows`` and ``score``, from the text."""
        measured = with_features(rows, self.learnt, keep)
        if self.trees is None:
            return measured.select(*keep, F.lit(self.rate).alias("score"))
        scored = self.calibration.transform(_raw(self.trees, measured))
        # the calibration is a step function; a little of the trees' own probability tells rows on a step apart
        score = 0.98 * F.col("calibrated") + 0.02 * F.col("raw")
        return scored.select(*keep, F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))


def _raw(trees, measured: DataFrame) -> DataFrame:
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(measured)
    return trees.transform(vectors).withColumn("raw", vector_to_array("probability")[1])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model from the texts of ``labels(doc_id, toxic)`` outside fold 0. With no labelled row
    the score is 0, with one label only that label."""
    rows = training_rows(docs, labels, train_rows)
    seen = {r["label"] for r in rows.select("label").distinct().collect()}
    if len(seen) < 2:
        return Model([], rate=next(iter(seen), 0.0))
    apart = in_fold(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")), 5) == 0
    learnt = learnt_words(rows.where(~apart))  # nor do the calibration rows choose words
    measured = staged(with_features(rows, learnt, ["doc_id", "label"]), "training-features")
    fit, held = measured.where(~apart), measured.where(apart)
    if held.isEmpty() or fit.select("label").distinct().count() < 2:  # very few rows
        fit = held = measured
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(fit)
    trees = GBTClassifier(labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2, maxBins=64, seed=1).fit(vectors)
    steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated")
    return Model(learnt, trees, steps.fit(_raw(trees, held)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs(doc_id, text)``.

    A null or empty text is scored by its zero features. A null doc_id is not held
    out. Repeated rows come back as often; lang, source and other columns are not
    used. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = F.coalesce(in_fold(F.col("doc_id"), 5) == 0, F.lit(False))
    return model.score(rows, ["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that are predicted to be toxic, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("document"), "text")
    return model.score(rows, ["document"]).where("score < 0.5").select("document.*")
