import zlib

import pytest
from llm_cases import no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from lexmill.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.01"


def auc(pairs):
    """Chance that a row of label 1 scores above one of label 0, ties half."""
    high = [s for s, label in pairs if label]
    low = [s for s, label in pairs if not label]
    return sum((a > b) + 0.5 * (a == b) for a in high for b in low) / (len(high) * len(low))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"  # enough held-out toxic rows to measure
    labels = {r["doc_id"]: r["toxic"] for r in queries.table(spark, sf_dir, "labels").collect()}
    rows = queries.op3_toxicity(spark, sf_dir).collect()
    assert len(rows) == queries.table(spark, sf_dir, "documents").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(held) > 500 and auc(held) > 0.95
    assert sum((s >= 0.5) == bool(label) for s, label in held) / len(held) > 0.95


def test_only_training_labels_count(spark):
    """Turning the labels of the held-out fold round changes no score."""
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    labels = queries.table(spark, "/root/testdata/sf0.001", "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.in_fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    rows = [toxicity.training_rows(docs, table).select("doc_id", "label").collect() for table in (labels, turned)]
    assert sorted(rows[0]) == sorted(rows[1]) and rows[0]


def test_odd_documents(spark, odd_documents, no_documents):
    labels = queries.table(spark, SF_DIR, "labels")
    model = toxicity.train(queries.table(spark, SF_DIR, "documents"), labels)
    rows = toxicity.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (3, 4, 5)}
    assert len(empty) == 1
    kept = toxicity.keep_clean(odd_documents, model)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in rows)
    assert toxicity.score(no_documents, model).count() == 0


def test_without_labels(spark, odd_documents):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd_documents, toxicity.train(odd_documents, none)).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd_documents, toxicity.train(odd_documents, ones)).collect()} == {1.0}


@pytest.mark.parametrize(
    "text,feature",
    [
        ("you idiot", "near_second_person"),
        ("what an id1ot", "disguised_insults"),
        ("what an i d i o t", "spelled_apart"),
        ("WHAT NOW", "capital_words"),
        ("oh $#@! no", "symbol_runs"),
        ("no!", "exclamations"),
    ],
)
def test_features(text, feature):
    values = toxicity.text_features(text, frozenset(toxicity.INSULTS), frozenset(), frozenset(toxicity.SECOND_PERSONS))
    assert values[toxicity.FEATURES.index(feature)] > 0
    plain = toxicity.text_features("a quiet sentence", frozenset(toxicity.INSULTS), frozenset(), frozenset())
    assert plain[toxicity.FEATURES.index(feature)] == 0
