import hashlib
from collections import defaultdict

import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from oracle import connect, differences
from pyspark.sql import functions as F

from lexmill.llm import exact_dedup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_query_matches_sql(spark):
    assert differences(queries.op9_exact_dedup(spark, SF_DIR), connect(SF_DIR), queries.SQL["op9_exact_dedup"]) == []


@pytest.mark.parametrize("bits", [16, 1])
def test_odd_documents(odd_documents, monkeypatch, bits):
    """A filter that is far too small lets more rows through to the shuffle, with the same result."""
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", bits)
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 1 << (28 if bits > 1 else 5))
    groups = defaultdict(list)
    for row in odd_documents.collect():
        groups[hashlib.sha256((row["text"] or "").translate(LOWER).encode()).hexdigest()].append(row["doc_id"])
    expected = []
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = [keep]
        for i in ids:
            kept = i == keep and bool(left) and left.pop() == keep
            expected.append((i, keep, len(ids), kept, sha))
    found = [tuple(r) for r in exact_dedup.exact_duplicates(odd_documents).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_drop_repeats(spark, odd_documents, no_documents):
    kept = exact_dedup.drop_repeats(odd_documents)
    assert kept.columns == odd_documents.columns
    found = sorted((r["doc_id"], (r["text"] or "")[:3]) for r in kept.collect())
    assert found == sorted([(2, "the"), (4, ""), (5, " \t\n"), (6, "wor"), (7, "one"), (7, "two"), (8, "É p"), (9, "wor")])
    assert exact_dedup.drop_repeats(no_documents).count() == 0
    assert exact_dedup.exact_duplicates(no_documents).count() == 0
    # a group of copies that holds most rows
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "Same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_dedup.exact_duplicates(many)
    assert rows.where("kept").count() == 1001
    assert rows.where("group_size = 2000").select("keep_id").distinct().collect()[0][0] == 2999


def test_unique_rows_are_not_shuffled(spark):
    """The filter leaves nearly all unique hashes out."""
    hashes = spark.range(20_000).select(exact_dedup.text_sha256(F.col("id").cast("string")).alias("text_sha256"))
    again = exact_dedup.maybe_repeated(hashes, F.col("text_sha256"), 20_000)
    assert hashes.where(again).count() < 200
