import hashlib
import math

from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from oracle import connect, differences
from pyspark.sql import functions as F

from lexmill.llm import mixing, queries


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing what is above the limits until none is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * weight[s] / share for s in order}
        above = {s for s in order if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def plain_copies(doc_id, rate):
    named = f"mix:{'null' if doc_id is None else doc_id}"
    unit = int(hashlib.md5(named.encode()).hexdigest()[:13], 16) / 2**52
    return math.floor(rate) + (unit < rate - math.floor(rate))


def check(docs):
    rows = docs.collect()
    size = lambda text: len((text or "").encode().split())
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + size(r["text"])
    targets = plain_targets(sizes)
    assert math.isclose(sum(targets.values()), sum(sizes.values()))
    found = mixing.copies_of(mixing.sizes_of(docs), mixing.sizes_of(docs)).collect()
    assert len(found) == len(rows)
    expected = []
    for r in rows:
        source = r["source"]
        rate = targets[source] / sizes[source] if sizes[source] else 0
        expected.append((r["doc_id"], source, size(r["text"]), sizes[source], round(float(targets[source]), 6), plain_copies(r["doc_id"], rate)))
    got = [(r["doc_id"], r["source"], r["size"], r["source_size"], round(r["target"], 6), r["copies"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    return expected


def test_query_matches_sql(spark):
    assert differences(queries.op8_mixing(spark, SF_DIR), connect(SF_DIR), queries.SQL["op8_mixing"]) == []


def test_odd_documents(odd_documents, no_documents):
    expected = check(odd_documents)
    mixed = mixing.mix(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert mixed.count() == sum(e[-1] for e in expected)
    assert mixing.mix(no_documents).count() == 0
    assert mixing.sizes_of(no_documents).count() == 0


def test_limits_are_reshared(spark):
    """Weights far from the sizes: several sources stop at their limit, one after the other."""
    rows = [(i, "x " * n, s) for i, (n, s) in enumerate([(1, "a"), (2, "b"), (3, "c"), (400, "d"), (50, "é"), (9, "z"), (0, "y"), (70, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    expected = check(docs)
    assert sum(t == 3 * size for *_, size, t, _ in expected) >= 3


def test_many_documents_come_near_their_targets(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("word word word").alias("text"), F.format_string("s%d", F.col("id") % 4).alias("source")
    )
    sizes = mixing.sizes_of(docs)
    per = mixing.copies_of(sizes, sizes).groupBy("source").agg(F.max("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n"))
    assert all(abs(r["n"] - r["t"]) < 0.1 * r["t"] for r in per.collect())


def test_sources_beyond_a_broadcast(spark, monkeypatch, odd_documents):
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    check(odd_documents)


def test_no_python_on_the_main_path(spark):
    plan = queries.op8_mixing(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
