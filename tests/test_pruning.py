"""Searches that skip blocks give the hits of searches that score everything."""

import random

import pytest
from pyspark.sql import functions as F

import lexmill as lx
from lexmill.operators import pruning
from lexmill.operators.lookup import with_df
from lexmill.operators.queries import TermSide, as_queries, query_terms

QUERIES = ["hot", "hot hot warm", "hot rare3", "warm rare1 rare2", "rare5 absent", "hot warm cold rare0", "absent"]


@pytest.fixture(scope="module")
def searched(spark, tmp_path_factory):
    """6,000 documents that all hold one term, often once, seldom many times; ids with gaps, and one below zero."""
    order = random.Random(6)
    rows = []
    for i in range(6000):
        words = ["hot"] * (order.randrange(5, 40) if order.random() < 0.004 else 1)
        words += ["warm"] * (order.random() < 0.3) + ["cold"] * order.randrange(3) + ["filler"] * order.randrange(30, 60)
        words += [f"rare{order.randrange(300)}"]
        rows.append(((i * 3 if i else -5) + (10**9 if i > 4000 else 0), " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return lx.build_index(docs, str(tmp_path_factory.mktemp("pruned") / "index"), kinds=("positional",), shards=3, frequent_df=500)


@pytest.mark.parametrize("k", [1, 7, 50, 10_000])
def test_hits_are_the_same(searched, k):
    for search, options in ((lx.bm25, {}), (lx.bm25, {"k1": 2.0, "b": 0.0}), (lx.tfidf, {})):
        plain = sorted(map(tuple, search(searched, QUERIES, k=k, prune=False, **options).collect()))
        assert sorted(map(tuple, search(searched, QUERIES, k=k, prune=True, **options).collect())) == plain
        assert len({row[0] for row in plain}) == 6


def test_a_small_part_of_a_term_in_every_document_is_read(spark, searched):
    assert searched.maxima.select("term").distinct().count() == 4
    counted = query_terms(as_queries(spark, "hot")).groupBy("query_id", "term").agg(F.count("*").alias("n"))
    side = with_df(searched, TermSide(counted, searched.shards))
    seen = []

    def scored(matched):
        seen.append(matched)
        return matched.groupBy("query_id", "doc_id").agg(F.sum("tf").cast("double").alias("score"))

    blocks = pruning.chosen_blocks(searched, side, F.col("max_tf").cast("double"), scored, 5)
    every = searched.maxima.where("term = 'hot'").count()
    assert every > 30 and blocks.count() <= every // 4
    (ranges,) = [pruning.id_ranges([r.block for r in blocks.collect()], searched.block_bits)]
    read = searched.postings.where("term = 'hot'").where(ranges)
    assert 5 <= read.count() <= 6000 // 4
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "doc_id" in plan.split("PushedFilters")[1].split("ReadSchema")[0]


def test_ranges_of_blocks(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(-20, 60), None]], "doc_id long")
    for blocks in ([0, 1, 3], [-2], [pruning.NO_BLOCK, 5], [2, 2, 1]):
        found = {r.doc_id for r in ids.where(pruning.id_ranges(blocks, 3)).collect()}
        named = ids.withColumn("block", pruning.block_of(F.col("doc_id"), 3))
        assert found == {r.doc_id for r in named.where(F.col("block").isin(blocks)).collect()}
    assert pruning.id_ranges(list(range(0, 2000, 2)), 3) is None


def test_large_searches_prune_by_themselves(spark, searched, monkeypatch):
    counted = query_terms(as_queries(spark, "hot warm")).groupBy("query_id", "term").agg(F.count("*").alias("n"))
    side = with_df(searched, TermSide(counted, searched.shards))
    assert not pruning.worth_pruning(searched, side)
    monkeypatch.setattr(pruning, "WORTH_POSTINGS", 6000)
    assert pruning.worth_pruning(searched, side)
    plain = [tuple(r) for r in lx.bm25(searched, "hot warm", k=9, prune=False).orderBy("rank").collect()]
    assert [tuple(r) for r in lx.bm25(searched, "hot warm", k=9).orderBy("rank").collect()] == plain
