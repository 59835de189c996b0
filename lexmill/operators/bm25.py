"""BM25 ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.weights import REFERENCE, STANDARD, bm25_weight, check_variant
from lexmill.operators.lookup import need_positions, with_df
from lexmill.operators.pruning import pruned, worth_pruning
from lexmill.operators.queries import Queries, TermSide, as_queries, query_terms
from lexmill.operators.ranking import EXACT_DIGITS, top_hits
from lexmill.operators.substring import mask_rows, substring_sums, substring_terms

# Result limits, and the least positive score the reference
# variant reports (below it a score is printed with an exponent and lost).
DEFAULT_K = {STANDARD: 50, REFERENCE: 51}
DEFAULT_MATCH = {STANDARD: "exact", REFERENCE: "substring"}
LEAST_PRINTED_SCORE = 1e-3


def bm25(
    index,
    queries: Queries,
    k: int | None = None,
    k1: float = 1.2,
    b: float = 0.75,
    match: str | None = None,
    variant: str = STANDARD,
    stats: DataFrame | None = None,
    prune: bool | None = None,
) -> DataFrame:
    """(query_id, doc_id, doc_name, score, rank), best first.

    A query term that occurs twice counts twice. ``match="substring"`` lets a
    query term match every index term that contains it; None means the variant's
    own way (exact for the standard, substring for the reference variant). k None
    means the variant's own limit, k=0 all hits without ranks. ``stats(n_docs, avg_len)``
    replaces the statistics of the index. ``prune`` skips blocks of documents that
    cannot hold a hit, where the index has their maxima; None means where the query's
    frequent terms have many postings. The hits are the same.
    """
    check_variant(variant)
    need_positions(index)
    match = match or DEFAULT_MATCH[variant]
    counted = (
        query_terms(as_queries(index.spark, queries)).groupBy("query_id", "term").agg(F.count("*").alias("n"))
    )
    if match == "exact":
        side = with_df(index, TermSide(counted, index.shards))
    elif match == "substring":
        many = mask_rows(counted)
        side = None if many else TermSide(substring_terms(index.terms, counted), index.shards)
    else:
        raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
    corpus = (index.stats if stats is None else stats.first()).asDict()
    avg_len = corpus["avg_len"] if variant == REFERENCE else corpus.get("avg_len_exact", corpus["avg_len"])

    def weight(tf: str, doc_len: str, n: Column | None = None) -> Column:
        n_docs, average = F.lit(corpus["n_docs"]), F.lit(float(avg_len or 1))
        return (F.col("n") if n is None else n) * bm25_weight(F.col(tf), F.col("df"), F.col(doc_len), n_docs, average, k1, b, variant)

    def summed(matched: DataFrame, weight: Column = weight("tf", "doc_len")) -> DataFrame:
        # rounding a sum below zero to zero does not make it a hit of the reference variant
        total = F.sum(weight)
        return matched.groupBy("query_id", "doc_id").agg(F.round(total, EXACT_DIGITS).alias("score"), (total < 0).alias("below"))

    k = DEFAULT_K[variant] if k is None else k
    monotone = variant == STANDARD and match == "exact" and k > 0 and k1 >= 0 and 0 <= b <= 1 and index.maxima is not None
    if monotone and (worth_pruning(index, side) if prune is None else prune):
        scored = pruned(index, side, weight("max_tf", "min_len"), summed, k)
    elif side is None:
        keys = ["shard", "term"] if index.shards else ["term"]
        weighted = index.postings.join(index.terms, keys).select("doc_id", "term", weight("tf", "doc_len", F.lit(1)).alias("weight"))
        # a document is in one sum, so nothing is left to add up
        totals = substring_sums(weighted, many)
        scored = totals.select("query_id", "doc_id", F.round("total", EXACT_DIGITS).alias("score"), (F.col("total") < 0).alias("below"))
    else:
        scored = summed(side.join(index.postings))
    ties = None
    if variant == REFERENCE:
        scored = scored.where(((F.col("score") == 0) & ~F.col("below")) | (F.col("score") >= LEAST_PRINTED_SCORE))
        ties = F.col("doc_id").cast("string")
    return top_hits(scored.drop("below"), k, ties)
