"""Posting lists of given terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.queries import TermSide, as_queries, query_terms


def need_positions(index) -> None:
    if index.postings is None:
        raise ValueError("this needs a positional index")


def with_df(index, side: TermSide) -> TermSide:
    """Keep the terms the dictionary holds and add their document frequency."""
    return side.narrowed(side.join(index.terms))


def lookup(index, terms: list[str] | DataFrame) -> DataFrame:
    """(term, df, doc_id, tf, doc_len) of each matched term.

    ``terms`` is a list or ``DataFrame(term)``. Matching ignores case. A uniword
    index knows neither tf nor doc_len; both are null then.
    """
    index.need_terms()
    found = with_df(index, TermSide(_wanted(index, terms), index.shards))
    if index.postings is not None:
        return found.join(index.postings).select("term", "df", "doc_id", "tf", "doc_len")
    unknown = F.lit(None).cast("int")
    return found.join(index.doc_lists).select("term", "df", "doc_id", unknown.alias("tf"), unknown.alias("doc_len"))


def lookup_biwords(index, biwords: list[str] | DataFrame) -> DataFrame:
    """(biword, df, doc_id) of each matched pair of words."""
    if index.biwords is None:
        raise ValueError("this needs a biword index")
    side = TermSide(_wanted(index, biwords), index.shards)
    found = side.narrowed(side.join(index.biword_terms, "biword")).join(index.biwords, "biword")
    return found.select(F.col("term").alias("biword"), "df", "doc_id")


def matched_terms(index, queries) -> DataFrame:
    """(query_id, n_matched): distinct query terms the dictionary holds."""
    index.need_terms()
    terms = query_terms(as_queries(index.spark, queries)).select("query_id", "term").distinct()
    side = TermSide(terms, index.shards)
    return side.join(index.terms).groupBy("query_id").agg(F.count("*").alias("n_matched"))


def _wanted(index, terms: list[str] | DataFrame) -> DataFrame:
    if not isinstance(terms, DataFrame):
        terms = index.spark.createDataFrame([(t,) for t in terms], "term string")
    return terms.select(F.lower("term").alias("term")).distinct()
