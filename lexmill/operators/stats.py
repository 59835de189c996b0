"""Corpus statistics and document norms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.weights import STANDARD, check_variant, tf_weight
from lexmill.operators.tokens import word_arrays


def document_lengths(docs: DataFrame, include_id_token: bool = False) -> DataFrame:
    """(doc_id, doc_len): all tokens count, stop words and punctuation too."""
    return word_arrays(docs, include_id_token).select("doc_id", "doc_len")


def corpus_stats(lengths: DataFrame, n_bad_records: int = 0) -> DataFrame:
    """(n_docs, total_len, avg_len, avg_len_exact) over ``lengths(doc_len)``.

    Unreadable archive entries may be counted as documents of length 0. An empty
    corpus has average 0.
    """
    return (
        lengths.agg(
            (F.count("*") + F.lit(n_bad_records)).alias("n_docs"),
            F.coalesce(F.sum(F.col("doc_len").cast("long")), F.lit(0)).alias("total_len"),
        )
        .withColumn(
            "avg_len_exact",
            F.when(F.col("n_docs") == 0, 0.0).otherwise(F.col("total_len").cast("double") / F.col("n_docs")),
        )
        .select("n_docs", "total_len", F.floor("avg_len_exact").alias("avg_len"), "avg_len_exact")
    )


def document_norms(postings: DataFrame, variant: str = STANDARD) -> DataFrame:
    """(doc_id, norm) from postings: L2, or the root of the plain weight sum."""
    return postings.groupBy("doc_id").agg(norm_of_postings(variant).alias("norm"))


def norm_of_postings(variant: str = STANDARD) -> Column:
    """The norm of a document, as an aggregate of its postings."""
    check_variant(variant)
    weight = tf_weight(F.col("tf"))
    return F.sqrt(F.sum(weight * weight) if variant == STANDARD else F.sum(weight))
