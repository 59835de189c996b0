"""Term weights as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STANDARD = "standard"
REFERENCE = "reference"


def check_variant(variant: str) -> None:
    if variant not in (STANDARD, REFERENCE):
        raise ValueError(f"variant must be 'standard' or 'reference', not {variant!r}")


def tf_weight(tf: Column) -> Column:
    return F.lit(1.0) + F.log10(tf.cast("double"))


def idf_weight(freq: Column, n_docs: Column, variant: str = STANDARD) -> Column:
    """log10(N / freq); the reference variant divides integers.

    A truncated quotient of 0 gives minus infinity, where Spark's log10 alone
    would give null.
    """
    check_variant(variant)
    if variant == STANDARD:
        return F.log10(n_docs.cast("double") / freq.cast("double"))
    quotient = F.floor(n_docs.cast("double") / freq.cast("double"))
    return F.when(quotient < 1, F.lit(float("-inf"))).otherwise(F.log10(quotient.cast("double")))


def bm25_weight(
    tf: Column,
    df: Column,
    doc_len: Column,
    n_docs: Column,
    avg_len: Column,
    k1: float,
    b: float,
    variant: str = STANDARD,
) -> Column:
    """Weight of one posting for one query term.

    The reference variant takes the term frequency where the standard formula
    takes the document frequency, truncates both quotients, and knows no length
    for documents that hold the term once.
    """
    check_variant(variant)
    tf_d = tf.cast("double")
    if variant == STANDARD:
        idf = idf_weight(df, n_docs)
        ratio = doc_len.cast("double") / avg_len
    else:
        idf = idf_weight(tf, n_docs, REFERENCE)
        known_len = F.when(tf == 1, F.lit(0)).otherwise(doc_len)
        ratio = F.floor(known_len.cast("double") / avg_len).cast("double")
    saturation = F.lit(k1) * (F.lit(1.0 - b) + F.lit(b) * ratio) + tf_d
    return idf * (F.lit(k1 + 1.0) * tf_d / saturation)
