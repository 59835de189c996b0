"""Search by mode, and indexing straight from archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.bm25 import bm25
from lexmill.operators.boolean import boolean_search
from lexmill.operators.queries import Queries
from lexmill.operators.tfidf import tfidf
from lexmill.operators.tokens import StopWords
from lexmill.plans.index import Index, build_index
from lexmill.session import stage
from lexmill.sources.archives import catalogue
from lexmill.sources.news import doc_name, parse_archives

# Mode numbers of the search form; anything else means BM25.
BOOLEAN_MODES = (1, "1", "boolean")
RANKED_MODES = (2, "2", "ranked", "tfidf")


def search(index: Index, queries: Queries, mode: int | str | None = "bm25", **options) -> DataFrame:
    """(query_id, doc_id, doc_name, score, rank) by Boolean, tf-idf or BM25 search.

    Boolean hits are a set and have neither score nor rank.
    """
    if mode in BOOLEAN_MODES:
        return boolean_search(index, queries, **options).select(
            "*", F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("rank")
        )
    if mode in RANKED_MODES:
        return tfidf(index, queries, **options)
    return bm25(index, queries, **options)


def index_archives(
    spark: SparkSession,
    archives: str,
    path: str,
    stop_words: StopWords = None,
    lenient: bool = False,
    **options,
) -> tuple[Index, DataFrame, DataFrame]:
    """(index, documents, bad_records) of the news archives under ``archives``.

    Archives are unpacked and parsed once, into a staged table, in ranges of entries.
    Entries that are no news count as documents of length 0, as corpus statistics
    expect. Lenient reading records an archive that was cut short as a bad record
    without an entry name, which does not count.
    """
    parsed = stage(parse_archives(catalogue(spark, archives, lenient)), "news")
    good = F.col("error").isNull()
    documents = parsed.where(good).select(
        "doc_id", doc_name(F.col("doc_id")).alias("doc_name"), "title", "headline", "text"
    )
    bad_records = parsed.where(~good).select("zip_path", "entry_name", "error")
    index = build_index(
        documents, path, stop_words, n_bad_records=bad_records.where("entry_name is not null").count(), **options
    )
    return index, documents, bad_records
