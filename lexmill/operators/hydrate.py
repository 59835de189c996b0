"""Hits joined back to their documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import discard, local_copy, small_rows, stage


def hydrate(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """(query_id, rank, score, doc_id, doc_name, file_name, headline, text, manifest).

    The hits are written once to the shared folder. If they are few, they are
    broadcast and their ids filter the document scan; else both sides are
    joined by a shuffle. ``documents`` has doc_id, headline and text.
    """
    hits = stage(hits.select("query_id", "doc_id", "doc_name", "score", "rank"), "hits")
    texts = documents.select("doc_id", "headline", "text")
    rows = small_rows(hits)
    if rows is None:
        joined = texts.join(hits, "doc_id")
    else:
        discard(hits)
        ids = sorted({row.doc_id for row in rows})
        joined = texts.where(F.col("doc_id").isin(ids)).join(F.broadcast(local_copy(hits, rows)), "doc_id")
    file_name = F.replace("doc_name", F.lit("xml"), F.lit("txt"))
    return joined.select(
        "query_id",
        "rank",
        "score",
        "doc_id",
        "doc_name",
        file_name.alias("file_name"),
        "headline",
        "text",
        F.concat_ws(";", file_name, "headline").alias("manifest"),
    )
