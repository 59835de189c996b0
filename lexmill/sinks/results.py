"""Hits, hydrated documents and statistics as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import local_copy, small_rows
from lexmill.sinks.files import write_files


def hit_lines(hits: DataFrame, style: str) -> DataFrame:
    """(query_id, rank, line) of hits.

    Styles: ``names`` (document names), ``scores`` (name, tab, score) and
    ``ids`` (document ids).
    """
    styles = {
        "names": F.col("doc_name"),
        "scores": F.concat_ws("\t", "doc_name", F.col("score").cast("string")),
        "ids": F.col("doc_id").cast("string"),
    }
    if style not in styles:
        raise ValueError(f"style must be one of {sorted(styles)}, not {style!r}")
    rank = F.col("rank") if "rank" in hits.columns else F.lit(None).cast("int")
    return hits.select("query_id", "doc_id", rank.alias("rank"), styles[style].alias("line"))


def write_hits(hits: DataFrame, path: str, style: str = "parquet") -> None:
    """Write hits as Parquet, or as text lines: in rank order, the queries one after another."""
    if style == "parquet":
        hits.write.parquet(path)
        return
    _in_rank_order(hit_lines(hits, style), "line").write.text(path)


def _in_rank_order(lines: DataFrame, column: str) -> DataFrame:
    """The lines sorted by query and rank. Few rows, counted first, are sorted as they are; others by ranges."""
    few = small_rows(lines)
    rows = lines if few is None else local_copy(lines, few).coalesce(1)
    order = ["query_id", "rank", "doc_id"]
    return (rows.orderBy(*order) if few is None else rows.sortWithinPartitions(*order)).select(column)


def write_documents(hydrated: DataFrame, path: str, per_file: bool = False) -> None:
    """Write each hit's headline and text under ``path/text``, and the manifest.

    They are a table (file_name, content); with ``per_file`` every document is a
    file of its own, ``text/<file_name>``.
    """
    once = hydrated.dropDuplicates(["doc_id"])
    content = F.concat(F.coalesce("headline", F.lit("")), F.lit("\n\n"), F.col("text"))
    if per_file:
        write_files(once.select(F.col("file_name").alias("name"), content.alias("content")), f"{path}/text")
    else:
        once.select("file_name", content.alias("content")).write.parquet(f"{path}/text")
    _in_rank_order(hydrated.select("query_id", "rank", "doc_id", "manifest"), "manifest").write.text(f"{path}/manifest")


def write_corpus_stats(stats: DataFrame, path: str) -> None:
    """Write the statistics as one line, ``N <tab> average length``."""
    stats.select(F.concat_ws("\t", "n_docs", "avg_len")).write.text(path)
