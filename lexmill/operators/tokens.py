"""Tokenizing documents.

A document is one row, so its tokens are kept as an array column until the last
moment: positions, lengths, term frequencies and word pairs of a document come
out of a projection and need no shuffle. Two rules keep such plans linear:

* arrays are built in separate ``select`` steps, so that no step recomputes the
  one below it for every element;
* arrays are exploded by the ``outer`` generators. The inner ones make the
  optimizer infer ``size(array) > 0`` and push it, with the whole array
  expression, down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as txt
from lexmill.session import salted, small_rows, stage

# A stop list of up to so many words becomes a hash-set test. A longer one is measured:
# up to so many bytes it is broadcast, beyond that it is joined.
INLINE_STOP_WORDS = 10_000
BROADCAST_STOP_BYTES = 128 << 20

StopWords = Iterable[str] | DataFrame | None


def document_body(docs: DataFrame) -> Column:
    """Title and text where there is a title, else the text."""
    if "title" in docs.columns:
        return txt.news_body(F.col("title"), F.col("text"))
    return txt.plain_body(F.col("text"))


def word_arrays(docs: DataFrame, include_id_token: bool = False, on_blanks: bool = False) -> DataFrame:
    """(doc_id, doc_len, words): token count and word tokens of each document."""
    body = document_body(docs)
    if include_id_token:
        body = txt.with_id_token(body, F.col("doc_id"))
    split = txt.split_on_blanks if on_blanks else txt.split_tokens
    return docs.select("doc_id", split(body).alias("tokens")).select(
        "doc_id", F.size("tokens").alias("doc_len"), F.filter("tokens", txt.is_word).alias("words")
    )


def inline_stop_words(stop_words: StopWords) -> list[str] | None:
    """The stop list as Python strings, nulls left out, or None if it has too many words for that."""
    if stop_words is None:
        return []
    if isinstance(stop_words, DataFrame):
        rows = small_rows(stop_words.select("word"), INLINE_STOP_WORDS)
        return None if rows is None else [row.word for row in rows if row.word is not None]
    words = [word for word in stop_words if word is not None]
    return words if len(words) <= INLINE_STOP_WORDS else None


def kept_words(
    docs: DataFrame,
    stop_words: StopWords = None,
    include_id_token: bool = False,
    on_blanks: bool = False,
) -> DataFrame:
    """(doc_id, doc_len, kept): words that are no stop words, with positions.

    ``kept`` is array<struct<pos, raw>>. Stop words take up positions; tokens
    that are no words do not. A token is a stop word if it is in the list once
    the blanks around it are trimmed, however long the list is.
    """
    if stop_words is not None and not isinstance(stop_words, DataFrame):
        stop_words = list(stop_words)
    words = word_arrays(docs, include_id_token, on_blanks)
    inline = inline_stop_words(stop_words)
    if inline is None:
        if isinstance(stop_words, list):
            stop_words = docs.sparkSession.createDataFrame([(word,) for word in stop_words], "word string")
        listed = stage(stop_words.select("word").where("word is not null").distinct(), "stop-words")
        size = listed.agg(F.coalesce(F.sum(F.octet_length("word") + 8), F.lit(0))).first()[0]
        if size <= BROADCAST_STOP_BYTES:
            return _without_broadcast_stop_words(words, listed.toArrow().column("word").combine_chunks())
        return _without_joined_stop_words(words, listed)
    placed = words.select(
        "doc_id",
        "doc_len",
        F.transform("words", lambda w, i: F.struct((i + 1).alias("pos"), w.alias("raw"))).alias("kept"),
    )
    if not inline:
        return placed
    return placed.select(
        "doc_id",
        "doc_len",
        F.filter("kept", lambda k: ~txt.is_one_of(k.raw, inline)).alias("kept"),
    )


def _without_broadcast_stop_words(words: DataFrame, listed: pa.Array) -> DataFrame:
    """Stop filter by a lookup in a broadcast list, document by document, without a shuffle."""
    shared = words.sparkSession.sparkContext.broadcast(listed)
    placed = words.select(
        "doc_id",
        "doc_len",
        F.transform("words", lambda w, i: F.struct((i + 1).alias("pos"), w.alias("raw"))).alias("kept"),
        F.transform("words", txt.trimmed_token).alias("trimmed"),
    )
    schema = placed.drop("trimmed").schema

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.column("kept")
            stays = pc.invert(pc.is_in(batch.column("trimmed").flatten(), value_set=shared.value))
            parents = pc.list_parent_indices(kept).filter(stays).to_numpy(zero_copy_only=False)
            offsets = np.append(0, np.bincount(parents, minlength=batch.num_rows).cumsum())
            left = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept.flatten().filter(stays))
            yield pa.record_batch([batch.column("doc_id"), batch.column("doc_len"), left], names=schema.names)

    return placed.mapInArrow(drop, schema)


def _without_joined_stop_words(words: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Stop filter by an equi-join on the token, for lists of any size."""
    placed = words.select(F.monotonically_increasing_id().alias("doc_key"), "*").select(
        "doc_key", "doc_id", "doc_len", F.posexplode_outer("words").alias("i", "raw")
    )
    placed = placed.withColumn("word", txt.trimmed_token(F.col("raw")))
    placed, stops = salted(placed, stop_words.select("word", F.lit(True).alias("stop")).distinct(), "doc_key")
    return (
        placed.join(stops, ["word", "salt"], "left")
        .groupBy("doc_key", "doc_id", "doc_len")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.when(
                        F.col("stop").isNull() & F.col("raw").isNotNull(),
                        F.struct((F.col("i") + 1).alias("pos"), "raw"),
                    )
                )
            ).alias("kept")
        )
        .select("doc_id", "doc_len", "kept")
    )


def tokenize(docs: DataFrame, stop_words: StopWords = None, include_id_token: bool = False) -> DataFrame:
    """(doc_id, doc_len, pos, raw, term): one row per kept word."""
    return (
        kept_words(docs, stop_words, include_id_token)
        .select("doc_id", "doc_len", F.inline_outer("kept"))
        .where(F.col("raw").isNotNull())
        .select("doc_id", "doc_len", "pos", "raw", txt.normalize_term(F.col("raw")).alias("term"))
    )


def term_arrays(kept: DataFrame) -> DataFrame:
    """(doc_id, doc_len, terms): array<struct<term, pos>> in position order."""
    return kept.select(
        "doc_id",
        "doc_len",
        F.transform(
            "kept", lambda k: F.struct(txt.normalize_term(k.raw).alias("term"), k.pos.alias("pos"))
        ).alias("terms"),
    )
