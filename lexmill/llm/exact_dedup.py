"""Exact duplicates by two-pass Bloom filtering.

Texts are equal if they are identical after lower-casing A-Z; equal texts have
the same SHA-256. Of equal texts the row with the largest doc_id stays.

Pass 1 maps each hash to ``PLACES`` places of a bit array and counts how many
rows hit each place. Places hit at least twice are the filter: a hash that
occurs twice has hit all its places twice. Pass 2 tests every row; a row with a
place that was hit once is unique and passes straight through. Only the others,
the repeats and a few unlucky ones, are shuffled by their hash and compared.

The filter is the one thing that is broadcast. It has ``BITS_PER_ROW`` bits a
row, at most ``MAX_BITS`` (32 MiB); beyond that more unique rows are shuffled
needlessly, and the result stays the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import lower_ascii, staged, with_group

PLACES = 4
BITS_PER_ROW = 16
MAX_BITS = 1 << 28


def text_sha256(text: Column) -> Column:
    """Hex SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    return F.sha2(lower_ascii(text.cast("string")), 256)


def places(sha: Column, n_bits: int) -> list[Column]:
    """The places of a hash in the bit array: 15 hex digits of it for each."""
    digits = [F.conv(F.substring(sha, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(PLACES)]
    return [F.pmod(d, F.lit(n_bits)) for d in digits]


def repeated_places(hashes: DataFrame, n_bits: int) -> np.ndarray:
    """Pass 1: bytes of the bit array in which places hit by two or more rows are set."""
    hits = hashes.select(F.explode(F.array(*places(F.col("text_sha256"), n_bits))).alias("place"))
    twice = hits.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    word, bit = F.shiftright("place", 5), F.pmod("place", F.lit(32)).cast("int")
    words = twice.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")
    )
    found = words.toArrow()
    bits = np.zeros(n_bits // 32, dtype="<u4")
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits


def maybe_repeated(hashes: DataFrame, sha: Column, rows: int) -> Column:
    """Pass 2: whether a hash may occur more than once in ``hashes(text_sha256)``; never false for one that does."""
    n_bits = min(MAX_BITS, 1 << max(10, (max(rows, 1) * BITS_PER_ROW - 1).bit_length()))
    shared = hashes.sparkSession.sparkContext.broadcast(repeated_places(hashes, n_bits))

    @F.pandas_udf("boolean")
    def test(*columns: pd.Series) -> pd.Series:
        bits = shared.value
        hit = np.ones(len(columns[0]), dtype=bool)
        for column in columns:
            place = column.to_numpy(dtype=np.int64)
            hit &= (bits[place >> 5] >> (place & 31).astype(np.uint32) & 1).astype(bool)
        return pd.Series(hit)

    return test(*places(sha, n_bits))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs(doc_id, text)``.

    A null text counts as empty. Of rows that also share the largest doc_id, one
    is kept. A null doc_id is smaller than any other; if a group has no other,
    keep_id is null and one row is kept. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = staged(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_sha256(docs["text"]).alias("text_sha256")),
        "text-hashes",
    )
    tested = rows.withColumn("again", maybe_repeated(rows, F.col("text_sha256"), rows.count()))
    tested = staged(tested, "tested-hashes")
    alone = tested.where("not again").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    again = tested.where("again").select("doc_id", "text_sha256")
    # rows that share id and text are one row here, until they are written out again
    copies = again.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    groups = copies.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
    joined = with_group(copies, groups, "text_sha256", "group_size", again.count())
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return alone.unionByName(each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text, all columns: the one with the largest doc_id, then the largest other columns.

    Rows whose hash the filter shows to be unique are not shuffled.
    """
    sha, again = "exact dedup sha256", "exact dedup again"
    hashes = staged(docs.select(text_sha256(docs["text"]).alias("text_sha256")), "text-hashes")
    marked = docs.withColumn(sha, text_sha256(docs["text"]))
    # read and tested twice rather than staged: the texts are the larger cost
    marked = marked.withColumn(again, maybe_repeated(hashes, F.col(sha), hashes.count()))
    others = [c for c in docs.columns if c != "doc_id"]
    repeats = marked.where(F.col(again))
    kept = repeats.groupBy(sha).agg(F.max(F.struct("doc_id", *others)).alias("row")).select("row.*")
    return marked.where(~F.col(again)).select(*docs.columns).unionByName(kept.select(*docs.columns))
