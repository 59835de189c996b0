"""Document fingerprints: SimHash of weighted terms, and search by permuted block tables.

A term is a run of three words (A-Z lower-cased); its weight is 1 + log2 of how
often the text has it. Every term votes with its weight for or against each of
128 bits, as its hash has the bit or not; the fingerprint has the bits with more
votes for than against. The part of bits in which two fingerprints differ is the
angle between their texts' weighted terms, so ``likeness`` is its cosine, from 0
(unrelated) to 1.

Search: a fingerprint is cut into radius + 1 blocks. Two fingerprints that differ
in at most ``radius`` bits agree in a block. For each block there is a table with
that block in front as the key; a query looks up its own block in every table and
verifies what it finds. A pair that agrees in several blocks counts in the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm import tokens
from lexmill.llm.common import partitions, staged, with_group

BITS = 128
WORDS_IN_TERM = 3

# Rows of a key of a block table that are compared in one place.
BUCKET = 4096


def term_hashes(words: list[bytes]) -> np.ndarray:
    """16 bytes for every term; a text of fewer words than a term is one term."""
    import xxhash

    if not words:
        return np.zeros((0, 16), dtype=np.uint8)
    if len(words) < WORDS_IN_TERM:
        terms = [b" ".join(words)]
    else:
        terms = map(b" ".join, zip(*(words[i:] for i in range(WORDS_IN_TERM))))
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join(map(digest, terms)), dtype=np.uint8).reshape(-1, 16)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The 16 bytes of the fingerprint of a text with these terms; no terms, no bits."""
    _, first, counts = np.unique(hashes.view("<u8")[:, 0], return_index=True, return_counts=True)
    weights = 1 + np.log2(counts)
    votes = np.zeros(BITS)
    for at in range(0, len(first), 1 << 14):
        some = slice(at, at + (1 << 14))
        bits = np.unpackbits(hashes[first[some]], axis=1, bitorder="little")
        votes += weights[some].astype(np.float32) @ (bits.astype(np.float32) * 2 - 1)
    return np.packbits(votes > 0, bitorder="little")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of the angle between the texts, as far as the fingerprints tell; equal ones have 1."""
    apart = int(np.bitwise_count(a ^ b).sum())
    return max(0.0, float(np.cos(np.pi * apart / BITS)))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


class Document:
    """A text with its words, term hashes and fingerprint."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.words = doc_id, text, words_of(text)
        self.hashes = term_hashes(self.words)
        self.bits = fingerprint(self.hashes)

    def edited(self, following: "Document") -> tuple[str, np.ndarray]:
        """The text whose last quarter is replaced by the start of the next one, and its fingerprint.
        Terms that lie before the cut are not hashed again."""
        cut = len(self.text) // 4
        kept = self.text[: len(self.text) - cut]
        text = kept + following.text[:cut]
        whole = max(0, len(words_of(kept)) - WORDS_IN_TERM)  # terms of words that the cut does not touch
        words = words_of(text)
        hashes = np.concatenate([self.hashes[:whole], term_hashes(words[whole:])]) if whole else term_hashes(words)
        return text, fingerprint(hashes)


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, high, low, edited_high, edited_low, near_edited, near_next) of every row.

    ``docs(doc_id, text)`` in ascending order of ids, the first following the last.
    A null text counts as empty; a null doc_id comes first; rows with one doc_id are
    ordered by text. Other columns are not read; an empty table gives no rows.

    The texts are dealt once into ranges of ids whose limits are ids of the table.
    A range also gets a copy of the first document of the next, found by its id.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ids = rows.select("doc_id")
    count = 2 * partitions(docs.sparkSession)
    places = [float(x) for x in np.linspace(0, 1, count + 1)[1:-1]]
    found = ids.agg(
        F.min("doc_id").alias("first"),
        F.percentile_approx("doc_id", places, 10_000).alias("limits"),
        F.max(F.col("doc_id").isNull()).alias("unnamed"),
    ).first()
    limits = np.array(sorted({x for x in found["limits"] or [] if x > found["first"]}), dtype=np.int64)

    @F.pandas_udf("int")
    def piece_of(doc_ids: pd.Series) -> pd.Series:
        known = doc_ids.fillna(np.iinfo(np.int64).min).astype("int64")
        return pd.Series(np.searchsorted(limits, known.to_numpy(), side="right"), dtype="int32")

    start = F.col("doc_id").isNull() if found["unnamed"] else F.col("doc_id") == F.lit(found["first"])
    heads = rows.where(F.col("doc_id").isin([int(x) for x in limits]) | start)
    heads = heads.groupBy("doc_id").agg(F.min("text").alias("text"))
    own = rows.withColumns({"piece": piece_of("doc_id"), "after": F.lit(0)})
    before = F.pmod(piece_of("doc_id") - 1, F.lit(len(limits) + 1))
    dealt = own.unionByName(heads.withColumns({"piece": before, "after": F.lit(1)}))
    return (
        dealt.repartitionByRange(count, "piece")
        .sortWithinPartitions("piece", "after", "doc_id", "text")
        .select("piece", "after", "doc_id", "text")
        .mapInArrow(_compare, ", ".join(f"{f.name} {_SQL[f.type]}" for f in SCHEMA))
    )


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("high", pa.int64()),
        ("low", pa.int64()),
        ("edited_high", pa.int64()),
        ("edited_low", pa.int64()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_SQL = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: Document | None = None  # the row that waits for the one after it
    piece = None

    def row(document: Document, following: Document) -> tuple:
        text, bits = document.edited(following)
        low, high = (int(x) for x in document.bits.view("<i8"))
        edited_low, edited_high = (int(x) for x in bits.view("<i8"))
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(document.bits, bits), likeness(document.bits, following.bits)
        return (document.doc_id, len(document.text), sha, high, low, edited_high, edited_low, *near)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in SCHEMA]
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)

    for batch in batches:
        made = []
        for where, after, doc_id, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), tokens.texts_of(batch.column(3))
        ):
            if where != piece:
                piece, last = where, None
            if after and last is None:
                continue
            document = Document(doc_id, text)
            if last is not None:
                made.append(row(last, document))
            last = None if after else document
        yield batch_of(made)


# --- search -----------------------------------------------------------------------------


def blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of each block."""
    count = radius + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_keys(high: np.ndarray, low: np.ndarray, radius: int) -> np.ndarray:
    """The value of every block of every fingerprint, as an int64 (blocks wider than 63 bits are folded)."""
    pair = np.stack([low, high], axis=1).astype("<i8")
    bits = np.unpackbits(pair.view(np.uint8).reshape(-1, 16), axis=1, bitorder="little")
    keys = [
        bits[:, a : a + w].astype(np.int64) @ (np.int64(1) << (np.arange(w, dtype=np.int64) % 62)) for a, w in blocks(radius)
    ]
    return np.stack(keys, axis=1)


def near_rows(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(high, low, rows_near, first_near) for every fingerprint with ``asked``.

    ``prints(high, low, rows, first_id, asked)`` has each fingerprint once. Counts
    the rows, and finds the smallest id, of all fingerprints within ``radius`` bits,
    its own included. Keys of a block table with more than ``BUCKET`` rows are cut
    into chunks; a query meets every chunk, and its counts are added up.
    """
    tables = len(blocks(radius))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = block_keys(batch.column(0).to_numpy(), batch.column(1).to_numpy(), radius)
            for t in range(tables):
                columns = [pa.array(np.full(len(keys), t, dtype=np.int32)), pa.array(keys[:, t]), *batch.columns]
                yield pa.record_batch(columns, names=["block", "key", *batch.schema.names])

    columns = "high long, low long, rows long, first_id long, asked boolean"
    entries = staged(
        prints.select("high", "low", "rows", "first_id", "asked").mapInArrow(dealt, f"block int, key long, {columns}"),
        "block-tables",
    )
    large = (
        entries.groupBy("block", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("q"))
        .where(F.col("n") > BUCKET)
        .select("block", "key", F.ceil(F.col("n") / BUCKET).alias("c"), F.ceil(F.col("q") / BUCKET).alias("qc"))
    )
    c, qc = F.coalesce("c", F.lit(1)), F.greatest(F.coalesce("qc", F.lit(1)), F.lit(1))
    own = F.xxhash64("high", "low")
    joined = entries.join(large, ["block", "key"], "left").withColumns({"c": c, "qc": qc})
    chunk, query_chunk = F.pmod(own, F.col("c")), F.pmod(own, F.col("qc"))
    # stored rows go to their chunk, once for every chunk of queries; queries to their own, once for every chunk
    stored = joined.withColumn("query", F.lit(False)).withColumn(
        "place", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("qc") - 1), lambda i: chunk * F.col("qc") + i))
    )
    asking = joined.where("asked").withColumn("query", F.lit(True)).withColumn(
        "place", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("c") - 1), lambda i: i * F.col("qc") + query_chunk))
    )
    keys = ["block", "key", "place"]
    met = (
        stored.unionByName(asking)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "query")
        .select(*keys, "query", "high", "low", "rows", "first_id")
        .mapInArrow(_matches(radius), "high long, low long, rows_near long, first_near long")
    )
    return met.groupBy("high", "low").agg(F.sum("rows_near").alias("rows_near"), F.min("first_near").alias("first_near"))


def _matches(radius: int):
    names = ["high", "low", "rows_near", "first_near"]

    def search(run: list[np.ndarray], absent: np.ndarray) -> list[tuple]:
        """Counts for the queries of one run of equal keys, which come after the stored rows."""
        block, query = int(run[0][0]), run[3].astype(bool)
        high, low, rows, first = (c[~query] for c in run[4:8])
        hidden = absent[~query]
        keys = block_keys(high, low, radius)
        found = []
        for h, l in zip(run[4][query], run[5][query]):
            apart = np.bitwise_count((high ^ h).astype(np.uint64)) + np.bitwise_count((low ^ l).astype(np.uint64))
            near = np.flatnonzero(apart <= radius)
            if len(near):
                agree = keys[near] == block_keys(np.array([h]), np.array([l]), radius)
                near = near[agree.argmax(axis=1) == block]
            if len(near):
                ids = first[near][~hidden[near]]
                found.append((int(h), int(l), int(rows[near].sum()), int(ids.min()) if len(ids) else None))
        return found

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(columns: list[np.ndarray]) -> pa.RecordBatch:
            new = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(columns[0])]])
            asked = np.add.reduceat(columns[3].astype(int), starts[:-1]) > 0
            found = []
            for i in np.flatnonzero(asked):
                run = [c[starts[i] : starts[i + 1]] for c in columns]
                found += search(run[:8], run[8])
            columns = zip(*found) if found else [[] for _ in names]
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            ids = batch.column(7)
            columns += [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)]
            if held is not None:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            other = np.flatnonzero(np.any([c != c[-1] for c in columns[:3]], axis=0))
            cut = other[-1] + 1 if len(other) else 0  # the last run may go on in the next batch
            if cut:
                yield emit([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield emit(held)

    return match


def searched(rows: DataFrame, asked: Column, radius: int = 3) -> DataFrame:
    """``rows(doc_id, high, low, ...)``, staged, with rows_near and first_near where ``asked`` (else null)."""
    marked = rows.withColumn("asked", F.coalesce(asked, F.lit(False)))
    prints = marked.groupBy("high", "low").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("doc_id").alias("first_id"),
        F.max("asked").alias("asked"),
        F.count_if("asked").alias("asking"),
    )
    prints = staged(prints, "distinct-fingerprints")
    key = F.concat(F.hex("high"), F.lit("-"), F.hex("low"))
    sizes = prints.where("asked").select("high", "low", "asking")
    found = near_rows(prints, radius).join(sizes, ["high", "low"]).select(key.alias("print"), "asking", "rows_near", "first_near")
    found = staged(found, "near-rows")
    queries = marked.where("asked").withColumn("print", key)
    total = found.agg(F.coalesce(F.sum("asking"), F.lit(0))).first()[0]
    answered = with_group(queries, found, "print", "asking", total).select(*rows.columns, "rows_near", "first_near")
    nothing = F.lit(None).cast("long")
    others = marked.where(~F.col("asked")).select(*rows.columns, nothing.alias("rows_near"), nothing.alias("first_near"))
    return answered.unionByName(others)


def hex_digits(high: str, low: str) -> Column:
    return F.concat(*(F.lpad(F.lower(F.hex(c)), 16, "0") for c in (high, low)))
