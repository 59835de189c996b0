"""Phrases whose words occur together far more often than apart, from an FM-index of each shard.

A shard is the texts of one language that a task has met, up to ``SHARD_TOKENS``
words, as word numbers with a mark between pieces. Phrases grow by a word a round,
and a phrase goes on only if it is frequent over all shards:

1. The counts of words are summed over the shards; rare words become marks.
2. Each shard makes its FM-index: the Burrows-Wheeler transforms of its numbers and
   of the reversed numbers, sorted by the ``MOST_WORDS`` numbers that follow, which
   is all that phrases of that many words need. An interval of each transform,
   of one size, stands for a phrase; the size is the phrase's count in the shard.
3. A round extends every interval by all words that occur next to the phrase, to the
   right by the reversed transform or to the left by the other one, in turn, and
   keeps both intervals in step. An extension whose other words, without its first
   or last, are no frequent phrase is left out. The counts are summed over the
   shards, and the shards go on with those that reach the limit. As long as these
   are few, they are broadcast, and a shard extends anew from its words, so that
   neither indexes nor intervals are shuffled; more are joined to the shards' intervals.

Most pairs of frequent words are rare, so pairs are first counted by a hash (Park, Chen and
Yu): the counts of its buckets are summed over the shards as bytes, and only pairs whose
bucket reaches the limit are counted as rows. A bucket counts its pairs at least as often
as they occur, so none that is frequent is lost, and the counts that follow are exact.

A phrase is known by its two shorter forms, without its last and without its first
word, so ids are exact and no task needs words again. The frequent phrases get their
words, and the counts of all their beginnings and ends, by joins with the shorter ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import partitions
from lexmill.llm.unigrams import Numbers, shard_number, shard_runs
from lexmill.session import discard, local_copy, small_rows, stage

MOST_WORDS = 5
SHARD_TOKENS = 2_000_000

# Frequent phrases of one length that are broadcast, counted first; more are joined.
BROADCAST_PHRASES = 500_000

# Buckets that pairs are counted by: a power of two, one for at most so many words (and over half as many). A bit of
# each is broadcast, at most 32 MiB; beyond that, more rare pairs share a bucket with enough others, and are rows.
BUCKET_WORDS = 128
LEAST_BUCKETS, MOST_BUCKETS = 1 << 16, 1 << 28

# What ends a piece, and the mark for it, which is then in no word.
ENDS = b".,;:!?\n\x0b\x0c\r"
MARK = b"."
_TO_MARKS = bytes(ord(MARK) if b in ENDS else b for b in range(256))


# --- shards ---------------------------------------------------------------------------------


def tokens_of(text: bytes) -> list[bytes]:
    """Words, A-Z lower-cased, and marks between pieces."""
    return text.lower().translate(_TO_MARKS).replace(MARK, b" . ").split()


def phrase_shards(docs: DataFrame) -> DataFrame:
    """(shard, lang, tokens, words, counts, numbers) of ``docs(lang, text binary)``; number 0 is a mark."""

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = 0, 0
        langs: dict[str, tuple[Numbers, list[bytes]]] = {}

        def shards() -> pa.RecordBatch:
            rows = []
            for k, (lang, (ids, parts)) in enumerate(langs.items()):
                numbers = b"".join(parts)
                counts = np.bincount(np.frombuffer(numbers, dtype="<i4"), minlength=len(ids))
                counts[0] = 0
                rows.append((shard_number(made + k), lang, int(counts.sum()), list(ids), counts, zlib.compress(numbers, 1)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary())
            names = ["shard", "lang", "tokens", "words", "counts", "numbers"]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                if lang not in langs:
                    langs[lang] = Numbers({MARK: 0}), []
                ids, parts = langs[lang]
                own = np.array([*map(ids.__getitem__, tokens_of(text.as_py())), 0], dtype="<i4")
                parts.append(own.tobytes())
                held += len(own)
                if held >= SHARD_TOKENS:
                    yield shards()
                    made, held, langs = made + len(langs), 0, {}
        if langs:
            yield shards()

    schema = "shard long, lang string, tokens long, words array<binary>, counts array<long>, numbers binary"
    return docs.select("lang", "text").mapInArrow(sharded, schema)


# --- the index of a shard ---------------------------------------------------------------------


def transform(text: np.ndarray) -> np.ndarray:
    """The Burrows-Wheeler transform of a cyclic text, sorted by the next ``MOST_WORDS`` numbers."""

    def ranks(first: np.ndarray, then: np.ndarray) -> np.ndarray:
        return np.unique(first * (int(then.max(initial=0)) + 1) + then, return_inverse=True)[1].astype(np.int64)

    one = text.astype(np.int64)
    two = ranks(one, np.roll(one, -1))
    four = ranks(two, np.roll(two, -2))
    order = np.argsort(ranks(four, np.roll(one, -4)), kind="stable")
    return text[order - 1]


def extended(bwt: np.ndarray, low: np.ndarray, size: np.ndarray, other_low: np.ndarray) -> tuple[np.ndarray, ...]:
    """All extensions of intervals by one number: (interval, number, low, size, low in the other transform)."""
    n, kinds = len(bwt), int(bwt.max(initial=0)) + 1
    parent = np.repeat(np.arange(len(low)), size)
    places = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
    pairs, counts = np.unique(parent * kinds + bwt[places], return_counts=True)
    parent, number = pairs // kinds, pairs % kinds
    # numbers that sort before, within the interval, come first in the other transform
    before = np.cumsum(counts) - counts
    first = np.searchsorted(parent, np.arange(len(low)))
    before -= before[first[parent]] if len(parent) else 0
    order = np.argsort(bwt, kind="stable")
    occurrences = bwt[order].astype(np.int64) * n + order
    new_low = np.searchsorted(occurrences, number * n + low[parent])
    keep = number > 0
    return tuple(c[keep] for c in (parent, number, new_low, counts, other_low[parent] + before))


def packed(values: np.ndarray, kind: str) -> bytes:
    return values.astype(kind).tobytes()


INDEX = "shard long, gids binary, left binary, right binary"


def index_row(shard: int, number: np.ndarray, gid: np.ndarray, numbers: bytes) -> pa.RecordBatch | None:
    """The FM-index of a shard over its frequent words, which have these numbers; None if it has none."""
    if not len(number):
        return None
    own = np.frombuffer(zlib.decompress(numbers), dtype="<i4")
    local = np.zeros(int(max(own.max(initial=0), number.max())) + 1, dtype=np.int32)
    local[number] = np.arange(1, len(number) + 1)
    text = np.append(np.int32(0), local[own])
    text = text[np.append(True, (text[1:] > 0) | (text[:-1] > 0))]  # one mark at a time
    kind = "<u2" if len(number) < 1 << 16 else "<i4"
    columns = [packed(gid, "<i8"), packed(transform(text), kind), packed(transform(text[::-1]), kind)]
    return pa.record_batch([pa.array([shard]), *(pa.array([c]) for c in columns)], names=["shard", "gids", "left", "right"])


def indexes_by_dictionary(shards: DataFrame, words: DataFrame) -> DataFrame:
    """``INDEX`` of each shard over ``words(lang, word, gid)``, few enough to be broadcast: each shard looks up its own."""
    known: dict[str, dict[bytes, int]] = {}
    for lang, word, gid in zip(*(c.to_pylist() for c in words.select("lang", "word", "gid").toArrow().columns)):
        known.setdefault(lang, {})[word] = gid
    shared = shards.sparkSession.sparkContext.broadcast(known)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, lang, own, numbers in zip(*(batch[c] for c in ("shard", "lang", "words", "numbers"))):
                gids_of = shared.value.get(lang.as_py(), {})
                gid = np.array([gids_of.get(w, 0) for w in own.as_py()], dtype=np.int64)
                number = np.flatnonzero(gid)
                row = index_row(shard.as_py(), number, gid[number], numbers.as_py())
                if row is not None:
                    yield row

    return shards.select("shard", "lang", "words", "numbers").mapInArrow(made, INDEX)


def indexes(words: DataFrame, shards: DataFrame, parts: int) -> DataFrame:
    """``INDEX`` of each shard over ``words(shard, number, gid)``, its frequent words."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, found = None, []
        for batch in batches:
            for start, end in shard_runs(batch["shard"].to_numpy()):
                some = batch.slice(start, end - start)
                if some["shard"][0].as_py() != here:
                    here, found = some["shard"][0].as_py(), []
                is_word = pc.is_valid(some["number"])
                words = some.filter(is_word)
                found.append((words["number"].to_numpy(), words["gid"].to_numpy()))
                for numbers in some.filter(pc.invert(is_word))["numbers"]:  # after all words of the shard
                    row = index_row(here, *(np.concatenate(c) for c in zip(*found)), numbers.as_py())
                    if row is not None:
                        yield row

    texts = shards.select("shard", F.lit(None).cast("int").alias("number"), F.lit(None).cast("long").alias("gid"), "numbers")
    both = words.select("shard", "number", "gid", F.lit(None).cast("binary").alias("numbers")).unionByName(texts)
    return by_shard(both, parts, F.asc_nulls_last("number")).mapInArrow(made, INDEX)


def by_shard(rows: DataFrame, parts: int, order: Column) -> DataFrame:
    return rows.repartitionById(parts, F.pmod(F.xxhash64("shard"), F.lit(parts)).cast("int")).sortWithinPartitions("shard", order)


PHRASES = ("gid", "prefix", "suffix", "first", "last", "low", "right_low", "size")
FOUND = "shard long, prefix long, suffix long, first long, last long, low long, right_low long, size long"


def word_phrases(gids: np.ndarray, bwt: np.ndarray) -> list[np.ndarray]:
    """The columns ``PHRASES`` of a shard's words: a word's interval comes after those of all smaller numbers."""
    ends = np.cumsum(np.bincount(bwt, minlength=len(gids) + 1))
    low, size, none = ends[:-1], np.diff(ends), np.zeros(len(gids), dtype=np.int64)
    return [gids, none, none, gids, gids, low, low, size]


def grown(phrases: list[np.ndarray], gids: np.ndarray, bwt: np.ndarray, right: bool) -> list[np.ndarray]:
    """The extensions of one shard's frequent phrases: the columns of ``FOUND`` but the first."""
    gid, prefix, suffix, first, last, low, right_low, size = phrases
    # an extension X w is frequent only if (X without its first word) w is; that phrase has prefix suffix(X) and last w
    inner, inner_side, end = (suffix, prefix, last) if right else (prefix, suffix, first)
    mine, other = (right_low, low) if right else (low, right_low)
    parent, number, new, count, new_other = extended(bwt, mine, size, other)
    word = gids[number - 1]
    known = np.unique(np.concatenate([inner, inner_side]))
    words = np.unique(np.concatenate([end, gids]))
    key = lambda a, b: np.searchsorted(known, a) * len(words) + np.searchsorted(words, b)
    keys = key(inner_side, end)
    order = np.argsort(keys)
    keys = keys[order]
    asked = key(inner[parent], word)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    keep = keys[at] == asked
    parent, word, new, count, new_other, rest = (c[keep] for c in (parent, word, new, count, new_other, gid[order][at]))
    whole = gid[parent]
    if right:
        return [whole, rest, first[parent], word, new_other, new, count]
    return [rest, whole, word, last[parent], new, new_other, count]


def extensions(index: DataFrame, phrases: DataFrame, right: bool, parts: int) -> DataFrame:
    """``FOUND``: each shard's count of every phrase that extends a frequent one."""
    column = "right" if right else "left"

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        names = [c.split()[0] for c in FOUND.split(", ")]
        for batch in batches:
            for start, end in shard_runs(batch["shard"].to_numpy()):
                some = batch.slice(start, end - start)
                if some["shard"][0].as_py() != here:
                    here, held = some["shard"][0].as_py(), []
                is_phrase = pc.is_valid(some["gid"])
                held.append(some.filter(is_phrase).select([*PHRASES]))
                for row in some.filter(pc.invert(is_phrase)).to_pylist():  # after all phrases of the shard
                    table = pa.Table.from_batches(held)
                    if not len(table):
                        continue
                    gids = np.frombuffer(row["gids"], dtype="<i8")
                    bwt = np.frombuffer(row["bwt"], dtype="<u2" if len(gids) < 1 << 16 else "<i4")
                    columns = grown([table[c].to_numpy() for c in PHRASES], gids, bwt, right)
                    for at in range(0, len(columns[0]), 1 << 18):
                        slices = [pa.array(c[at : at + (1 << 18)], pa.int64()) for c in columns]
                        yield pa.record_batch([pa.array(np.full(len(slices[0]), here)), *slices], names=names)

    blank = lambda kind: F.lit(None).cast(kind)
    texts = index.select("shard", *(blank("long").alias(c) for c in PHRASES), "gids", F.col(column).alias("bwt"))
    rows = phrases.select("shard", *PHRASES, blank("binary").alias("gids"), blank("binary").alias("bwt"))
    return by_shard(rows.unionByName(texts), parts, F.asc_nulls_last("gid")).mapInArrow(extend, FOUND)


class Level:
    """The frequent phrases of one length, to look up their ids by prefix and suffix."""

    def __init__(self, prefix: np.ndarray, suffix: np.ndarray, gid: np.ndarray):
        self.prefixes, self.suffixes = np.unique(prefix), np.unique(suffix)
        keys = self.key(prefix, suffix)
        order = np.argsort(keys)
        self.keys, self.gids = keys[order], gid[order]

    def key(self, prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.prefixes, prefix) * (len(self.suffixes) + 1) + np.searchsorted(self.suffixes, suffix)

    def frequent(self, found: list[np.ndarray]) -> list[np.ndarray]:
        """The columns ``PHRASES`` of those of ``found`` that are in the level."""
        prefix, suffix = found[:2]
        if not len(self.keys):
            return [c[:0] for c in (prefix, *found)]
        known = np.isin(prefix, self.prefixes) & np.isin(suffix, self.suffixes)
        at = np.minimum(np.searchsorted(self.keys, self.key(prefix, suffix)), len(self.keys) - 1)
        known &= self.keys[at] == self.key(prefix, suffix)
        return [self.gids[at[known]], *(c[known] for c in found)]


def from_words(index: DataFrame, levels: list, likely: Broadcast, counts_only: bool) -> DataFrame:
    """``FOUND``, or its columns of counts: the extensions of the last of the broadcast levels, made anew from words.

    ``levels`` are those of two and more words; the extensions have one word more. Pairs
    are left out unless the bits ``likely`` have their bucket.
    """

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FOUND.split(", ")]
        known = [Level(*level.value) for level in levels]
        for batch in batches:
            for shard, gids, left, right in zip(*(batch[c] for c in ("shard", "gids", "left", "right"))):
                gids = np.frombuffer(gids.as_py(), dtype="<i8")
                kind = "<u2" if len(gids) < 1 << 16 else "<i4"
                sides = [np.frombuffer(side.as_py(), dtype=kind) for side in (left, right)]
                found = grown(word_phrases(gids, sides[0]), gids, sides[1], True)
                keep = is_likely(likely.value, *found[:2])
                found = [c[keep] for c in found]
                for length, level in enumerate(known, 3):
                    found = grown(level.frequent(found), gids, sides[length % 2 == 0], length % 2 == 0)
                for at in range(0, len(found[0]), 1 << 18):
                    slices = [pa.array(c[at : at + (1 << 18)], pa.int64()) for c in found]
                    if counts_only:
                        yield pa.record_batch([slices[0], slices[1], slices[-1]], names=["prefix", "suffix", "size"])
                    else:
                        yield pa.record_batch([pa.array(np.full(len(slices[0]), shard.as_py())), *slices], names=names)

    return index.mapInArrow(extend, "prefix long, suffix long, size long" if counts_only else FOUND)


# --- pairs counted by a hash ------------------------------------------------------------------


def buckets_of(first: np.ndarray, second: np.ndarray, buckets: int) -> np.ndarray:
    """A hash of pairs of ids; ``buckets`` is a power of two."""
    odd, other = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = first.astype(np.uint64) * odd
    mixed = ((mixed ^ (mixed >> np.uint64(29))) + second.astype(np.uint64)) * other
    mixed = (mixed ^ (mixed >> np.uint64(32))) * odd
    return (mixed >> np.uint64(65 - buckets.bit_length())).astype(np.uint32)


def is_likely(bits: np.ndarray, prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Whether the bits of ``likely_pairs`` have the bucket of a pair."""
    at = buckets_of(prefix, suffix, 8 * len(bits))
    return (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def likely_pairs(index: DataFrame, least: int, buckets: int) -> np.ndarray:
    """A bit for each bucket, set if the pairs of words in it occur ``least`` times over all shards (255 are enough)."""
    enough = min(least, 255)
    chunk = max(buckets >> 10, 1 << 10)  # buckets that are a row

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            bucket, count = np.unique(np.concatenate(held), return_counts=True)
            count = np.minimum(count, enough).astype(np.uint8)
            chunks, starts = np.unique(bucket // chunk, return_index=True)
            packs = []
            for start, end in zip(starts, [*starts[1:], len(bucket)]):
                some = np.zeros(chunk, dtype=bool)
                some[bucket[start:end] % chunk] = True
                packs.append(zlib.compress(np.packbits(some).tobytes() + count[start:end].tobytes(), 1))
            return pa.record_batch([pa.array(chunks, pa.int32()), pa.array(packs, pa.binary())], names=["chunk", "counts"])

        for batch in batches:
            for gids, left in zip(batch["gids"], batch["left"]):
                gids = np.frombuffer(gids.as_py(), dtype="<i8")
                before = np.frombuffer(left.as_py(), dtype="<u2" if len(gids) < 1 << 16 else "<i4")
                number = np.sort(before)  # the number that follows each number of the transform
                pairs = (before > 0) & (number > 0)
                held.append(buckets_of(gids[before[pairs] - 1], gids[number[pairs] - 1], buckets))
                if sum(map(len, held)) >= 2 * SHARD_TOKENS:
                    yield rows()
                    held = []
        if held:
            yield rows()

    def summed(rows: pa.Table) -> pa.Table:
        total = np.zeros(chunk, dtype=np.uint16)
        for counts in rows["counts"]:  # a bit for each bucket that has a count, and these counts
            own = np.frombuffer(zlib.decompress(counts.as_py()), dtype=np.uint8)
            some = np.unpackbits(own[: chunk // 8]).astype(bool)
            total[some] = np.minimum(total[some] + own[chunk // 8 :], enough)
        bits = np.packbits(total >= enough, bitorder="little").tobytes()
        return pa.table({"chunk": rows["chunk"][:1], "bits": pa.array([bits], pa.binary())})

    counts = index.select("gids", "left").mapInArrow(counted, "chunk int, counts binary")
    sums = counts.groupBy("chunk").applyInArrow(summed, "chunk int, bits binary").toArrow()
    found = np.zeros((buckets // chunk, chunk // 8), dtype=np.uint8)
    for at, bits in zip(sums["chunk"].to_pylist(), sums["bits"]):
        found[at] = np.frombuffer(bits.as_py(), dtype=np.uint8)
    return found.ravel()


# --- phrases of all shards --------------------------------------------------------------------


def met(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` joined with a table of frequent ones, which is broadcast if it has few rows, counted first."""
    few = small_rows(table)
    return rows.join(table if few is None else F.broadcast(local_copy(table, few)), keys)


def frequent_phrases(docs: DataFrame, least: int, most_words: int = MOST_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """The frequent phrases of 1, 2, ... words, and (lang, n).

    (gid, prefix, suffix, f), of one word also lang and phrase; gids are of one length only.
    """
    if not 1 <= most_words <= MOST_WORDS:
        raise ValueError(f"phrases have 1 to {MOST_WORDS} words")
    shards = stage(phrase_shards(docs), "phrase-shards")
    totals = stage(shards.groupBy("lang").agg(F.sum("tokens").alias("n")), "word-totals")
    parts = max(partitions(docs.sparkSession), -(-shards.count() // 4))
    each = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("number", "w")).where("number > 0")
    each = each.select("shard", "lang", "number", F.col("w.words").alias("word"), F.col("w.counts").alias("size"))
    nothing = F.lit(0).cast("long")
    words = each.groupBy("lang", "word").agg(F.sum("size").alias("f")).where(F.col("f") >= least)
    words = stage(words.select((F.monotonically_increasing_id() + 1).alias("gid"), nothing.alias("prefix"), nothing.alias("suffix"), "f", "lang", "word"), "phrases-1")
    if words.count() <= BROADCAST_PHRASES:
        index = stage(indexes_by_dictionary(shards, words), "fm-index")
    else:
        own = stage(each.join(words.select("lang", "word", "gid"), ["lang", "word"]).select("shard", "number", "gid"), "frequent-words")
        index = stage(indexes(own, shards, parts), "fm-index")
        discard(own)
    levels = [words.withColumn("phrase", F.col("word").cast("string")).drop("word")]

    discard(shards)
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    buckets = min(max(1 << (tokens // BUCKET_WORDS).bit_length(), LEAST_BUCKETS), MOST_BUCKETS)
    likely = docs.sparkSession.sparkContext.broadcast(likely_pairs(index, least, buckets))
    few: list | None = []  # the levels broadcast so far; None from the first on that is not
    phrases = None
    for length in range(2, most_words + 1):
        if few is not None:
            found = from_words(index, few, likely, counts_only=True)
        else:
            found = stage(extensions(index, phrases, length % 2 == 0, parts), "extensions")
        summed = found.groupBy("prefix", "suffix").agg(F.sum("size").alias("f")).where(F.col("f") >= least)
        level = stage(summed.select((F.monotonically_increasing_id() + 1).alias("gid"), "prefix", "suffix", "f"), f"phrases-{length}")
        levels.append(level)
        if length == most_words:
            break
        if few is not None and level.count() <= BROADCAST_PHRASES:
            columns = level.select("prefix", "suffix", "gid").toArrow()
            few.append(docs.sparkSession.sparkContext.broadcast(tuple(c.to_numpy() for c in columns.columns)))
            continue
        if few is not None:
            found, few = from_words(index, few, likely, counts_only=False), None
        phrases = met(found, level.select("gid", "prefix", "suffix"), ["prefix", "suffix"])
    return levels, totals


def collocations(docs: DataFrame, least: int = 100, most_words: int = MOST_WORDS, k: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``k`` phrases of 2 to ``most_words`` words.

    ``docs(lang, text)``: a null lang is ``und``, a null or empty text has no words; repeated
    rows count each. A piece ends at ``.,;:!?`` and line ends, words at blanks and tabs; A-Z
    are lower-cased. a is the phrase's count, l and r those of its two sides at the cut with
    the lowest score floor(1000 * a * n / (l * r)), the first such cut; n the language's
    words. A phrase inside a longer one with the same count is left out. Ties are ordered
    by count, then phrase. Other columns are not read; an empty table gives no rows.
    """
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    levels, totals = frequent_phrases(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text")), least, most_words)
    known = levels[0].select("gid", "lang", "phrase", F.col("phrase").alias("tail"), "f", F.array("f").alias("begins"), F.array("f").alias("ends"))
    candidates = []
    for length, level in enumerate(levels[1:], 2):
        begin = known.select(F.col("gid").alias("prefix"), "lang", "phrase", "begins")
        end = known.select(F.col("gid").alias("suffix"), "tail", "ends")
        joined = level.join(begin, "prefix").join(end, "suffix")
        known = stage(
            joined.select(
                "gid",
                "lang",
                F.concat_ws(" ", "phrase", "tail").alias("phrase"),
                "tail",
                "f",
                F.concat(F.array("f"), "begins").alias("begins"),  # counts of the first length, length - 1, ... words
                F.concat(F.array("f"), "ends").alias("ends"),
            ),
            f"known-phrases-{length}",
        )
        kept = known
        if length < most_words:
            # the words between two phrases with the same count have that count too, so the next length tells
            longer = levels[length].select(F.explode(F.array("prefix", "suffix")).alias("gid"), "f")
            longer = longer.groupBy("gid").agg(F.max("f").alias("longest"))
            kept = known.join(longer, "gid", "left").where("longest is null or longest < f")
        cuts = F.array(*(cut(length, after) for after in range(1, length)))
        candidates.append(kept.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", F.array_min(cuts).alias("cut")))
    found = candidates[0]
    for more in candidates[1:]:
        found = found.unionByName(more)
    found = found.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranks = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranks.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def cut(length: int, after: int) -> Column:
    """The sides of a phrase cut after some words, and its score; exact in 38 digits."""
    left, right = F.get("begins", F.lit(length - after)), F.get("ends", F.lit(after))
    whole = lambda c: c.cast("decimal(15,0)")
    together = F.lit(1000).cast("decimal(4,0)") * whole(F.col("f")) * whole(F.col("n"))
    score = F.call_function("div", together, whole(left) * whole(right))
    return F.struct(score.cast("long").alias("score"), F.lit(after).alias("after"), left.alias("l"), right.alias("r"))
