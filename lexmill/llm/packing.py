"""Packing documents into sequences of token ids by cutting-stock column generation.

1. Every text is encoded once, with an end id, and staged. Whole sequences are cut
   off its front; what is left, shorter than a sequence, has to be packed.
2. The lengths of the rests, in steps of ``STEP`` ids, form a histogram over all
   documents. A linear program covers it with patterns, multisets of lengths that
   fit one sequence, using as few sequences as possible. Its columns are
   generated: a knapsack by dynamic programming prices the next pattern from the
   dual values, until no pattern improves the program by more than ``GAP``.
3. Each pattern is used as often as its rounded-down value says. The slots of a
   length go to the documents of that length in order of their ranks.
4. As lengths were rounded down, the last piece of a sequence may stick out a few
   ids. These ends, the documents that rounding left over, and rests shorter than
   a step are laid end to end and cut into full sequences; the last of these is
   cut into lengths that are powers of two, which take no padding.

The driver sees the histogram and the patterns only: at most ``length / STEP`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm import tokens
from lexmill.llm.common import ranked, staged

STEP = 32
GAP = 1e-3
MOST_ROUNDS = 4000


# --- patterns ---------------------------------------------------------------------------


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes with the largest total value that fits, by dynamic programming."""
    worth, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fitting = np.searchsorted(sizes, room, side="right")
        worth[room] = worth[room - 1]
        if fitting:
            options = worth[room - sizes[:fitting]] + values[:fitting]
            best = int(options.argmax())
            if options[best] > worth[room] + 1e-12:
                worth[room], pick[room] = options[best], best
    counts, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[pick[room]] += 1
            room -= sizes[pick[room]]
    return worth[capacity], counts


def cut_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often to use each, covering the demand with few sequences.

    Revised simplex on the patterns met so far. Any basis it stops with is feasible,
    so a bound on the rounds only costs sequences.
    """
    m = len(sizes)
    if not m:
        return np.zeros((0, 0)), np.zeros(0)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    for turn in range(MOST_ROUNDS):
        if turn % 100 == 0:
            inverse = np.linalg.inv(basis)
        duals = inverse.sum(axis=0)
        worth, column = best_pattern(sizes, duals, capacity)
        if worth <= 1 + GAP:
            break
        use, change = inverse @ demand, inverse @ column
        ratios = np.where(change > 1e-9, np.maximum(use, 0) / np.where(change > 1e-9, change, 1), np.inf)
        leave = int(ratios.argmin())
        basis[:, leave] = column
        row = inverse[leave] / change[leave]
        inverse -= np.outer(change, row)
        inverse[leave] = row
    return basis, np.maximum(np.linalg.solve(basis, demand), 0)


def slots(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, ...]], int]:
    """(size, first rank, last rank, count in the pattern, first sequence, place) of every run
    of slots, and the number of sequences, from the number of documents of each size."""
    sizes = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[s] for s in sizes], dtype=float)
    patterns, use = cut_stock(sizes, demand, capacity)
    times = np.floor(use + 1e-6).astype(np.int64)
    given, left, found, sequence = dict.fromkeys(histogram, 0), dict(histogram), [], 0
    for j, repeat in enumerate(times):
        counts = {int(s): int(c) for s, c in zip(sizes, patterns[:, j]) if c > 0}
        repeat = min([int(repeat), *(left[s] // c for s, c in counts.items())])
        if repeat <= 0:
            continue
        place = 0
        for size in sorted(counts, reverse=True):
            count = counts[size]
            found.append((size, given[size], given[size] + repeat * count - 1, count, sequence, place))
            given[size] += repeat * count
            left[size] -= repeat * count
            place += count
        sequence += repeat
    return found, sequence


# --- documents --------------------------------------------------------------------------


def encoded(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """(key, doc_id, n, ids): every row's ids with the end id, staged; ``key`` tells repeated rows apart."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(vocabulary, "dropped")
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [encoder.ids(text) + end for text in tokens.texts_of(some.column(1))]
                counts = pa.array([len(i) // width for i in ids], pa.int64())
                yield pa.record_batch(
                    [some.column(0), counts, pa.array([width] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "n", "width", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = rows.mapInArrow(encode, "doc_id long, n long, width int, ids binary")
    return staged(made.withColumn("key", F.monotonically_increasing_id()), "encoded-documents")


def pack(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece.

    Pieces of a document cover its ids without gap or overlap; pieces of a sequence
    follow each other from offset 0. A null or empty text is the end id alone. Rows
    that share a doc_id, or lack one, are documents of their own. Other columns are
    not read. An empty table gives no rows. ``length`` is a multiple of ``STEP``.
    """
    texts = encoded(docs, vocabulary, end_id)
    sizes = texts.select(
        "key",
        "doc_id",
        "n",
        (F.col("n") % length % length).alias("rest"),
        F.expr(f"n div {length}").alias("whole"),
        F.expr(f"n % {length} div {STEP}").cast("int").alias("size"),
    )
    rows = staged(ranked(sizes, ["size"], ["doc_id", "key"], "document-lengths", totals=("whole",)), "ranked-documents")
    per_size = {r["size"]: (r["n"], r["w"]) for r in rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.sum("whole").alias("w")).collect()}
    runs, n_patterns = slots({s: n for s, (n, _) in per_size.items() if s}, length // STEP)

    # whole sequences: after those of the patterns, by size and rank
    first, n_whole = {}, n_patterns
    for size, (_, whole) in sorted(per_size.items()):
        first[size] = n_whole
        n_whole += whole
    base = F.create_map(*(F.lit(x) for pair in first.items() for x in pair)) if first else F.lit(None).cast("map<int,long>")

    # rests in the slots of patterns; a step of a broadcast table of at most length / STEP patterns
    spark = docs.sparkSession
    schema = "size int, first_rank long, last_rank long, count long, first_sequence long, place long"
    table = F.broadcast(spark.createDataFrame(runs, schema).withColumnRenamed("size", "slot_size"))
    given = (F.col("size") == F.col("slot_size")) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))
    nth = F.col("rank") - F.col("first_rank")
    placed = rows.where("rest > 0").join(table, given, "left").select(
        "key",
        F.expr(f"n - rest").alias("start"),
        "rest",
        F.when(F.col("first_rank").isNotNull(), F.expr("first_sequence + (rank - first_rank) div count")).alias("sequence"),
        (F.col("place") + nth % F.col("count")).alias("place"),
    )
    placed = staged(placed, "placed-rests")
    inside = Window.partitionBy("sequence").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    in_slots = placed.where("sequence is not null").withColumn("offset", F.coalesce(F.sum("rest").over(inside), F.lit(0)))
    in_slots = in_slots.withColumn("kept", F.greatest(F.lit(0), F.least("rest", F.lit(length) - F.col("offset"))))
    in_slots = staged(in_slots, "filled-sequences")
    kept = in_slots.where("kept > 0").select(
        "key", "start", F.col("kept").alias("length"), "sequence", "offset"
    )

    # what sticks out or was left over, end to end
    ends = in_slots.where("kept < rest").select(
        "key", (F.col("start") + F.col("kept")).alias("start"), (F.col("rest") - F.col("kept")).alias("size")
    )
    over = placed.where("sequence is null").select("key", "start", F.col("rest").alias("size")).unionByName(ends)
    line = staged(ranked(over, [], ["key", "start"], "left-over", totals=("size",)), "ranked-left-over")
    total = line.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    full, tail = divmod(total, length)
    cuts, at = [], full * length
    for bit in reversed(range(length.bit_length())):
        if tail >> bit & 1:
            cuts.append((at, at + (1 << bit), full + len(cuts)))
            at += 1 << bit
    span = "struct<lo:long,hi:long,id:long>"
    begin, end = F.col("before_size"), F.col("before_size") + F.col("size")
    low, high = F.expr(f"before_size div {length}"), F.least(F.expr(f"(before_size + size - 1) div {length}"), F.lit(full - 1))
    mains = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<long>"))
    mains = F.transform(mains, lambda i: F.struct((i * length).alias("lo"), ((i + 1) * length).alias("hi"), i.alias("id")))
    tails = F.array(*(F.struct(*(F.lit(x).cast("long").alias(n) for x, n in zip(c, ("lo", "hi", "id")))) for c in cuts)).cast(f"array<{span}>")
    tails = F.filter(tails, lambda c: (c["lo"] < end) & (c["hi"] > begin))
    cut = line.withColumn("span", F.explode(F.concat(mains.cast(f"array<{span}>"), tails)))
    lo, hi = F.greatest("span.lo", begin), F.least("span.hi", end)
    laid = cut.select(
        "key",
        (F.col("start") + lo - begin).alias("start"),
        (hi - lo).alias("length"),
        (F.lit(n_whole) + F.col("span.id")).alias("sequence"),
        (lo - F.col("span.lo")).alias("offset"),
    )

    pieces = kept.unionByName(laid).groupBy("key").agg(F.collect_list(F.struct("start", "length", "sequence", "offset")).alias("pieces"))
    wholes = rows.where("whole > 0").select("key", (base[F.col("size")] + F.col("before_whole")).alias("first_whole"))
    cut_up = pieces.join(wholes, "key", "full").withColumnRenamed("key", "piece_key")
    cut_up = staged(cut_up, "pieces")
    return _with_checksums(texts.join(cut_up, texts["key"] == cut_up["piece_key"]), length)


def _with_checksums(rows: DataFrame, length: int) -> DataFrame:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            found: list[list] = [[] for _ in names]
            for doc_id, n, width, data, pieces, first in zip(*(batch.column(i) for i in range(6))):
                n, first = n.as_py(), first.as_py()
                ids = np.frombuffer(data.as_py(), f"<u{width.as_py()}")
                wholes = [] if first is None else [(i * length, length, first + i, 0) for i in range(n // length)]
                rests = [(p["start"], p["length"], p["sequence"], p["offset"]) for p in pieces.as_py() or ()]
                for start, size, sequence, offset in wholes + sorted(rests):
                    crc = zlib.crc32(tokens.little_endian_32(ids[start : start + size]))
                    for column, value in zip(found, (doc_id.as_py(), start, size, crc, n, sequence, offset)):
                        column.append(value)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in found], names=names)

    return rows.select("doc_id", "n", "width", "ids", "pieces", "first_whole").mapInArrow(
        check, ", ".join(f"{n} long" for n in names)
    )
