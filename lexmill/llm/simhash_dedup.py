"""Near-duplicate groups by SimHash and the generalised pigeonhole principle.

A text's fingerprint has a bit for each of 64 positions: 1 if more than half of
the hashes of its word shingles have it. Two fingerprints link if they differ in
at most ``radius`` bits; linked documents form groups.

Links are found without comparing all pairs:

1. Equal fingerprints are one row from here on.
2. Bits that vary together over all fingerprints are put in the same of m parts,
   so that the parts are as independent as they can be.
3. For each fingerprint, every part gets a threshold t >= -1 with sum(t + 1) =
   radius + 1. If two fingerprints differ in at most ``radius`` bits, they differ
   in at most t bits in some part. Dynamic programming picks the thresholds with
   the fewest expected candidates, from counts of all fingerprints in blocks of
   at most ``BLOCK_BITS`` bits: common values get low thresholds, rare ones high.
4. Each fingerprint is stored under its m part values and probes the values
   within its thresholds. What meets under a value is verified bit by bit, and a
   task only passes on a tree of the links it has verified, never all pairs.
5. A value with more than ``BUCKET`` rows is cut into chunks, and each pair of
   chunks is compared apart, so that no task holds a whole large value.
6. Connected components over the trees give the groups.

m grows with the number of fingerprints (see ``parts_for``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import staged, with_group
from lexmill.llm.components import components
from lexmill.session import local_copy, small_rows

BITS = 64
BLOCK_BITS = 11
BUCKET = 4096

# Making, shuffling and sorting a row costs about as much as this many comparisons.
ROW_COST = 400.0


# --- fingerprints -----------------------------------------------------------------------


def fingerprint(text: str | None, words_in_shingle: int) -> int:
    """The fingerprint of a text: A-Z lower-cased, words between ASCII blanks, shingles with repeats."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_in_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(words_in_shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_of(text: Column, words_in_shingle: int = 3) -> Column:
    """The fingerprint of a text column as a long; null counts as empty, whose fingerprint is 0."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words_in_shingle) for t in texts], dtype="int64")

    return hashed(F.coalesce(text.cast("string"), F.lit("")))


# --- parts and thresholds ---------------------------------------------------------------


def bits_of(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each 64-bit value, lowest bit first."""
    return np.unpackbits(values.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def joint_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how often each two bits are both set (64 x 64), over all of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy()).astype(np.float32)
            total += bits.T @ bits
            n += batch.num_rows
        cells = np.append(total.ravel(), n).astype(np.int64)
        yield pa.record_batch([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], names=["cell", "n"])

    rows = prints.select("fingerprint").mapInArrow(counted, "cell int, n long")
    cells = np.zeros(BITS * BITS + 1)
    for cell, n in rows.groupBy("cell").agg(F.sum("n")).collect():
        cells[cell] = n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def parts_for(n: int, radius: int) -> int:
    """The number of parts with the least cost a fingerprint: rows shuffled and candidates compared."""

    def cost(m: int) -> float:
        bits = BITS // m
        if radius + 1 <= m:
            thresholds = [0] * (radius + 1)
        else:
            thresholds = [(radius + 1 + i) // m - 1 for i in range(m)]
        within = [sum(comb(bits, k) for k in range(t + 1)) for t in thresholds]
        return ROW_COST * (m + sum(within)) + sum(within) * n / 2.0**bits

    return min(range(1, radius + 2), key=cost)


def grouped_bits(n: int, joint: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into parts of equal width, each time the one most correlated with the part so far."""
    share = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs((joint / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, dealt = set(range(BITS)), []
    for p in range(parts):
        width = BITS // parts + (p < BITS % parts)
        part = [max(left, key=lambda b: (related[b, sorted(left)].max(), -b))]
        left.remove(part[0])
        while len(part) < width:
            best = max(left, key=lambda b: (related[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        dealt.append(sorted(part))
    return dealt


def blocks_of(part: list[int]) -> list[list[int]]:
    count = -(-len(part) // BLOCK_BITS)
    return [part[i::count] for i in range(count)]


def values_at(bits: np.ndarray, places: list[int]) -> np.ndarray:
    return bits[:, places].astype(np.int64) @ (1 << np.arange(len(places), dtype=np.int64))


def block_distances(prints: DataFrame, parts: list[list[int]], radius: int, n: int) -> list[list[np.ndarray]]:
    """For each part and block: a table [value, d] of the share of all fingerprints at distance d in the block.

    The counts come from every fingerprint; at most 2^BLOCK_BITS values a block reach the driver.
    """
    blocks = [(p, block) for p, part in enumerate(parts) for block in blocks_of(part)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << len(block), dtype=np.int64) for _, block in blocks]
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy())
            for total, (_, block) in zip(totals, blocks):
                total += np.bincount(values_at(bits, block), minlength=len(total))
        for b, total in enumerate(totals):
            met = np.flatnonzero(total)
            columns = [np.full(len(met), b, dtype=np.int32), met.astype(np.int32), total[met]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["b", "value", "n"])

    found = prints.select("fingerprint").mapInArrow(counted, "b int, value int, n long")
    totals = [np.zeros(1 << len(block)) for _, block in blocks]
    for b, value, count in found.groupBy("b", "value").agg(F.sum("n")).collect():
        totals[b][value] = count
    tables: list[list[np.ndarray]] = [[] for _ in parts]
    for total, (p, block) in zip(totals, blocks):
        table = np.zeros((len(total), radius + 1))
        values = np.arange(len(total))
        for d in range(min(radius, len(block)) + 1):
            for flips in combinations(range(len(block)), d):
                table[:, d] += total[values ^ sum(1 << f for f in flips)]
        tables[p].append(table / max(n, 1))
    return tables


def thresholds(bits: np.ndarray, parts: list[list[int]], tables: list[list[np.ndarray]], radius: int, n: int):
    """The threshold of every part for every fingerprint: array [fingerprint, part], values from -1 on."""
    rows, budget = len(bits), radius + 1
    costs = np.zeros((len(parts), rows, budget + 1))
    for p, part in enumerate(parts):
        near = np.zeros((rows, budget))
        near[:, 0] = 1
        for block, table in zip(blocks_of(part), tables[p]):
            met = table[values_at(bits, block)]
            near = np.stack([sum(near[:, i] * met[:, d - i] for i in range(d + 1)) for d in range(budget)], axis=1)
        probes = np.array([comb(len(part), d) for d in range(budget)])
        costs[p, :, 1:] = np.cumsum(near * n + ROW_COST * probes, axis=1)
    best = np.full((rows, budget + 1), np.inf)
    best[:, 0] = 0
    picks = []
    for p in range(len(parts)):
        options = np.full((rows, budget + 1, budget + 1), np.inf)
        for spent in range(budget + 1):
            for here in range(spent + 1):
                options[:, spent, here] = best[:, spent - here] + costs[p, :, here]
        picks.append(options.argmin(axis=2))
        best = options.min(axis=2)
    chosen = np.zeros((rows, len(parts)), dtype=np.int64)
    left = np.full(rows, budget)
    for p in range(len(parts) - 1, -1, -1):
        chosen[:, p] = picks[p][np.arange(rows), left]
        left -= chosen[:, p]
    return chosen - 1


# --- candidates and links ---------------------------------------------------------------

STORED, PROBE = 1, 2


def signatures(prints: DataFrame, parts: list[list[int]], tables, radius: int, n: int) -> DataFrame:
    """(part, value, fingerprint, role): every fingerprint under its own values and those it probes."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                own = batch.column(0).slice(at, 4096).to_numpy()
                bits = bits_of(own)
                limits = thresholds(bits, parts, tables, radius, n)
                for p, part in enumerate(parts):
                    value = values_at(bits, part)
                    for d in range(limits[:, p].max(initial=0) + 1):
                        rows = np.flatnonzero(limits[:, p] >= d) if d else np.arange(len(own))
                        role = np.where(limits[rows, p] >= d, PROBE, 0) + (STORED if d == 0 else 0)
                        for flips in combinations(range(len(part)), d):
                            columns = [
                                np.full(len(rows), p, dtype=np.int32),
                                value[rows] ^ sum(1 << f for f in flips),
                                own[rows],
                                role.astype(np.int32),
                            ]
                            names = ["part", "value", "fingerprint", "role"]
                            yield pa.record_batch([pa.array(c) for c in columns], names=names)

    schema = "part int, value long, fingerprint long, role int"
    return prints.select("fingerprint").mapInArrow(dealt, schema)


def in_buckets(rows: DataFrame) -> DataFrame:
    """Rows with ``pair``, the place where they are compared: one for most values, and one for every
    pair of chunks that a row of a large value is in. A value's rows are dealt to chunks by fingerprint."""
    large = (
        rows.groupBy("part", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > BUCKET)
        .select("part", "value", F.ceil(F.col("rows") * 2 / BUCKET).cast("int").alias("chunks"))
    )
    few = small_rows(large)
    if few is not None:
        large = F.broadcast(local_copy(large, few))
    chunk = F.pmod(F.xxhash64("fingerprint"), F.col("chunks")).cast("int")
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    pairs = F.transform(others, lambda c: F.least(c, chunk) * F.col("chunks") + F.greatest(c, chunk))
    return (
        rows.join(large, ["part", "value"], "left")
        .withColumn("pair", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(-1))).otherwise(pairs)))
        .drop("chunks")
    )


def verified_links(rows: DataFrame, radius: int) -> DataFrame:
    """(a, b): for each bucket, a forest that joins all fingerprints linked within it."""
    keys = ["part", "value", "pair"]
    schema = "a long, b long"

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(columns: list[np.ndarray]) -> pa.RecordBatch:
            new = np.ones(len(columns[0]), dtype=bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            a, b = forest(np.cumsum(new), columns[3], columns[4], radius)
            return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if held:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            if not len(columns[0]):
                continue
            last = np.flatnonzero(np.any([c != c[-1] for c in columns[:3]], axis=0))
            cut = last[-1] + 1 if len(last) else 0  # the last bucket may go on in the next batch
            if cut:
                yield emit([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held and len(held[0]):
            yield emit(held)

    return (
        rows.repartition(*keys)
        .sortWithinPartitions(*keys)
        .select(*keys, "fingerprint", "role")
        .mapInArrow(compared, schema)
    )


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).astype(np.uint64))


def forest(run: np.ndarray, prints: np.ndarray, role: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within each run of equal ``run``; at most one a row.

    Runs of up to 64 rows are compared all at once, row i with row i + k for k = 1, 2, ...
    Longer ones are searched breadth first, where a row that has been reached is compared once.
    """
    n = len(run)
    starts = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    lengths = np.diff(np.append(starts, n))
    size = np.repeat(lengths, lengths)
    left, right = [], []
    rows = np.flatnonzero(size <= 64)
    for k in range(1, 64):
        rows = rows[rows + k < n]
        rows = rows[run[rows] == run[rows + k]]
        if not len(rows):
            break
        other = rows + k
        close = differing(prints[rows], prints[other]) <= radius
        met = ((role[rows] & PROBE) & (role[other] << 1)) | ((role[other] & PROBE) & (role[rows] << 1))
        keep = close & (met > 0)
        left.append(rows[keep])
        right.append(other[keep])
    a = np.concatenate(left) if left else np.zeros(0, dtype=np.int64)
    b = np.concatenate(right) if right else np.zeros(0, dtype=np.int64)
    root = np.arange(n)
    while True:  # the smallest row number spreads along the links
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    out_a, out_b = [prints[root != np.arange(n)]], [prints[root[root != np.arange(n)]]]
    for start, length in zip(starts[lengths > 64], lengths[lengths > 64]):
        x, y = _search(prints[start : start + length], role[start : start + length], radius)
        out_a.append(x)
        out_b.append(y)
    return np.concatenate(out_a), np.concatenate(out_b)


def _search(prints: np.ndarray, role: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    left = np.arange(len(prints))
    out_a, out_b = [], []
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            now = queue.pop()
            met = ((role[now] & PROBE) & (role[left] << 1)) | ((role[left] & PROBE) & (role[now] << 1))
            near = (differing(prints[left], prints[now]) <= radius) & (met > 0)
            if near.any():
                found = left[near]
                out_a.append(prints[found])
                out_b.append(np.full(len(found), prints[first]))
                queue.extend(found)
                left = left[~near]
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (empty, empty)


# --- groups -----------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, radius: int = 3, words_in_shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint long, component_id, copies) for every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id of the group, ``copies`` the rows with
    the same fingerprint. A null text counts as empty; texts without words share
    fingerprint 0 and link like others. A null doc_id takes part but is never a
    component_id (null if the group has no other). Repeated rows come back as
    often. Other columns are ignored; an empty table gives no rows.
    """
    marked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), fingerprint_of(docs["text"], words_in_shingle).alias("fingerprint")
    )
    return grouped(staged(marked, "fingerprints"), radius)


def grouped(rows: DataFrame, radius: int) -> DataFrame:
    """The groups of a staged table (doc_id, fingerprint)."""
    counted = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    prints = staged(counted, "distinct-fingerprints")
    n, joint = joint_counts(prints)
    parts = grouped_bits(n, joint, parts_for(n, radius))
    tables = block_distances(prints, parts, radius, n)
    keyed = staged(signatures(prints, parts, tables, radius, n), "signatures")
    roots = components(verified_links(in_buckets(keyed), radius))
    known = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first_id", "copies", F.coalesce("root", "fingerprint").alias("root")
    )
    least = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = staged(known.join(least, "root").select("fingerprint", "component_id", "copies"), "named-fingerprints")
    total = named.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    return with_group(rows, named, "fingerprint", "copies", total).select(
        "doc_id", "fingerprint", "component_id", "copies"
    )


def keep_one(docs: DataFrame, radius: int = 3, words_in_shingle: int = 3) -> DataFrame:
    """``docs`` without near copies: of each group the row with the smallest doc_id stays, with all its columns.

    Of rows that share doc_id and fingerprint, the one with the smallest other
    columns stays. Rows without a doc_id go if their group has a row with one;
    else one of them stays for each fingerprint.
    """
    mark, key = "simhash fingerprint", "simhash row"
    marked = staged(docs.withColumn(mark, fingerprint_of(docs["text"], words_in_shingle)), "marked-documents")
    found = grouped(marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(mark).alias("fingerprint")), radius)

    def row_key(fingerprint: str) -> Column:
        """One key without nulls, so that the join and the grouping share one shuffle of the texts."""
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col(fingerprint)).alias(key)

    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(row_key("fingerprint")).distinct()
    kept = marked.select("*", row_key(mark)).join(dropped, key, "left_anti")
    return kept.groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
