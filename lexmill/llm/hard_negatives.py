"""Hard negatives by Fagin's threshold algorithm.

For an anchor, its positives are the rows of its label that score highest, a
score being the inner product of two integer vectors. A negative of a positive is
a row of another label whose score lies in a window below the positive's score:
hard, but not so close that it may be a positive itself.

All rows are dealt into blocks by a hash of their id, the anchors into blocks of
their own, and every block of rows meets every block of anchors once. In a block
there is a sorted list of the rows for each dimension. An anchor reads them from
the end that its sign makes the best one, some rows at a time (sorted access); a
row met for the first time gets its whole score (random access). No row unseen can
score above the threshold, the sum over the dimensions of the anchor's component
times the last value read. The search of a block ends once the threshold is
strictly below the k-th score of every window, so that no tie is lost.

The best of all blocks are merged. There are two such searches: positives first,
over lists of the anchor's label only, then negatives of all windows at once.

Rows without id, label or vector, or with a component that is null or not finite,
take no part. Rows that share an id are one row, the one with the smallest label,
then vector. A component is cut to 64 bits; a positive whose score has more bits
is an error. A shorter vector counts as filled up with zeros. An empty table gives
no rows, an anchor without a positive or a positive without a negative in its
window none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import partitions, staged

BLOCK_ROWS = 8192
BLOCK_ANCHORS = 1024

# Tasks at most; with more pairs of blocks, a task takes several, one after another.
MOST_TASKS = 20_000

# Rows read from each list at first; then twice as many every time.
FIRST_STEP = 16

# Whole numbers up to this are exact as floating-point numbers.
EXACT = 1 << 53


# --- the search in one block ---------------------------------------------------------------


class Lists:
    """Rows of a block with a sorted list for each dimension; ``ids`` ascend."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)
        self.reals = vectors.astype(np.float64)
        self.top = max((abs(int(v)) for v in (vectors.min(initial=0), vectors.max(initial=0))))

    def exact(self, anchor: np.ndarray) -> bool:
        """Whether floating-point products of this anchor and any row are exact."""
        most = max(abs(int(anchor.min(initial=0))), abs(int(anchor.max(initial=0))))
        return most * self.top * max(len(anchor), 1) < EXACT

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.reals[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows].astype(object) @ anchor.astype(object)

    def search(self, anchor: np.ndarray, offer: Callable[[np.ndarray, np.ndarray], None], done: Callable[[int], bool]) -> int:
        """Give ``offer`` every row once with its score, until ``done`` accepts a threshold; the number of rows seen."""
        n, exact = len(self.ids), self.exact(anchor)
        down, up = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(down) + len(up):  # every score is 0 and no list tells rows apart
            offer(np.arange(n), np.zeros(n, dtype=np.int64))
            return n
        seen = np.zeros(n, dtype=bool)
        at, step = 0, FIRST_STEP
        while at < n:
            end = min(n, at + step)
            fresh = np.zeros(n, dtype=bool)
            fresh[self.order[n - end : n - at, down].ravel()] = True
            fresh[self.order[at:end, up].ravel()] = True
            fresh &= ~seen
            seen |= fresh
            rows = np.flatnonzero(fresh)
            offer(rows, self.scores(rows, anchor, exact))
            last = [(down, self.sorted[n - end, down]), (up, self.sorted[end - 1, up])]
            if exact:
                threshold = sum(int(anchor[d] @ v) for d, v in last)
            else:
                threshold = sum(int(a) * int(v) for d, values in last for a, v in zip(anchor[d], values))
            if done(threshold):
                break
            at, step = end, 2 * step
        return int(seen.sum())


class Best:
    """The first ``k`` of the offered rows with scores from ``low`` to ``high``: higher scores, then smaller ids."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.ids = self.scores = np.zeros(0, dtype=np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.low is not None:
            inside = ((scores >= self.low) & (scores <= self.high)).astype(bool)
            ids, scores = ids[inside], scores[inside]
        scores = scores.astype(np.int64)
        if len(self.ids) == self.k and len(scores):
            better = scores >= self.scores[-1]
            ids, scores = ids[better], scores[better]
        if len(ids):
            ids, scores = np.append(self.ids, ids), np.append(self.scores, scores)
            first = np.lexsort((ids, -scores))[: self.k]
            self.ids, self.scores = ids[first], scores[first]

    def done(self, threshold: int) -> bool:
        if self.low is not None and (threshold < self.low or self.low > self.high):
            return True
        return len(self.ids) == self.k and threshold < int(self.scores[-1])


def windows_of(positive_score: int, low: int, high: int) -> tuple[int, int]:
    """The scores s with low * positive_score <= 100 * s <= high * positive_score, from the first to the last."""
    return -(-low * positive_score // 100), high * positive_score // 100


# --- blocks ---------------------------------------------------------------------------------

SCHEMA = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.slice(column.offsets[0].as_py(), int(lengths.sum())).to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.reshape(len(lengths), width).astype(np.int64)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[start]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def block_results(table: pa.Table, k: int, low: int, high: int, negatives: bool) -> list[tuple]:
    """What the anchors of one pair of blocks find among its rows."""
    column = lambda name, rows: rows[name].combine_chunks()
    roles = table["role"].to_numpy()
    anchors, rows = table.slice(0, int((roles == 0).sum())), table.slice(int((roles == 0).sum()))
    if not len(anchors) or not len(rows):
        return []
    width = max(int(np.diff(column("v", t).offsets.to_numpy()).max(initial=0)) for t in (anchors, rows))
    ids = rows["vec_id"].to_numpy()
    _, once = np.unique(ids, return_index=True)  # sorted by label and vector, so the first of each id
    ids, labels = ids[once], rows["label"].to_numpy()[once]
    vectors = matrix(column("v", rows), width)[once]
    lists: dict[int | None, Lists] = {}

    def lists_of(label: int | None) -> Lists:
        if label not in lists:
            chosen = np.arange(len(ids)) if label is None else np.flatnonzero(labels == label)
            lists[label] = Lists(ids[chosen], labels[chosen], vectors[chosen])
        return lists[label]

    found = []
    wanted = anchors["positives"].to_pylist() if negatives else [None] * len(anchors)
    for anchor_id, label, vector, positives in zip(
        anchors["vec_id"].to_pylist(), anchors["label"].to_pylist(), matrix(column("v", anchors), width), wanted
    ):
        if not negatives:
            block, best = lists_of(label), Best(k)

            def offer(at, scores, block=block, best=best, anchor_id=anchor_id):
                other = block.ids[at] != anchor_id
                best.offer(block.ids[at[other]], scores[other])

            block.search(vector, offer, best.done)
            found += [(anchor_id, i, s, None, None) for i, s in zip(best.ids.tolist(), best.scores.tolist())]
            continue
        block = lists_of(None)
        windows = {p["positive_score"]: Best(k, *windows_of(p["positive_score"], low, high)) for p in positives}

        def offer(at, scores, block=block, windows=windows, label=label):
            other = block.labels[at] != label
            at, scores = block.ids[at[other]], scores[other]
            for best in windows.values():
                best.offer(at, scores)

        def done(threshold, windows=windows):
            return all(best.done(threshold) for best in windows.values())

        block.search(vector, offer, done)
        for p in positives:
            best = windows[p["positive_score"]]
            pair = (anchor_id, p["positive_id"], p["positive_score"])
            found += [(*pair, i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist())]
    return found


def searched(rows: DataFrame, anchors: DataFrame, counts: tuple[int, int], k: int, low: int, high: int) -> DataFrame:
    """Every block of ``rows`` against every block of ``anchors``; with ``positives`` in anchors, their negatives."""
    negatives = "positives" in anchors.columns
    row_blocks = max(1, -(-counts[0] // BLOCK_ROWS), min(partitions(rows.sparkSession), counts[0]))
    anchor_blocks = max(1, -(-counts[1] // BLOCK_ANCHORS))
    tasks = min(MOST_TASKS, row_blocks * anchor_blocks)

    def dealt(df: DataFrame, role: int, own: Column, others: int, group: Callable[[Column, Column], Column]) -> DataFrame:
        pairs = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(others - 1))))
        blank = F.lit(None).cast("array<struct<positive_id:long,positive_score:long>>")
        more = F.col("positives") if "positives" in df.columns else blank
        return pairs.select(
            group(F.col("own"), F.col("other")).alias("pair"), F.lit(role).alias("role"), "vec_id", "label", "v", more.alias("positives")
        )

    place = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    pair = lambda block, of: (block.cast("long") * anchor_blocks + of)
    both = dealt(anchors, 0, place(anchor_blocks, 1), row_blocks, lambda own, other: pair(other, own)).unionByName(
        dealt(rows, 1, place(row_blocks, 0), anchor_blocks, pair)
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "pair"):
            columns = list(zip(*block_results(table, k, low, high, negatives)))
            if columns:
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

    return (
        both.repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int"))
        .sortWithinPartitions("pair", "role", "vec_id", "label", "v")
        .mapInArrow(found, SCHEMA)
    )


# --- the operator ---------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """The rows of ``vectors(vec_id, label, embedding)`` that take part, with whole components floor(256 * x) as ``v``."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").where(~bad)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors(vec_id, label, v)`` has whole components. For each row for which
    ``is_anchor`` holds and each of its first ``positives`` other rows of its label:
    the first ``negatives`` rows of other labels whose scores are from ``low`` to
    ``high`` per cent of the positive's score.
    """
    rows = staged(vectors, "vectors")
    anchors = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row")).select("vec_id", "row.*")
    anchors = staged(anchors, "anchors")
    counts = rows.count(), anchors.count()
    if not counts[1]:
        anchors = anchors.limit(0)
    first = searched(rows, anchors, counts, positives, low, high)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    chosen = staged(
        first.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
        .select("anchor_id", "positive_id", "positive_score"),
        "positives",
    )
    lists = chosen.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    second = searched(rows, anchors.join(lists, "vec_id"), counts, negatives, low, high)
    hardest = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (
        second.withColumn("rank", F.row_number().over(hardest))
        .where(F.col("rank") <= negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
