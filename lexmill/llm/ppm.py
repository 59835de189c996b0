"""Language-model scores by prediction by partial matching (PPM, escape method C) over bytes.

The model is the trie of all byte contexts of up to ``ORDER`` bytes in the training
texts, with the number of times each byte followed each context. A text is coded
byte by byte, then its end. A byte met after the longest known context before it
costs c / (n + d): c its count there, n the context's total, d its distinct bytes.
Else the escape, d / (n + d), is paid and the context shortened by a byte; bytes the
longer context has seen cannot come any more, and leave n and d (symbol exclusion).
After no context at all every byte not excluded is as likely. The score is the
logarithm of the probability of the whole text.

Training counts every text. A task counts the grams (the ``ORDER`` bytes before a
byte, and the byte) of its texts and passes each distinct gram on once; Spark sums
them. The counts of shorter contexts are sums of those. What follows of a context
and its parent, n, d and what exclusion leaves of the parent, are sums and joins too.

Scoring looks at whole texts in numpy. Up to ``BROADCAST_ROWS`` grams, counted, the
model is broadcast. A larger one is cut by the two bytes before a byte: the distinct
grams of each shard of texts go to the piece of the model that knows them, packed, and
their logarithms come back to the shard. Pieces with many grams are copied for several tasks.

Texts begin after ``ORDER`` start marks. Bytes that occur in no UTF-8 text stand for
the marks of start and end; in a malformed text they count as byte 0xFD.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lexmill.llm import unigrams
from lexmill.llm.common import pack, partitions, staged, unpack

ORDER = 5
START, END, WRONG = 0xFF, 0xFE, 0xFD

# Bytes a text can hold, and its end.
SYMBOLS = 255

# Grams a task holds before it passes them on, 16 bytes each.
HELD_GRAMS = 2_000_000
CHUNK_BYTES = 1 << 18

# A model of up to so many rows, counted first, is broadcast (at most 30 bytes each).
BROADCAST_ROWS = 4_000_000
PIECE_ROWS = 1_000_000

# Odd, so that pairs of symbols that are near each other fall into different pieces.
DEALT = 40_503

LOG10 = np.log(10.0)


# --- grams ----------------------------------------------------------------------------------


def symbols(text: bytes) -> np.ndarray:
    """The bytes of a text after the start marks, with its end."""
    raw = np.frombuffer(text, dtype=np.uint8)
    out = np.full(len(raw) + ORDER + 1, START, dtype=np.uint8)
    out[ORDER:-1] = np.minimum(raw, WRONG)
    out[-1] = END
    return out


def grams(marked: np.ndarray) -> np.ndarray:
    """For each symbol the ``ORDER`` symbols before it and itself, as one number, the symbol lowest."""
    n = len(marked) - ORDER
    keys = np.zeros(n, dtype=np.int64)
    for k in range(ORDER + 1):
        keys = keys << 8 | marked[k : k + n]
    return keys


def chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The grams of a column of texts, about ``CHUNK_BYTES`` at a time: (grams, rows, grams of each row).

    A null text is empty; a long text comes in several parts.
    """
    rows, parts, size = [], [], 0

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        whole = np.ones(sum(map(len, parts)), dtype=bool)
        ends = np.cumsum([len(p) for p in parts])
        for k in range(1, ORDER + 1):
            whole[ends - k] = False  # a gram that starts in one part must end there
        keys = grams(np.concatenate(parts))
        return keys[whole[: len(keys)]], np.array(rows), np.array([len(p) - ORDER for p in parts])

    for row, value in enumerate(column):
        marked = symbols(value.as_py() or b"")
        for at in range(0, len(marked) - ORDER, CHUNK_BYTES):
            part = marked[at : at + CHUNK_BYTES + ORDER]
            rows.append(row)
            parts.append(part)
            size += len(part)
            if size >= CHUNK_BYTES:
                yield joined()
                rows, parts, size = [], [], 0
    if parts:
        yield joined()


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of distinct keys from several lists of (keys, counts)."""
    keys, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all of ``texts(text binary)``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for keys, _, _ in chunks(batch.column(0)):
                held.append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held) > HELD_GRAMS:
                    held = [merged(held)]
                    if len(held[0][0]) > HELD_GRAMS // 2:
                        yield pa.record_batch([pa.array(held[0][0]), pa.array(held[0][1])], names=["gram", "n"])
                        held = []
        if held:
            keys, counts = merged(held)
            yield pa.record_batch([pa.array(keys), pa.array(counts)], names=["gram", "n"])

    return texts.select("text").mapInArrow(counted, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


# --- the model ------------------------------------------------------------------------------

def low(gram: Column, symbols: int) -> Column:
    """The last symbols of a gram."""
    return gram.bitwiseAND(F.lit((1 << 8 * symbols) - 1))


COLUMNS = {"n": "long", "d": "short", "g": "long", "h": "short"}


def as_model(rows: DataFrame, place: int) -> DataFrame:
    """Rows as a part of a model; a column they do not have is null."""
    columns = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in COLUMNS.items()]
    return rows.select(F.lit(place).cast("byte").alias("place"), "gram", *columns)


def train(texts: DataFrame) -> DataFrame:
    """The model of ``texts(text binary)``, staged: (place, gram, n, d, g, h).

    Place 2k has the grams of k + 1 symbols with their counts n; place 2k + 1 the
    contexts of k symbols with total n, distinct symbols d and, for k > 0, what is
    left of the parent (the context without its first symbol) once the context's
    symbols are excluded: g its total and distinct symbols, h its distinct symbols.
    """
    full = staged(gram_counts(texts), "grams")
    levels = {ORDER: full}
    for k in range(ORDER - 1, -1, -1):
        shorter = levels[k + 1].groupBy(low(F.col("gram"), k + 1).alias("gram")).agg(F.sum("n").alias("n"))
        levels[k] = staged(shorter, "grams")
    tables = []
    sums = {
        k: level.groupBy(F.shiftright("gram", 8).alias("gram")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
        for k, level in levels.items()
    }
    for k, level in levels.items():
        tables.append(as_model(level, 2 * k))
        own = sums[k]
        if k:
            # what the symbols of a context count in its parent
            child = level.select(F.shiftright("gram", 8).alias("child"), low(F.col("gram"), k).alias("gram"))
            taken = child.join(levels[k - 1], "gram").groupBy(F.col("child").alias("gram")).agg(F.sum("n").alias("taken"))
            parent = sums[k - 1].select(F.col("gram").alias("parent"), F.col("n").alias("all"), F.col("d").alias("kinds"))
            own = own.join(taken, "gram").withColumn("parent", low(F.col("gram"), k - 1)).join(parent, "parent")
            left = F.col("kinds") - F.col("d")
            own = own.select("gram", "n", "d", (F.col("all") - F.col("taken") + left).alias("g"), left.alias("h"))
        tables.append(as_model(own, 2 * k + 1))
    return staged(reduce(DataFrame.unionByName, tables), "ppm-model")


class Model:
    """A model, or the piece of one that knows some grams, in memory: sorted keys and their values for each place."""

    def __init__(self, keys: list[np.ndarray], values: list[list[np.ndarray]]):
        self.keys, self.values = keys, values

    @classmethod
    def of(cls, table: pa.Table) -> "Model":
        place = table["place"].to_numpy()
        return cls(*zip(*(sorted_place(table.filter(pa.array(place == p)), p) for p in range(2 * ORDER + 2))))

    def find(self, place: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are there, and where."""
        known = self.keys[place]
        if not len(known):
            return np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, at

    def at(self, place: int, rows: np.ndarray) -> list[np.ndarray]:
        """The values of some rows of a place."""
        if not len(self.keys[place]):
            return [np.zeros(len(rows))] * len(self.values[place])
        return [column[rows].astype(np.float64) for column in self.values[place]]

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """The natural logarithm of each gram's probability."""
        out = np.zeros(len(keys))
        rows = np.arange(len(keys))
        child = np.zeros(len(keys), dtype=bool)  # whether the longer context is known
        child_at = np.zeros(len(keys), dtype=np.int64)
        for k in range(ORDER, -1, -1):
            gram = keys[rows] & (1 << 8 * (k + 1)) - 1
            known, at = self.find(2 * k + 1, gram >> 8)
            n, d = self.at(2 * k + 1, at)[:2]
            total, escape = n + d, d
            if k < ORDER:
                g, h = self.at(2 * k + 3, child_at)[2:]
                total, escape = np.where(child, g, total), np.where(child, h, escape)
            met, where = self.find(2 * k, gram)
            with np.errstate(divide="ignore", invalid="ignore"):
                if met.any():
                    out[rows[met]] += np.log(self.at(2 * k, where[met])[0] / total[met])
                paid = np.where(known & (total > 0), np.log(escape / total), 0.0)
            rest = ~met
            out[rows[rest]] += paid[rest]
            rows, child, child_at = rows[rest], known[rest], at[rest]
        kinds = int(self.values[1][1][0]) if len(self.keys[1]) else 0
        out[rows] -= np.log(max(SYMBOLS - kinds, 1))
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        """The base-10 logarithm of the probability of each text of a column."""
        return sums_of(column, self.logs)


def sums_of(column: pa.Array, logs: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The base-10 logarithm of the probability of each text of a column, from what ``logs`` gives for distinct grams."""
    out = np.zeros(len(column))
    for keys, rows, lengths in chunks(column):
        distinct, back = np.unique(keys, return_inverse=True)
        np.add.at(out, rows, np.add.reduceat(logs(distinct)[back], np.cumsum(lengths) - lengths))
    return out / LOG10


def sorted_place(rows: pa.Table, place: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted grams of one place, and their counts; of contexts all four values, an unset one 0."""
    gram = rows["gram"].to_numpy()
    order = np.argsort(gram)
    columns = list(COLUMNS)[: 4 if place % 2 else 1]
    return gram[order], [rows[c].fill_null(0).to_numpy()[order] for c in columns]


# --- scoring --------------------------------------------------------------------------------


def score(docs: DataFrame, model: DataFrame, most: int = BROADCAST_ROWS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``docs`` with ``score``, the base-10 logarithm of the probability of its column ``text`` (binary).

    A null text is empty: it costs its end. Repeated rows score alike; an empty model
    gives every byte the same probability. ``most`` is the largest model that is broadcast.
    """
    docs = docs.drop("score")
    at_once = scorer(model, most)
    return _scored_by_pieces(docs, model, model.count(), piece_rows) if at_once is None else _scored_at_once(docs, at_once)


def scorer(model: DataFrame, most: int = BROADCAST_ROWS) -> Callable[[pa.Array], np.ndarray] | None:
    """What scores a column of texts in a task, with the whole model; None for a model of more than ``most`` rows."""
    if model.count() > most:
        return None
    # place by place, so that the driver never holds the model twice
    places = [sorted_place(model.where(F.col("place") == place).toArrow(), place) for place in range(2 * ORDER + 2)]
    shared = model.sparkSession.sparkContext.broadcast(tuple(zip(*places)))
    return lambda texts: Model(*shared.value).scores(texts)


def _scored_at_once(docs: DataFrame, scores: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    names = [*docs.columns, "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns, pa.array(scores(batch["text"]))], names=names)

    return docs.mapInArrow(scored, StructType([*docs.schema, StructField("score", DoubleType())]))


def _scored_by_pieces(docs: DataFrame, model: DataFrame, rows: int, piece_rows: int) -> DataFrame:
    """The same with a model too large to broadcast."""
    whole = docs.select(F.struct("*").alias("row"), "text", F.lit(False).alias("training"))
    return unigrams.scored(whole, pieces=Pieces(model, rows, piece_rows)).select("row.*", "score")


def distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted, each once; ``np.unique`` hashes them, which takes some ten times as long."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def distinct_grams(texts: pa.Array) -> np.ndarray:
    """The grams of a column of texts, each once, sorted."""
    held: list[np.ndarray] = [np.zeros(0, dtype=np.int64)]
    for keys, _, _ in chunks(texts):
        held.append(distinct(keys))
        if sum(map(len, held)) > HELD_GRAMS:
            held = [distinct(np.concatenate(held))]
    return distinct(np.concatenate(held))


def piece_of(context, pieces: int):
    """The piece of a context, a number, array or column: by its last two symbols, dealt out."""
    if isinstance(context, Column):
        dealt = (low(context, 2) * DEALT).bitwiseAND(F.lit(0xFFFF))
        return F.shiftright(dealt * pieces, 16).cast("int")
    return ((context & 0xFFFF) * DEALT & 0xFFFF) * pieces >> 16


class Pieces:
    """A model too large to broadcast, cut into pieces.

    A gram, and all shorter forms of it that its cost asks for, belong to the piece of
    the last two symbols of its context. The places of fewer symbols have at most
    256 x 257 rows and are broadcast. The distinct grams of a shard of texts go to the
    pieces, one row for a shard and a piece, and their logarithms come back so.
    """

    def __init__(self, model: DataFrame, rows: int | None = None, piece_rows: int = PIECE_ROWS):
        self.model = model
        rows = model.count() if rows is None else rows
        self.tasks = partitions(model.sparkSession)
        self.pieces = min(max(-(-rows // piece_rows), self.tasks), 1 << 16)

    @property
    def keys_of(self) -> Callable[[pa.Array], bytes]:
        """The distinct grams of a column of texts, as the differences of the sorted grams."""
        return lambda texts: np.diff(distinct_grams(texts), prepend=0).astype("<i8").tobytes()

    @property
    def added(self) -> Callable[[pa.Array, bytes, list[bytes]], np.ndarray]:
        """The score of each text of a column, from its grams and what the pieces told of them, in their order."""
        pieces = self.pieces

        def scores(texts: pa.Array, keys: bytes, told: list[bytes]) -> np.ndarray:
            known = np.cumsum(np.frombuffer(keys, dtype="<i8"))
            logs = np.empty(len(known))
            logs[np.argsort(piece_of(known >> 8, pieces), kind="stable")] = np.concatenate([np.frombuffer(unpack(t), dtype="<f8") for t in told])
            return sums_of(texts, lambda grams: logs[np.searchsorted(known, grams)])

        return scores

    def told(self, asked: DataFrame) -> DataFrame:
        """(shard, piece, values): of ``asked(shard, keys)``, the logarithms of the grams of each piece."""
        model, pieces = self.model, self.pieces
        few = model.sparkSession.sparkContext.broadcast(model.where("place <= 3").select("place", "gram", *COLUMNS).toArrow())
        context = F.when(F.col("place") % 2 == 0, F.shiftright("gram", 8)).otherwise(F.col("gram"))
        own = model.where("place > 3").withColumn("piece", piece_of(context, pieces))
        # a piece that has a large share of all distinct grams is copied, and the shards that ask it are dealt to the copies
        sizes = own.where(F.col("place") == 2 * ORDER).groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
        total = sizes.agg(F.sum("n")).first()[0] or 1
        copies = F.greatest(F.ceil(F.col("n") * self.tasks / total), F.lit(1)).cast("int")
        copies = F.broadcast(staged(sizes.select("piece", copies.alias("copies")), "piece-copies"))  # a row a piece
        every = F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))
        known = own.join(copies, "piece", "left").select("piece", every.alias("copy"), "place", "gram", *COLUMNS)

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, packed in zip(batch["shard"].to_pylist(), batch["keys"]):
                    keys = np.cumsum(np.frombuffer(unpack(packed.as_py()), dtype="<i8"))
                    piece = piece_of(keys >> 8, pieces)
                    order = np.argsort(piece, kind="stable")
                    keys, piece = keys[order], piece[order]
                    first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1])) if len(piece) else []
                    parts = [pack(np.diff(some, prepend=0).tobytes()) for some in np.split(keys, first[1:])]
                    yield pa.record_batch(
                        [pa.array([shard] * len(first), pa.int64()), pa.array(piece[first], pa.int32()), pa.array(parts, pa.binary())],
                        names=["shard", "piece", "asked"],
                    )

        blank = lambda kind: F.lit(None).cast(kind)
        copy = F.pmod(F.xxhash64("shard"), F.coalesce("copies", F.lit(1))).cast("int")
        asked = asked.mapInArrow(cut, "shard long, piece int, asked binary").join(copies, "piece", "left").select(
            "piece", copy.alias("copy"), blank("byte").alias("place"), blank("long").alias("gram"), *(blank(t).alias(c) for c, t in COLUMNS.items()), "shard", "asked"
        )
        known = known.withColumns({"shard": blank("long"), "asked": blank("binary")})

        def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            here, piece = None, None
            for batch in batches:
                place = np.stack([batch["piece"].to_numpy(), batch["copy"].to_numpy(), pc.is_valid(batch["shard"]).to_numpy(False)])
                cuts = [0, *(np.flatnonzero((place[:, 1:] != place[:, :-1]).any(axis=0)) + 1), batch.num_rows]
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    if place[:2, a].tolist() != here:
                        here, held, piece = place[:2, a].tolist(), [], None
                    some = batch.slice(a, b - a)
                    if not place[2, a]:
                        held.append(some.select(["place", "gram", *COLUMNS]))
                        continue
                    if piece is None:
                        piece = Model.of(pa.concat_tables([*(pa.Table.from_batches([b]) for b in held), few.value]))
                    values = [pack(piece.logs(np.cumsum(np.frombuffer(unpack(keys.as_py()), dtype="<i8"))).tobytes()) for keys in some["asked"]]
                    yield pa.record_batch([some["shard"], some["piece"], pa.array(values, pa.binary())], names=["shard", "piece", "values"])

        placed = known.unionByName(asked).repartition(2 * max(pieces, self.tasks), "piece", "copy")
        return placed.sortWithinPartitions("piece", "copy", F.asc_nulls_first("shard")).mapInArrow(answer, "shard long, piece int, values binary")
