"""Smoothed word probabilities of whole texts, with counts of any number of distinct words.

Tokens are the words of a text, A-Z lower-cased, and one end. A task writes its
texts as shards of numbers, each with a dictionary of its distinct words and their
training counts. The words of a shard, in the order of a hash, are cut into parts:
one row for a shard and a part, not one a word, goes to the task that adds up the
part, and one row of counts comes back, so that no task holds the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from lexmill.llm.common import pack, partitions, staged, unpack

# A shard ends with the text that reaches so many tokens, or distinct words. One that keeps its texts
# is made without a model in the worker: it may hold some times as many, and so many bytes.
SHARD_TOKENS = 1_000_000
SHARD_WORDS = 250_000
WITH_TEXTS = 4
SHARD_BYTES = 16 << 20

# Words of all shards that are added up in one part.
PART_WORDS = 500_000

# The end of a text; no word is empty.
END = b""

# No word holds it.
BETWEEN = b"\n"


class Numbers(dict):
    """A number for each word, in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return (text or b"").lower().split()


def numbered(text: bytes | None, ids: Numbers) -> np.ndarray:
    """The numbers of a text's tokens."""
    return np.array([*map(ids.__getitem__, words_of(text)), ids[END]], dtype="<i4")


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def by_hash(ids: Numbers) -> tuple[list[bytes], np.ndarray]:
    """Words in the order of their hashes, and the place there of each number."""
    words = list(ids)
    order = np.argsort(hashes(words), kind="stable")
    place = np.empty(len(words), dtype="<i4")
    place[order] = np.arange(len(words))
    return [words[i] for i in order], place


def shard_number(made: int) -> int:
    """A number no other shard of this job has."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 32 | made


def scored(docs: DataFrame, scores: Callable[[pa.Array], np.ndarray] | None = None, pieces=None) -> DataFrame:
    """``docs`` without ``text``, with n_tokens, n_known, train_tokens and base_score.

    ``docs`` has ``text`` (binary) and ``training`` (boolean). With c the count of a
    token in the training texts, N all of them and V the distinct ones, base_score is
    the sum of log10((c + 0.5) / (N + 0.5 * (V + 1))); n_known counts tokens with
    c > 0. A null text is empty, a null ``training`` means no. An empty table gives
    no rows. Repeated rows are counted, and come back, as often.
    Other columns are kept, but for those named like the new ones. ``scores`` gives
    a number for each text of a column, which is added as ``score`` in the same pass.
    ``pieces`` does so by what other tasks know (``ppm.Pieces``): shards then keep their
    texts, and no numbers, which are made again.
    """
    made_here = ("n_tokens", "n_known", "base_score", "train_tokens", *(["score"] if scores or pieces else []))
    more = [f for f in docs.schema if f.name not in ("text", "training", *made_here)]
    read = [f.name for f in more]
    if scores:
        more.append(StructField("score", DoubleType()))
    names = [f.name for f in more]
    keys_of, added = (pieces.keys_of, pieces.added) if pieces else (None, None)
    row = StructType([*more, StructField("n tokens", IntegerType()), StructField("bytes", IntegerType())])
    fields = [
        StructField("shard", LongType()),
        StructField("rows", ArrayType(row)),
        StructField("body", BinaryType()),  # the numbers, or the texts
        StructField("words", BinaryType()),
        StructField("counts", BinaryType()),
        StructField("n_words", LongType()),
        StructField("keys", BinaryType()),
    ]

    most_tokens, most_words = (n * (WITH_TEXTS if pieces else 1) for n in (SHARD_TOKENS, SHARD_WORDS))

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, 0, 0
        ids, counts, rows, numbers, texts = Numbers(), [], [], [], []

        def shard() -> pa.RecordBatch:
            kind = pa.struct([*(pa.field(f.name, f.type) for f in batch_schema), ("n tokens", pa.int32()), ("bytes", pa.int32())])
            words, place = by_hash(ids)
            count = np.zeros(len(ids), dtype=np.int64)
            for some in counts:
                count += np.bincount(some, minlength=len(ids))
            own = np.empty_like(count)
            own[place] = count
            body = b"".join(texts) if keys_of else place[np.concatenate(numbers)].tobytes()
            keys = pack(keys_of(pa.array(texts, pa.binary()))) if keys_of else None
            return pa.record_batch(
                [
                    pa.array([shard_number(made)], pa.int64()),
                    pa.array([rows], pa.list_(kind)),
                    pa.array([pack(body)], pa.binary()),
                    pa.array([pack(BETWEEN.join(words))], pa.binary()),
                    pa.array([pack(own.astype("<i8").tobytes())], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                    pa.array([keys], pa.binary()),
                ],
                names=[f.name for f in fields],
            )

        for batch in batches:
            batch_schema = [batch.schema.field(n) for n in read]
            others = batch.select(read).to_pylist()
            if scores:
                batch_schema.append(pa.field("score", pa.float64()))
                others = [other | {"score": value} for other, value in zip(others, scores(batch["text"]).tolist())]
            for other, text, training in zip(others, batch["text"], batch["training"].to_pylist()):
                text = text.as_py() or b""
                own = numbered(text, ids)
                if training:
                    counts.append(own)
                rows.append(other | {"n tokens": len(own), "bytes": len(text)})
                if keys_of:
                    texts.append(text)
                    size += len(text)
                else:
                    numbers.append(own)
                held += len(own)
                if held >= most_tokens or len(ids) >= most_words or size >= SHARD_BYTES:
                    yield shard()
                    made, held, size = made + 1, 0, 0
                    ids, counts, rows, numbers, texts = Numbers(), [], [], [], []
        if rows:
            yield shard()

    ordered = docs.select(*read, F.coalesce("training", F.lit(False)).alias("training"), "text")
    shards = staged(ordered.mapInArrow(sharded, StructType(fields)), "word-shards")
    counted, tokens, kinds = _word_counts(shards)
    below = np.log10(tokens + 0.5 * (kinds + 1))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("rows").type.value_type
            for i in range(batch.num_rows):
                shard_rows = batch["rows"][i].as_py()
                lengths = [r["n tokens"] for r in shard_rows]
                body = unpack(batch["body"][i].as_py())
                count = np.concatenate([np.frombuffer(unpack(c["counts"]), dtype="<i8") for c in batch["answers"][i].as_py()])
                if added:
                    ends = np.cumsum([0, *(r["bytes"] for r in shard_rows)])
                    texts = [body[a:b] for a, b in zip(ends, ends[1:])]
                    ids = Numbers()
                    own = np.concatenate([numbered(text, ids) for text in texts])
                    own = by_hash(ids)[1][own]
                else:
                    own = np.frombuffer(body, dtype="<i4")
                starts = np.cumsum([0, *lengths])[:-1]
                logs = np.add.reduceat((np.log10(count + 0.5) - below)[own], starts)
                known = np.add.reduceat((count > 0).astype(np.int64)[own], starts)
                columns = [pa.array([r[n] for r in shard_rows], kind.field(n).type) for n in names]
                columns += [pa.array(lengths, pa.int64()), pa.array(known), pa.array(logs)]
                if added:
                    told = [t["values"] for t in batch["told"][i].as_py()]
                    columns.append(pa.array(added(pa.array(texts, pa.binary()), unpack(batch["keys"][i].as_py()), told)))
                yield pa.record_batch(columns, names=made)

    back = counted.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("part", "counts"))).alias("answers"))
    met = shards.select("shard", "rows", "body", *(["keys"] if pieces else [])).join(back, "shard")
    schema = [*more, StructField("n_tokens", LongType()), StructField("n_known", LongType()), StructField("base_score", DoubleType())]
    if pieces:
        told = pieces.told(shards.select("shard", "keys"))
        met = met.join(told.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("piece", "values"))).alias("told")), "shard")
        schema.append(StructField("score", DoubleType()))
    made = [f.name for f in schema]
    return met.drop("shard").mapInArrow(summed, StructType(schema)).withColumn("train_tokens", F.lit(tokens).cast("long"))


def _word_counts(shards: DataFrame) -> tuple[DataFrame, int, int]:
    """Counts over all shards of each shard's words, (shard, part, counts), staged; all tokens, and the distinct ones."""
    total = shards.agg(F.sum("n_words")).first()[0] or 0
    parts = max(partitions(shards.sparkSession), -(-total // PART_WORDS))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, packed, count in zip(batch["shard"].to_pylist(), batch["words"], batch["counts"]):
                words = unpack(packed.as_py()).split(BETWEEN)
                count = np.frombuffer(unpack(count.as_py()), dtype="<i8")
                cuts = np.searchsorted(hashes(words) * parts >> 32, np.arange(parts + 1))
                some = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                slices = [slice(cuts[p], cuts[p + 1]) for p in some]
                columns = [[pack(BETWEEN.join(words[s])) for s in slices], [pack(count[s].tobytes()) for s in slices]]
                yield pa.record_batch(
                    [pa.array([shard] * len(some), pa.int64()), pa.array(some, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)],
                    names=["shard", "part", "words", "counts"],
                )

    def add_up(asked: pa.Table) -> pa.Table:
        words = [unpack(w).split(BETWEEN) for w in asked["words"].to_pylist()]
        total: Counter[bytes] = Counter()
        for own, count in zip(words, asked["counts"].to_pylist()):
            for word, n in zip(own, np.frombuffer(unpack(count), dtype="<i8").tolist()):
                total[word] += n
        counts = [pack(np.fromiter(map(total.__getitem__, own), "<i8", len(own)).tobytes()) for own in words]
        sums = (sum(total.values()), sum(n > 0 for n in total.values()))
        firsts = [pa.array(list(chain([n], repeat(0, len(words) - 1))), pa.int64()) for n in sums]
        return pa.table([asked["shard"], asked["part"], pa.array(counts, pa.binary()), *firsts], names=["shard", "part", "counts", "tokens", "kinds"])

    asked = shards.select("shard", "words", "counts").mapInArrow(cut, "shard long, part int, words binary, counts binary")
    added = asked.groupBy("part").applyInArrow(add_up, "shard long, part int, counts binary, tokens long, kinds long")
    counted = staged(added, "word-counts")
    tokens, kinds = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    return counted.drop("tokens", "kinds"), tokens, kinds


def shard_runs(shards: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1), len(shards)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)
