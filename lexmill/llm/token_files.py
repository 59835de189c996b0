"""Token-id files: one long array of ids, with document boundaries in Elias-Fano form.

``write_tokens`` sorts the documents by id into ranges, encodes each range in
one task, and writes blocks of whole documents. A block is one binary record:

    "TKEF", version 1 byte, bytes per id 1 byte, low bits 1 byte, sample step 1 byte,
    documents uint32, ids uint64, samples uint32,      (all little-endian)
    low halves, high halves, sampled positions uint32, document ids, token ids

A boundary is the number of ids up to the end of a document. Its lowest bits are
stored as they are, the rest in unary: boundary i sets bit (high part + i). The
position of every 64th set bit is kept, so that ``boundary(i)`` looks at a few
bytes only. That takes about 2 + log2(ids per document) bits a document.

Blocks are the rows of a Parquet table, so that Spark commits, retries and reads
them on any file system. ``read_tokens`` decodes them again.

Nulls: a null text is empty (just the end id); documents with a null id come
first. Repeated rows are written as often as they occur, equal ids ordered by
text. An empty table gives an empty file. Other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import tokens
from lexmill.llm.common import partitions

HEAD = "<4sBBBBIQI"
STEP = 64

# A block ends with the first document that reaches so many ids (2 bytes each).
BLOCK_IDS = 1 << 20

BLOCKS = "piece int, first_id long, n_docs int, n_tokens long, before long, block binary"
NO_ID = np.iinfo(np.int64).min


class Boundaries:
    """Monotone numbers in Elias-Fano form, with select by sampled positions."""

    def __init__(self, n: int, width: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "Boundaries":
        values = np.asarray(values, dtype=np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(width)) & 1
        places = (values >> width) + np.arange(n)
        marks = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        marks[places] = 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        high = np.packbits(marks, bitorder="little").tobytes()
        return cls(n, width, low, high, places[::STEP].astype("<u4"))

    def all(self) -> np.ndarray:
        marks = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        upper = (np.flatnonzero(marks) - np.arange(self.n)) << self.width
        if not self.width:
            return upper
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.width)
        return upper | bits.reshape(self.n, self.width).astype(np.int64) @ (1 << np.arange(self.width))

    def boundary(self, i: int) -> int:
        """Value i alone: from the nearest sample on, whole bytes are skipped by their bit counts."""
        place, left = int(self.samples[i // STEP]), i % STEP
        byte = place // 8
        word = self.high[byte] >> (place % 8) << (place % 8)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        upper = byte * 8 + (word & -word).bit_length() - 1 - i
        first = i * self.width
        chunk = int.from_bytes(self.low[first // 8 : (first + self.width + 7) // 8], "little")
        return upper << self.width | chunk >> first % 8 & (1 << self.width) - 1


def pack_block(doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    """One block: the documents' ids and numbers of tokens, and all their tokens."""
    ends = Boundaries.of(np.cumsum(lengths))
    keys = np.array([NO_ID if d is None else d for d in doc_ids], dtype="<i8")
    head = struct.pack(HEAD, b"TKEF", 1, width, ends.width, STEP, ends.n, len(ids) // width, len(ends.samples))
    return b"".join([head, ends.low, ends.high, ends.samples.tobytes(), keys.tobytes(), ids])


class Block:
    """A block read back. ``ids(i)`` finds the tokens of document i by select alone."""

    def __init__(self, data: bytes):
        magic, version, size, width, step, n, total, samples = struct.unpack_from(HEAD, data)
        if (magic, version, step) != (b"TKEF", 1, STEP):
            raise ValueError("not a token block")
        at = struct.calcsize(HEAD)
        low_end = at + (n * width + 7) // 8
        high_end = low_end + ((total >> width) + n + 7) // 8
        keys_at = high_end + 4 * samples
        self.n = n
        self.ends = Boundaries(
            n, width, data[at:low_end], data[low_end:high_end], np.frombuffer(data, "<u4", samples, high_end)
        )
        self.doc_ids = np.frombuffer(data, "<i8", n, keys_at)
        self.tokens = np.frombuffer(data, f"<u{size}", total, keys_at + 8 * n)

    def ids(self, i: int) -> np.ndarray:
        return self.tokens[self.ends.boundary(i - 1) if i else 0 : self.ends.boundary(i)]


def _blocks(vocabulary: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokens.encoder(vocabulary, "kept")
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        piece, width, before = TaskContext.get().partitionId(), encoder.dtype.itemsize, 0
        doc_ids, parts, held = [], [], 0

        def block() -> pa.RecordBatch:
            lengths = [len(p) // width for p in parts]
            data = pack_block(doc_ids, lengths, b"".join(parts), width)
            row = ([piece], doc_ids[:1], [len(doc_ids)], [held], [before], [data])
            return pa.record_batch(
                [pa.array(v, t) for v, t in zip(row, SCHEMA.types)], names=SCHEMA.names
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), tokens.texts_of(batch.column(1))):
                ids = encoder.ids(text) + end
                doc_ids.append(doc_id.as_py())
                parts.append(ids)
                held += len(ids) // width
                if held >= BLOCK_IDS:
                    yield block()
                    before += held
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield block()

    return encode


SCHEMA = pa.schema(
    [
        ("piece", pa.int32()),
        ("first_id", pa.int64()),
        ("n_docs", pa.int32()),
        ("n_tokens", pa.int64()),
        ("before", pa.int64()),
        ("block", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2) -> None:
    """Encode ``docs(doc_id, text)`` and write the blocks in ascending order of ids to ``path``.

    One shuffle of the texts, by ranges of ids; a task encodes one document at a time.
    """
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(2 * partitions(docs.sparkSession), "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_blocks(vocabulary, end_id), BLOCKS)
        .write.parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it: those of earlier pieces
    (one number a piece on the driver), of earlier blocks, and within the block.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    base, total = {}, 0
    for row in blocks.groupBy("piece").agg(F.sum("n_tokens").alias("n")).orderBy("piece").collect():
        base[row["piece"]] = total
        total += row["n"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for piece, before, data in zip(*(batch.column(i) for i in range(3))):
                block = Block(data.as_py())
                ends = block.ends.all()
                starts = np.concatenate([[0], ends[:-1]])
                crcs = [zlib.crc32(tokens.little_endian_32(block.ids(i))) for i in range(block.n)]
                yield pa.record_batch(
                    [
                        pa.array(block.doc_ids, mask=block.doc_ids == NO_ID),
                        pa.array(starts + base[piece.as_py()] + before.as_py()),
                        pa.array(ends - starts),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.select("piece", "before", "block").mapInArrow(
        decode, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
