"""Helpers the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators.ranks import ranked
from lexmill.session import stage as staged

__all__ = ["HOT_PART", "LOWER", "UPPER", "WORD", "least_hashes", "lower_ascii", "pack", "partitions", "ranked", "staged", "unpack", "with_group"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# A key with more than this part of all rows is hot; so there are fewer hot keys than its inverse.
HOT_PART = 1000


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack(data: bytes) -> bytes:
    """Bytes in fewer bytes, after their number."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def with_group(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` inner-joined with ``groups`` (one row per non-null ``key``, of ``size`` rows out of ``total``).

    Keys that hold more than one row in ``HOT_PART`` are fewer than ``HOT_PART``
    whatever the data, so they are broadcast; rows of the other keys are
    shuffled, and none of those keys can fill a task.
    """
    limit = F.lit(max(total // HOT_PART, 1))
    hot, cold = groups.where(F.col(size) > limit), groups.where(F.col(size) <= limit)
    few = F.broadcast(hot)
    return rows.join(few, key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def least_hashes(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest 64-bit hashes ``key``, of a staged table of distinct hashes.

    A threshold that some more than ``n`` hashes lie below is taken from the number of
    rows first, so that the tasks together send about ``n`` rows to be sorted, however
    many there are.
    """
    total = rows.count()
    if total > 2 * n:
        below = rows.where(F.col(key) < int(2**64 * min(1.0, (1.2 * n + 100) / total)) - 2**63)
        if below.count() >= n:
            rows = below
    return rows.orderBy(key).limit(n)
