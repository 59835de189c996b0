"""Top hits without scoring every posting.

A saved index has, for every frequent term and every block of documents (a range of
ids), the largest term frequency, the shortest document and the largest tf weight
per norm there. They bound what the term can add to the score of any document of
the block, for any parameters of the ranking. A search then takes three steps:

1. The bounds of a query's terms are summed up per block; those of rare terms come
   from their few postings.
2. The ``k`` blocks with the highest bounds are scored. The k-th best score found is
   one that every hit has to reach.
3. Only blocks whose bound reaches it are read, by ranges of ids that are pushed down
   to the scan, and scored.

Blocks are kept whole, so the scores of the documents are exact, and all hits and
ties are found.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.weights import tf_weight
from lexmill.session import local_copy, small_rows, stage

if TYPE_CHECKING:
    from lexmill.operators.queries import TermSide

# Terms in fewer documents have no maxima: their postings are as quickly read.
FREQUENT_DF = 4096

# Documents a block has on average.
BLOCK_DOCS = 128

# Postings of frequent terms from which pruning is worth its extra steps.
WORTH_POSTINGS = 5_000_000

# Ranges of ids that are pushed down to a scan at most.
PUSHED_RANGES = 200

# Sums of doubles in another order differ by far less.
NOISE = 1e-6

# The block of documents without an id.
NO_BLOCK = -(1 << 62)


def block_of(doc_id: Column, bits: int) -> Column:
    return F.coalesce(F.shiftright(doc_id, bits), F.lit(NO_BLOCK))


def block_bits(doc_stats: DataFrame) -> int:
    """How many low bits of an id its block leaves out, for about ``BLOCK_DOCS`` documents in a block that has any.

    Gaps between ids do not matter: blocks are counted for every number of bits, in one pass.
    """
    blocks = [F.approx_count_distinct(F.shiftright("doc_id", bits)).alias(f"b{bits}") for bits in range(63)]
    n, *counts = doc_stats.agg(F.count("doc_id"), *blocks).first()
    fitting = [bits for bits, count in enumerate(counts) if n <= count * BLOCK_DOCS]
    return max(fitting, default=0) if n else 0


def block_maxima(postings: DataFrame, terms: DataFrame, bits: int, frequent_df: int = FREQUENT_DF) -> DataFrame:
    """(shard, term, block, max_tf, min_len, max_ratio) of the terms in at least ``frequent_df`` documents.

    There are fewer such terms than postings divided by ``frequent_df``.
    """
    frequent = terms.where(F.col("df") >= frequent_df).select("shard", "term")
    few = small_rows(frequent)
    frequent = frequent if few is None else F.broadcast(local_copy(frequent, few))
    return (
        postings.join(frequent, ["shard", "term"])
        .groupBy("shard", "term", block_of(F.col("doc_id"), bits).alias("block"))
        .agg(
            F.max("tf").alias("max_tf"),
            F.min("doc_len").alias("min_len"),
            F.max(tf_weight(F.col("tf")) / F.col("norm")).alias("max_ratio"),
        )
    )


def worth_pruning(index, side: TermSide) -> bool:
    """Whether the query terms have enough postings of frequent terms, by the dictionary."""
    if index.maxima is None:
        return False
    frequent = F.when(F.col("df") >= index.frequent_df, F.col("df"))
    return (side.terms.agg(F.sum(frequent)).first()[0] or 0) >= WORTH_POSTINGS


def chosen_blocks(index, side: TermSide, bound: Column, scored: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """(query_id, block): the blocks that can hold one of the first ``k`` hits of a query.

    ``bound`` is what a query term can add, over max_tf, min_len, max_ratio, df and n;
    ``scored`` turns matched postings into (query_id, doc_id, score).
    """
    frequent = F.col("df") >= index.frequent_df
    own = F.greatest(bound, F.lit(0.0)).alias("bound")
    of_frequent = side.narrowed(side.terms.where(frequent)).join(index.maxima).select("query_id", "block", own)
    rare = side.narrowed(side.terms.where(~frequent)).join(index.postings)
    as_maxima = rare.withColumns(
        {
            "max_tf": F.col("tf"),
            "min_len": F.col("doc_len"),
            "max_ratio": tf_weight(F.col("tf")) / F.col("norm"),
            "block": block_of(F.col("doc_id"), index.block_bits),
        }
    )
    of_rare = as_maxima.select("query_id", "term", "block", own).groupBy("query_id", "term", "block").agg(F.max("bound").alias("bound"))
    bounds = of_frequent.unionByName(of_rare.drop("term")).groupBy("query_id", "block").agg(F.sum("bound").alias("bound"))
    bounds = stage(bounds, "block-bounds")
    highest = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    seeds = bounds.withColumn("place", F.row_number().over(highest)).where(F.col("place") <= k).select("query_id", "block")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    first = scored(in_blocks(index, side, stage(seeds, "seed-blocks"))).withColumn("place", F.row_number().over(best))
    least = first.where(F.col("place") <= k).where(F.col("place") == k).select("query_id", F.col("score").alias("least"))
    reach = F.col("least").isNull() | (F.col("bound") >= F.col("least") - NOISE)
    return stage(bounds.join(stage(least, "least-scores"), "query_id", "left").where(reach).select("query_id", "block"), "chosen-blocks")


def in_blocks(index, side: TermSide, blocks: DataFrame) -> DataFrame:
    """The postings of the query terms in ``blocks(query_id, block)``, a staged table."""
    postings, bits = index.postings, index.block_bits
    listed = small_rows(blocks.select("block").distinct().orderBy("block"))
    if listed is not None and (ranges := id_ranges([row.block for row in listed], bits)) is not None:
        postings = postings.where(ranges)
    few = small_rows(blocks)
    blocks = blocks if few is None else F.broadcast(local_copy(blocks, few))
    matched = side.join(postings).withColumn("block", block_of(F.col("doc_id"), bits))
    return matched.join(blocks, ["query_id", "block"])


def id_ranges(blocks: list[int], bits: int) -> Column | None:
    """The ids of some blocks as ranges, neighbouring blocks in one; None for too many ranges."""
    runs: list[list[int]] = []
    for block in sorted(blocks):
        if block != NO_BLOCK and runs and runs[-1][1] == block - 1:
            runs[-1][1] = block
        else:
            runs.append([block, block])
    if len(runs) > PUSHED_RANGES:
        return None
    inside = F.lit(False)
    for first, last in runs:
        no_id = first == NO_BLOCK
        inside = inside | (F.col("doc_id").isNull() if no_id else F.col("doc_id").between(first << bits, ((last + 1) << bits) - 1))
    return inside


def pruned(index, side: TermSide, bound: Column, scored: Callable[[DataFrame], DataFrame], k: int) -> DataFrame:
    """(query_id, doc_id, score) of the documents among which the first ``k`` hits of every query are."""
    if side.rows is None:
        side = side.narrowed(stage(side.terms, "query-terms"))
    return scored(in_blocks(index, side, chosen_blocks(index, side, bound, scored, k)))
