"""Query strings as a DataFrame of terms.

A single query is a batch of one: every search takes ``queries(query_id, q)``,
and wraps a string or a list of strings into it.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import split_query
from lexmill.schemas import QUERIES
from lexmill.session import local_copy, salted, small_rows, stage

# A filter on more values than this costs more to plan than it saves.
PUSHED_VALUES = 500

# Largest measured side that is broadcast, and what a row takes beside its term.
BROADCAST_BYTES = 16 << 20
ROW_BYTES = 128

Queries = str | list[str] | DataFrame


def as_queries(spark: SparkSession, queries: Queries) -> DataFrame:
    if isinstance(queries, DataFrame):
        return queries.select(F.col("query_id").cast("long").alias("query_id"), "q")
    listed = [queries] if isinstance(queries, str) else queries
    return spark.createDataFrame(list(enumerate(listed)), QUERIES)


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, slot, term): lower-cased parts of each query, repeats included."""
    return (
        queries.select("query_id", split_query(F.lower("q")).alias("parts"))
        .select("query_id", F.posexplode_outer("parts").alias("slot", "term"))
        .where(F.col("term").isNotNull())
    )


def shard_of(term: Column, shards: int) -> Column:
    """Index shard of a term."""
    return F.pmod(F.hash(term), F.lit(shards))


class TermSide:
    """Query terms prepared as one side of a join with an index table.

    Few terms are held as ``rows``, broadcast, and pushed down as filters. More
    are staged and measured, and broadcast up to ``BROADCAST_BYTES``. Beyond
    that both sides are shuffled, which the hint sees to: Spark takes the size of a
    staged table from its files, without the salts, and would broadcast it.
    """

    def __init__(self, terms: DataFrame, shards: int | None) -> None:
        self.shards = shards
        self.terms = terms
        if shards:
            self.terms = terms.withColumn("shard", shard_of(F.col("term"), shards))
        self.rows = small_rows(self.terms)
        if self.rows is not None:
            self.terms, self.fits = local_copy(self.terms, self.rows), True
        else:
            self.terms = stage(self.terms, "query-terms")
            size = self.terms.agg(F.sum(F.octet_length("term") + ROW_BYTES)).first()[0]
            self.fits = size <= BROADCAST_BYTES

    def narrowed(self, terms: DataFrame) -> TermSide:
        """The same side after a join that adds no rows to it."""
        side = copy.copy(self)
        side.terms = terms
        return side

    def join(self, table: DataFrame, key: str = "term") -> DataFrame:
        """Equi-join ``table`` on its term column."""
        if key != "term":
            table = table.withColumnRenamed(key, "term")
        keys = ["shard", "term"] if self.shards else ["term"]
        for column in keys if self.rows is not None else ():
            values = sorted({row[column] for row in self.rows})
            if len(values) <= PUSHED_VALUES:
                table = table.where(F.col(column).isin(values))
        if self.fits:
            return table.join(F.broadcast(self.terms), keys)
        # Tables without shards may be bucketed by term, which a salt would undo.
        if not self.shards or "doc_id" not in table.columns:
            return table.join(self.terms.hint("merge"), keys)
        postings, terms = salted(table, self.terms, "doc_id")
        return postings.join(terms.hint("merge"), [*keys, "salt"]).drop("salt")
