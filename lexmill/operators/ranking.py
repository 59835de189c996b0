"""Top hits per query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.schemas import HIT_COLUMNS
from lexmill.sources.news import doc_name

# Up to the rank in this setting Spark cuts window groups ahead of the shuffle.
# Beyond it the groups are cut in salted parts first.
GROUP_LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
SALTS = 64

# Sums of doubles depend on their order. Hits are compared at so many digits, which
# only takes off that noise (of sums up to some thousands), and reported with fewer.
EXACT_DIGITS = 9
SCORE_DIGITS = 6


def top_hits(scored: DataFrame, k: int, ties: Column | None = None) -> DataFrame:
    """(query_id, doc_id, doc_name, score, rank) of the k best hits per query.

    Ties go by document id. ``rank <= k`` lets every task drop all but its own k
    best rows per query before the shuffle, so a query that hits a third of the
    corpus is no hot group. With k=0 all hits are kept, without ranks.
    """
    order = [F.desc("score"), F.col("doc_id") if ties is None else ties]
    if k == 0:
        ranked = scored.withColumn("rank", F.lit(None).cast("int"))
    else:
        if k > int(scored.sparkSession.conf.get(GROUP_LIMIT_CONF)):
            salted = Window.partitionBy("query_id", "salt").orderBy(*order)
            scored = (
                scored.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
                .withColumn("salted_rank", F.row_number().over(salted))
                .where(F.col("salted_rank") <= k)
                .drop("salt", "salted_rank")
            )
        best = Window.partitionBy("query_id").orderBy(*order)
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    named = ranked.withColumns({"doc_name": doc_name(F.col("doc_id")), "score": F.round("score", SCORE_DIGITS)})
    return named.select(HIT_COLUMNS)
