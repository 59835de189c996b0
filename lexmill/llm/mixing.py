"""Mixing sources to target weights. DataFrame operations only.

Words are summed by source. The sources, in code-point order with null last,
take the weights in turn and share all words in proportion, but no source gets
more than ``most`` times its own words: what is above is shared again among the
others. The limit of that resharing is a level: a source gets the smaller of its
limit and weight * level. Going through the sources from the lowest limit per
unit of weight, all are at their limit until the level of the rest fits.

The repetition rate of a source is its target over its words. A document is
taken floor(rate) times, and once more if a hash of its id, read as a number in
[0, 1), is below the fraction. So reruns agree, and no state is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import WORD, ranked, staged, with_group

WEIGHTS = (5, 2, 1)
MOST = 3

# So many sources, with so many bytes of names, are broadcast; their number and size are counted first.
FEW_SOURCES = 100_000
FEW_BYTES = 16 << 20


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed only (52 bits of their MD5)."""
    named = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, rows, source_size, target) for every source of ``sizes(source, size)``.

    Nothing is collected: sources are ranked, and summed up, in sorted ranges.
    """
    per_source = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").cast("long").alias("source_size")
    )
    # null sorts last; the flag is its own column, as ranges are sorted with nulls first
    flagged = per_source.withColumn("absent", F.col("source").isNull())
    order = ranked(flagged, [], ["absent", "source"], "sources").drop("absent")
    pick = F.array(*(F.lit(w).cast("long") for w in weights))
    limited = order.withColumn("weight", F.get(pick, F.pmod("rank", F.lit(len(weights))).cast("int"))).drop("rank")
    limited = limited.withColumn("limit", F.col("source_size") * most).withColumn(
        "fullness", F.col("limit") / F.col("weight")
    )
    limited = staged(limited, "source-limits")
    per_fullness = limited.groupBy("fullness").agg(F.sum("limit").alias("limits"), F.sum("weight").alias("weights"))
    rising = ranked(per_fullness, [], ["fullness"], "levels", totals=("limits", "weights"))
    words, all_weights = limited.agg(F.sum("source_size"), F.sum("weight")).first()
    rest = (F.lit(words).cast("long") - F.col("before_limits")).cast("double")
    share = F.lit(all_weights).cast("long") - F.col("before_weights")
    level = (
        rising.where(rest / share <= F.col("fullness"))
        .agg(F.min_by(F.struct(rest.alias("rest"), share.alias("share")), "fullness").alias("level"))
        .first()["level"]
    )
    rest, share = level or (0.0, 1)
    target = F.least(F.col("limit").cast("double"), F.lit(rest) * F.col("weight") / F.lit(share))
    return limited.select("source", "rows", "source_size", target.alias("target"))


def copies_of(rows: DataFrame, sizes: DataFrame, seed: str = "mix", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``rows(doc_id, source, ...)`` with source_size, target and copies; ``sizes(source, size)`` has all documents.

    A null source is a source of its own, the last. Sources without words have
    target 0 and their documents are not taken. A null doc_id is hashed as a
    word of its own. Repeated rows are treated alike. An empty table gives no rows.
    """
    targets = staged(source_targets(sizes, weights, most), "source-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = F.when(unit_hash(F.col("doc_id"), seed) < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))
    # a null source has no equal: it is joined under a key of its own
    key = F.concat(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.lit("+")), F.coalesce("source", F.lit("")))
    keyed = targets.select(key.alias("source key"), "rows", "source_size", "target")
    n, size, total = keyed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("source key")), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))
    ).first()
    left = rows.withColumn("source key", key)
    if n <= FEW_SOURCES and size <= FEW_BYTES:
        joined = left.join(F.broadcast(keyed), "source key")
    else:
        joined = with_group(left, keyed, "source key", "rows", total)
    return joined.withColumn("copies", F.floor(rate).cast("long") + extra).drop("source key", "rows")


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of every row, counted once and staged."""
    return staged(docs.select("doc_id", "source", n_words(docs["text"]).alias("size")), "sizes")


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixture itself: ``docs`` with each row as often as it is taken, and its columns only."""
    whole = docs.select("doc_id", "source", F.struct(*docs.columns).alias("document"))
    taken = copies_of(whole, sizes_of(docs), seed, weights, most).where("copies > 0")
    return taken.select("document", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("document.*")
