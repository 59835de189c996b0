"""Small line-based inputs: stop-word lists and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import trim_control


def _leading_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, line) of each file up to its first blank line."""
    lines = F.split("value", r"\r\n|\r|\n")
    first_blank = F.array_position(F.transform("lines", lambda x: trim_control(x) == ""), True)
    return (
        spark.read.text(path, wholetext=True)
        .select(lines.alias("lines"))
        .select("lines", first_blank.alias("blank"))
        .select(
            F.posexplode_outer(
                F.when(F.col("blank") == 0, F.col("lines"))
                .otherwise(F.slice("lines", 1, F.greatest(F.col("blank") - 1, F.lit(0)).cast("int")))
            ).alias("pos", "line")
        )
        .where(F.col("line").isNotNull())
    )


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a stop-word file: one per line, untrimmed, up to the first blank line."""
    return _leading_lines(spark, path).select(F.col("line").alias("word"))


def _number(fields: Column, place: int) -> Column:
    """A field as a number, null where it is missing or none."""
    return F.get(fields, F.lit(place)).try_cast("long")


def read_corpus_stats(spark: SparkSession, path: str) -> DataFrame:
    """(n_docs, avg_len) of a statistics file; its last line before a blank one counts."""
    fields = F.split(trim_control(F.col("line")), "\t")
    return (
        _leading_lines(spark, path)
        .select("pos", _number(fields, 0).alias("n_docs"), _number(fields, 1).alias("avg_len"))
        .orderBy(F.desc("pos"))
        .limit(1)
        .select("n_docs", "avg_len")
    )
