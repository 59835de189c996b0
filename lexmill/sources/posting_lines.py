"""Posting lines of a text index as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the line format: term:df <tab> doc:tf:len<p1, p2>; ...
KEY_PATTERN = r"^(.*):(\d+)$"
LINE_ENDS = "\n\r\u0085\u2028\u2029"
POSTING_PATTERN = r"^(\d+)(?::(\d+):(\d+)<(.*)>)?$"


def read_posting_lines(spark: SparkSession, path: str) -> DataFrame:
    """Decoded rows of the posting lines under ``path``."""
    return from_posting_lines(spark.read.text(path).withColumnRenamed("value", "line"))


def from_posting_lines(lines: DataFrame) -> DataFrame:
    """(term, df, doc_id, tf, doc_len, positions) of ``lines(line)``.

    tf, doc_len and positions are null for uniword and biword lines. The last
    ':' of the key separates the df, so terms may hold a ':'. A term may take
    several lines. Lines and postings of another form are left out; see
    ``bad_posting_lines``.
    """
    key, listed = (F.get(F.split("line", "\t"), F.lit(i)) for i in (0, 1))
    # The outer generator and the steps of their own: what is read off a line is read once, and not again for each posting.
    fields = lines.where(key.rlike(KEY_PATTERN)).select(key.alias("key"), F.split(F.trim(listed), r";\s*").alias("listed"))
    rows = (
        fields.select(
            F.regexp_extract("key", KEY_PATTERN, 1).alias("term"),
            F.regexp_extract("key", KEY_PATTERN, 2).cast("long").alias("df"),
            "listed",
        )
        .select("term", "df", F.explode_outer("listed").alias("posting"))
        .select("term", "df", F.trim("posting").alias("posting"))
    )

    # What has the form is cut by plain string functions, which cost a fraction of a pattern with groups.
    good = rows.where(F.col("posting").rlike(POSTING_PATTERN)).select(
        "term", "df", F.rtrim("posting", F.lit(LINE_ENDS)).alias("posting")
    )
    cut = good.select("*", F.substring_index("posting", "<", 1).alias("head")).select("*", F.split("head", ":").alias("parts"))
    after = F.length("head") + 2
    places = F.substring("posting", after, F.greatest(F.length("posting") - after, F.lit(0)))
    number = {name: F.get("parts", F.lit(i)) for i, name in enumerate(("doc_id", "tf", "doc_len"))}
    return cut.select("term", "df", *(number[name].alias(name) for name in number), F.nullif(places, F.lit("")).alias("places")).select(
        "term",
        "df",
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("tf").cast("int").alias("tf"),
        F.col("doc_len").cast("int").alias("doc_len"),
        F.split("places", r",\s*").cast("array<int>").alias("positions"),
    )


def bad_posting_lines(lines: DataFrame) -> DataFrame:
    """(line) of the lines that hold no key with a df, no tab, or a posting of another form."""
    parts = F.split("line", "\t")
    listed = F.array_remove(F.split(F.trim(F.get(parts, F.lit(1))), r";\s*"), "")
    good = F.get(parts, F.lit(0)).rlike(KEY_PATTERN) & F.forall(listed, lambda p: F.trim(p).rlike(POSTING_PATTERN))
    return lines.where(~F.coalesce(good, F.lit(False))).select("line")
