"""Ranks and running sums over any number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import stage


def ranked(df: DataFrame, group: list[str], order: list[str], name: str, totals: tuple[str, ...] = ()) -> DataFrame:
    """``df`` staged with ``rank`` (0, 1, ... within ``group``, in ``order``), without a window over a whole group.

    Rows are dealt into sorted ranges of (group, order); a rank is the row's
    place in its part of the range plus the rows of the group in earlier ranges.
    ``order`` must tell rows apart for ranks that do not depend on the run. For
    each column in ``totals`` there is also ``before_<column>``: its sum over the
    earlier rows of the group.
    """
    keys = [*group, *order]
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = stage(df.repartitionByRange(pieces, *keys).withColumn("piece", F.spark_partition_id()), name)
    inside = Window.partitionBy("piece", *group).orderBy(*order)
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = place.groupBy("piece", *group).agg(
        F.count(F.lit(1)).alias("rank_"), *(F.sum(c).alias(f"before_{c}_") for c in totals)
    )
    parts = parts.select(
        "piece", *group, *(F.coalesce(F.sum(c).over(earlier), zero).alias(c) for c in parts.columns if c.endswith("_"))
    )
    rows = place.withColumn("rank", F.row_number().over(inside) - F.lit(1).cast("long"))
    for c in totals:
        rows = rows.withColumn(f"before_{c}", F.coalesce(F.sum(c).over(above), zero))
    condition = rows["piece"] == parts["piece"]
    for c in group:
        condition = condition & rows[c].eqNullSafe(parts[c])
    added = [(rows[c] + parts[f"{c}_"]).alias(c) for c in ("rank", *(f"before_{c}" for c in totals))]
    return rows.join(parts, condition).select(*(rows[c] for c in df.columns), *added)
