"""Shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only after it was counted and has at most this many rows.
SMALL_SIDE_ROWS = 20_000

# Parts a hot join key is split into where neither side is small.
SALTS = 16

_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster
    session must name one, as executors do not share their local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lexmill-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    This cuts the lineage with files that outlive any executor. They are written with zstd,
    as they take most of the disk of a job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged table that nothing will read again."""
    spark = staged.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(staged.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_rows(df: DataFrame, limit: int = SMALL_SIDE_ROWS) -> list[Row] | None:
    """The rows of ``df``, or None if there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def local_copy(df: DataFrame, rows: list[Row]) -> DataFrame:
    """Rows already counted on the driver, as a DataFrame to broadcast."""
    return df.sparkSession.createDataFrame(rows, df.schema)


def salted(large: DataFrame, other: DataFrame, spread_by: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a ``salt`` column to join on as well.

    Rows of the large side are spread by one of its columns; each row of the
    other side is repeated for every salt. A key that holds a large share of
    all rows then goes to several tasks.
    """
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    return (
        large.withColumn("salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS))),
        other.withColumn("salt", F.explode(salts)),
    )
