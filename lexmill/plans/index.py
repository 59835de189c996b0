"""Building, saving and loading an index."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexmill import schemas
from lexmill.functions.weights import REFERENCE, STANDARD
from lexmill.operators import postings as ops
from lexmill.operators.pruning import FREQUENT_DF, block_bits, block_maxima
from lexmill.operators.queries import shard_of
from lexmill.operators.stats import corpus_stats, document_norms, norm_of_postings
from lexmill.operators.tokens import StopWords
from lexmill.session import discard, local_copy, small_rows, stage
from lexmill.sources.lines import read_corpus_stats
from lexmill.sources.posting_lines import read_posting_lines

SHARDS = 64
ROWS_PER_FILE = 8_000_000

# Terms are counted by so many first characters, to cut a shard into files.
FIRST_CHARACTERS = 4
VARIANT_NORMS = ((STANDARD, "norm"), (REFERENCE, "norm_reference"))
NORMS = tuple(name for _, name in VARIANT_NORMS)


@dataclass
class Index:
    """Tables of an index.

    The term tables have a ``shard`` column where ``shards`` is set; searches
    then read only the shards, and the row groups, of their terms.
    """

    spark: SparkSession
    shards: int | None
    doc_stats: DataFrame
    corpus_stats: DataFrame
    terms: DataFrame | None = None
    biwords: DataFrame | None = None
    postings: DataFrame | None = None
    uniwords: DataFrame | None = None
    biword_terms: DataFrame | None = None
    maxima: DataFrame | None = None
    block_bits: int = 0
    frequent_df: int = FREQUENT_DF

    @cached_property
    def stats(self) -> Row:
        """The one row of corpus statistics."""
        return self.corpus_stats.first()

    @property
    def doc_lists(self) -> DataFrame:
        """(term, doc_id) from whichever index holds it."""
        self.need_terms()
        table = self.postings if self.postings is not None else self.uniwords
        return table.select("term", "doc_id", *(["shard"] if self.shards else []))

    def need_terms(self) -> None:
        if self.terms is None:
            raise ValueError("this needs a positional or uniword index")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Index:
        """Open the index that ``build_index`` wrote to ``path``."""
        meta = spark.read.parquet(f"{path}/meta").first()

        def table(name: str, schema) -> DataFrame:
            return spark.read.schema(schema).parquet(f"{path}/{name}")

        index = cls(
            spark,
            meta.shards,
            table("doc_stats", schemas.DOC_STATS),
            table("corpus_stats", schemas.CORPUS_STATS),
        )
        if "positional" in meta.kinds:
            index.postings = table("postings", schemas.POSTINGS)
            if "block_bits" in meta:
                index.maxima = table("maxima", schemas.MAXIMA)
                index.block_bits, index.frequent_df = meta.block_bits, meta.frequent_df
        if "uniword" in meta.kinds:
            index.uniwords = table("uniwords", schemas.UNIWORDS)
        if "biword" in meta.kinds:
            index.biwords = table("biwords", schemas.BIWORDS)
            index.biword_terms = table("biword_terms", schemas.BIWORD_TERMS)
        if index.postings is not None or index.uniwords is not None:
            index.terms = table("terms", schemas.TERMS)
        return index

    def save_tables(self, prefix: str, buckets: int = SHARDS) -> None:
        """Save as catalog tables ``<prefix>_<name>``, bucketed and sorted by term.

        Bucketed tables join and group by term without a shuffle. Rows reach
        the writers by ranges of (bucket, term, document), so that no term has
        to fit one task.
        """
        for name, key in (("postings", "term"), ("uniwords", "term"), ("biwords", "biword"), ("terms", "term"), ("biword_terms", "biword")):
            table = getattr(self, name)
            if table is None:
                continue
            order = [shard_of(F.col(key), buckets), F.col(key)]
            if "doc_id" in table.columns:
                order.append(F.col("doc_id"))
            (
                table.drop("shard")
                .repartitionByRange(*order)
                .write.bucketBy(buckets, key)
                .sortBy(key)
                .saveAsTable(f"{prefix}_{name}")
            )
        self.doc_stats.write.saveAsTable(f"{prefix}_doc_stats")
        self.corpus_stats.write.saveAsTable(f"{prefix}_corpus_stats")

    @classmethod
    def from_tables(cls, spark: SparkSession, prefix: str) -> Index:
        """Open tables that ``save_tables`` wrote."""

        def table(name: str) -> DataFrame | None:
            full = f"{prefix}_{name}"
            return spark.table(full) if spark.catalog.tableExists(full) else None

        return cls(
            spark,
            None,
            **{name: table(name) for name in ("doc_stats", "corpus_stats", "terms", "biwords", "postings", "uniwords", "biword_terms")},
        )

    @classmethod
    def from_lines(cls, spark: SparkSession, path: str, stats_path: str | None = None, kind: str | None = None) -> Index:
        """Open an index kept as posting lines: a positional or uniword one, or with ``kind="biword"`` one of pairs.

        Everything is decoded and derived once, into staged tables. Lines of the
        reference form give length 0 to documents that hold a term once; the
        length is taken from a document's other postings, and is null if it has
        none. ``stats_path`` is a file of corpus statistics; without one they are
        those of the documents in the postings. Lines that cannot be decoded are
        left out (``bad_posting_lines`` has them).
        """
        if kind not in (None, "biword"):
            raise ValueError(f"kind must be None or 'biword', not {kind!r}")
        rows = stage(read_posting_lines(spark, path), "lines")
        if kind == "biword":
            pairs = rows.select(F.col("term").alias("biword"), "doc_id")
            pair_terms = stage(rows.groupBy(F.col("term").alias("biword")).agg(F.max("df").alias("df")), "biword-terms")
            lengths = stage(rows.select("doc_id").distinct().withColumn("doc_len", F.lit(None).cast("int")), "doc-stats")
            stats = corpus_stats(lengths) if stats_path is None else _stats_of(spark, stats_path)
            return cls(spark, None, lengths, stats, biwords=pairs, biword_terms=pair_terms)
        terms = stage(rows.groupBy("term").agg(F.max("df").alias("df")), "terms")
        positional = not rows.where(F.col("tf").isNotNull()).isEmpty()
        norms = [F.coalesce(norm_of_postings(v), F.lit(0.0)).alias(n) for v, n in VARIANT_NORMS] if positional else []
        lengths = rows.groupBy("doc_id").agg(F.nullif(F.max("doc_len"), F.lit(0)).alias("doc_len"), *norms)
        doc_stats = stage(lengths, "doc-stats")
        stats = corpus_stats(doc_stats) if stats_path is None else _stats_of(spark, stats_path)
        if not positional:
            return cls(spark, None, doc_stats, stats, terms, uniwords=rows.select("term", "doc_id"))
        lists = rows.select("term", "doc_id", "tf", "positions").join(doc_stats, "doc_id")
        return cls(spark, None, doc_stats, stats, terms, postings=stage(lists, "postings"))


def _stats_of(spark: SparkSession, path: str) -> DataFrame:
    """Corpus statistics from a file of them."""
    return read_corpus_stats(spark, path).select(
        "n_docs",
        (F.col("n_docs") * F.col("avg_len")).alias("total_len"),
        "avg_len",
        F.col("avg_len").cast("double").alias("avg_len_exact"),
    )


def build_index(
    docs: DataFrame,
    path: str,
    stop_words: StopWords = None,
    kinds: Iterable[str] = ("positional", "biword"),
    include_id_token: bool = False,
    shards: int = SHARDS,
    rows_per_file: int = ROWS_PER_FILE,
    partitions: int | None = None,
    unique_ids: bool | None = None,
    n_bad_records: int = 0,
    frequent_df: int = FREQUENT_DF,
) -> Index:
    """Index ``docs(doc_id, [title], text)`` under ``path``.

    The text is read once, into a staged table with the arrays of all kinds per
    document. All tables come from there. Term tables are laid out by ranges of
    (shard, term): files are of like size whatever the skew, sorted by term, and in
    one folder per shard; see ``file_ranges``. ``partitions`` spreads a corpus of few
    large files over more tasks first. Documents that share an id are united, all
    others stay as they are; ``unique_ids=True`` tells that there are none, and saves
    the look. Terms in at least ``frequent_df`` documents get maxima of document blocks,
    by which searches skip what cannot be a hit.
    """
    spark = docs.sparkSession
    kinds = sorted(set(kinds))
    unknown = [kind for kind in kinds if kind not in ops.ARRAY_COLUMNS]
    if unknown or not kinds:
        raise ValueError(f"kinds must be some of {sorted(ops.ARRAY_COLUMNS)}, not {unknown}")
    if partitions:
        docs = docs.repartition(partitions)
    arrays = ops.document_arrays(docs, kinds, stop_words, include_id_token)
    if "positional" in kinds:
        arrays = arrays.select("*", *ops.norm_columns())
    staged = stage(arrays, "documents")
    alone, shared = (staged, None) if unique_ids else _by_repeated_ids(staged)
    corpus_stats(staged, n_bad_records).write.parquet(f"{path}/corpus_stats")

    def write(rows: DataFrame, name: str, key: str, keys: DataFrame, schema: StructType) -> DataFrame:
        files, with_file = file_ranges(keys, key, shards, rows_per_file)
        (
            with_file(rows.withColumn("shard", shard_of(F.col(key), shards)))
            .repartitionById(files, "file")
            .drop("file")
            .sortWithinPartitions("shard", key, "doc_id")
            .write.partitionBy("shard")
            .parquet(f"{path}/{name}")
        )
        return spark.read.schema(schema).parquet(f"{path}/{name}")

    def write_dictionary(lists: DataFrame, name: str, key: str) -> None:
        # counting shuffles most pairs of words once; their rows are written where they were counted
        counted = lists.groupBy("shard", key).agg(F.count(F.lit(1)).alias("df")).select(key, "df", "shard")
        counted.sortWithinPartitions("shard", key).write.partitionBy("shard").parquet(f"{path}/{name}")

    def keys_of(column: str, key: str, field: str | None = None) -> DataFrame:
        """One row for each posting a document of its own makes; documents that share an id make no more."""
        listed = F.transform(column, lambda e: e[field]) if field else F.col(column)
        return staged.select(F.explode_outer(listed).alias(key)).where(F.col(key).isNotNull())

    def rows_of(column: str, key: str) -> DataFrame:
        rows = ops.explode_keys(alone, column, key)
        return rows if shared is None else rows.unionByName(ops.explode_keys(shared, column, key, unique_ids=False))

    lists, merged = None, None
    if "positional" in kinds:
        rows = ops.explode_entries(alone, NORMS)
        if shared is not None:
            merged = stage(ops.merge_postings(ops.explode_entries(shared)), "postings")
            norms = _with_norms(merged.select("doc_id").distinct(), merged)
            rows = rows.unionByName(merged.join(norms, "doc_id"))
        lists = postings = write(rows, "postings", "term", keys_of("entries", "term", "term"), schemas.POSTINGS)
    if "uniword" in kinds:
        lists = write(rows_of("uniwords", "term"), "uniwords", "term", keys_of("uniwords", "term"), schemas.UNIWORDS)
    if "biword" in kinds:
        pairs = write(rows_of("biwords", "biword"), "biwords", "biword", keys_of("biwords", "biword"), schemas.BIWORDS)
        write_dictionary(pairs, "biword_terms", "biword")
    if lists is not None:
        write_dictionary(lists, "terms", "term")
    _document_stats(alone, shared, merged, "positional" in kinds).write.parquet(f"{path}/doc_stats")
    bits = 0
    if "positional" in kinds:
        stats = spark.read.schema(schemas.DOC_STATS).parquet(f"{path}/doc_stats")
        terms = spark.read.schema(schemas.TERMS).parquet(f"{path}/terms")
        bits = block_bits(stats)
        maxima = block_maxima(postings, terms, bits, frequent_df).repartition("shard").sortWithinPartitions("shard", "term", "block")
        maxima.write.partitionBy("shard").parquet(f"{path}/maxima")
    meta = "shards int, kinds array<string>, block_bits int, frequent_df long"
    spark.createDataFrame([(shards, kinds, bits, frequent_df)], meta).write.parquet(f"{path}/meta")
    for table in (staged, merged):
        if table is not None:
            discard(table)
    return Index.load(spark, path)


def file_ranges(
    keys: DataFrame, key: str, shards: int, rows_per_file: int
) -> tuple[int, Callable[[DataFrame], DataFrame]]:
    """(files, with_file): the number of files, and what adds to rows(shard, <key>, doc_id) the one they belong to.

    The rows of each shard are counted by the first characters of their terms. Small
    shards share a file; a large one is cut between these, so that no file has many more
    than ``rows_per_file`` rows. Only where terms of the same first characters have more
    than that, they are counted one by one. A term with more rows than that has files of
    its own, to which its documents are dealt. Nothing is sampled.
    """
    spark = keys.sparkSession
    begin = F.substring(key, 1, FIRST_CHARACTERS)
    sharded = keys.withColumn("shard", shard_of(F.col(key), shards))
    first = stage(sharded.groupBy("shard", begin.alias(key)).agg(F.count(F.lit(1)).alias("n")), "first-characters")
    sizes = {row.shard: row.n for row in first.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    share = min(rows_per_file, max(1, -(-sum(sizes.values()) // min(shards, spark.sparkContext.defaultParallelism))))
    large = [shard for shard, n in sizes.items() if n > rows_per_file]
    cuts: dict[int, list[Row]] = {shard: [] for shard in large}
    if large:
        # first characters of more rows than a file are few, whatever the data: fewer than the files
        counted = first.where(F.col("shard").isin(large) & (F.col("n") <= rows_per_file))
        common = [(row.shard, row[key]) for row in first.where(F.col("n") > rows_per_file).collect()]
        if common:
            those = F.broadcast(spark.createDataFrame(common, "shard int, begin string"))
            single = sharded.withColumn("begin", begin).join(those, ["shard", "begin"], "left_semi")
            counted = counted.unionByName(single.groupBy("shard", key).agg(F.count(F.lit(1)).alias("n")))
        parts = F.ceil(F.col("n") / rows_per_file)
        before = F.sum("n").over(Window.partitionBy("shard").orderBy(key)) - F.col("n")
        # a range ends before the term that would begin in the next one, and around each term of several files
        ranged = counted.select("shard", key, parts.alias("parts"), F.floor(before / rows_per_file).alias("range"))
        last = Window.partitionBy("shard").orderBy(key)
        begins = (
            F.lag("range").over(last).isNull()
            | (F.lag("range").over(last) < F.col("range"))
            | (F.col("parts") > 1)
            | (F.lag("parts").over(last) > 1)
        )
        for row in ranged.select("*", begins.alias("begins")).where("begins").orderBy("shard", key).collect():
            cuts[row.shard].append(row)
    discard(first)
    files, held, layout = 0, 0, []
    for shard in range(shards):
        if shard in cuts:
            files += held > 0
            held = 0
            starts = []
            for row in cuts[shard]:
                starts.append((row[key], files, int(row.parts)))
                files += int(row.parts)
            layout.append((shard, starts))
        else:
            n = sizes.get(shard, 0)
            if held and held + n > share:
                files, held = files + 1, 0
            held += n
            layout.append((shard, [("", files, 1)]))
    files += held > 0
    ranges = spark.createDataFrame(layout, "shard int, starts array<struct<start:string,file:int,parts:int>>")

    def with_file(rows: DataFrame) -> DataFrame:
        own = F.element_at(F.filter("starts", lambda s: s.start <= F.col(key)), -1)
        found = F.when(F.size("starts") == 1, F.get("starts", F.lit(0))).otherwise(own)
        joined = rows.join(F.broadcast(ranges), "shard").withColumn("range", found)
        part = F.when(F.col("range.parts") > 1, F.pmod(F.xxhash64("doc_id"), F.col("range.parts"))).otherwise(F.lit(0))
        return joined.withColumn("file", F.col("range.file") + part.cast("int")).drop("starts", "range")

    return max(files, 1), with_file


def _by_repeated_ids(staged: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The documents whose ids are their own, and those that share one, if any."""
    repeated = stage(staged.groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        discard(repeated)
        return staged, None
    few = small_rows(repeated)
    ids = repeated if few is None else F.broadcast(local_copy(repeated, few))
    same = staged["doc_id"].eqNullSafe(ids["doc_id"])
    return staged.join(ids, same, "left_anti"), staged.join(ids, same, "left_semi")


def _document_stats(alone: DataFrame, shared: DataFrame | None, merged: DataFrame | None, with_norms: bool) -> DataFrame:
    """(doc_id, doc_len, norm, norm_reference); norms need a positional index.

    ``shared`` are the documents that share ids, ``merged`` their postings.
    """
    none = F.lit(None).cast("double")
    norms = NORMS if with_norms else [none.alias(n) for n in NORMS]
    stats = alone.select("doc_id", "doc_len", *norms)
    if shared is None:
        return stats
    lengths = shared.groupBy("doc_id").agg(F.max("doc_len").alias("doc_len"))
    united = _with_norms(lengths, merged) if with_norms else lengths.select("doc_id", "doc_len", *norms)
    return stats.unionByName(united)


def _with_norms(lengths: DataFrame, postings: DataFrame) -> DataFrame:
    """Add the norms of ``postings``; documents without postings have norm 0."""
    for variant, name in VARIANT_NORMS:
        norms = document_norms(postings, variant).withColumnRenamed("norm", name)
        lengths = lengths.join(norms, "doc_id", "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
    return lengths
