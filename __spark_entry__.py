"""

Searches run over an index of the whole ``documents`` table. The index of a kind is
built once per session and data folder, in the shared folder of ``spark.checkpoint.dir``,
as a user would build one index and search it many times.
"""

from __future__ import annotations

import dataclasses
import importlib
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lexmill as lx
from lexmill.functions.text import news_body
from lexmill.functions.weights import bm25_weight, idf_weight, tf_weight
from lexmill.operators.boolean import OPERATORS
from lexmill.operators.queries import query_terms as query_term_rows
from lexmill.session import scratch_path
from lexmill.sources.news import parse_entries

STOP_WORDS = ["the", "in", "of", "and", "to", "a", "is", "that", "it", "for", "der", "die", "la", "el"]
TERMS = ["tion", "ther", "des", "Thon", "absent-term"]
BIWORDS = ["with by", "as on", "By With", "de le"]
RANKED = ["tion ther des than", "thon thnt tion", "Ther absent-term ing ing"]
CHAIN = "tion OR ther AND des ANDNOT ing or un"
SHARDS = 8
WIDE_ID = 3_000_000_000_000

_indexes: dict[tuple[str, str], lx.Index] = {}


# --- inputs ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus. Files too small to split are spread over the cores, as tokenizing costs far
    more than reading; so are files whose row groups, which a scan does not split, leave a task
    more than twice its share of the rows. Counting those reads no column."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cores, splits = spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions()
    if splits < cores:
        return docs.repartition(cores)
    rows = [r["count"] for r in docs.groupBy(F.spark_partition_id().alias("split")).count().collect()]
    return docs.repartition(max(splits, 4 * cores)) if max(rows, default=0) * cores > 2 * sum(rows) else docs


def index(spark: SparkSession, sf_dir: str, kind: str = "positional") -> lx.Index:
    """The index of one kind. Word searches take the positional one, pair searches the one of biwords."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} {kind}")
    if key not in _indexes:
        path = scratch_path(spark, f"{kind}-index")
        _indexes[key] = lx.build_index(documents(spark, sf_dir), path, STOP_WORDS, (kind,), shards=SHARDS)
    return _indexes[key]


def whole_index(spark: SparkSession, sf_dir: str) -> lx.Index:
    """The positional index with the pairs beside it."""
    pairs = index(spark, sf_dir, "biword")
    return dataclasses.replace(index(spark, sf_dir), biwords=pairs.biwords, biword_terms=pairs.biword_terms)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("q"))


def benchmark_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark text as a Boolean chain of all its plain words, joined by AND, OR and ANDNOT in turn."""
    plain = F.split(F.regexp_replace("q", r"[^\w\s]", ""), r"\s+")
    words = F.filter(plain, lambda w: (w != "") & ~F.upper(w).isin(*OPERATORS))
    turns = F.array(*(F.lit(o) for o in OPERATORS))
    joined = F.transform("w", lambda w, i: F.when(i == 0, w).otherwise(F.concat_ws(" ", F.get(turns, (i - 1) % 3), w)))
    chains = benchmark_queries(spark, sf_dir).select("query_id", words.alias("w"))
    return chains.where(F.size("w") > 0).select("query_id", F.array_join(joined, " ").alias("q"))


def news_entries(spark: SparkSession, sf_dir: str, headlines: bool = True, first_id: int = 0) -> DataFrame:
    """The documents as news XML, with the quality label as headline, if any; else without, if so wished."""

    def element(tag: str, value: Column) -> Column:
        escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.concat(F.lit(f"<{tag}>"), escaped, F.lit(f"</{tag}>"))

    first_line = F.split_part("text", F.lit("\n"), F.lit(1))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><newsitem itemid="'),
        (F.col("doc_id") + first_id).cast("string"),
        F.lit('">'),
        element("title", first_line),
        element("headline", F.coalesce(F.col("quality").cast("string"), F.lit("none")))
        if headlines
        else F.when(F.col("quality").isNull(), F.lit("")).otherwise(element("headline", F.col("quality").cast("string"))),
        F.lit("<text>"),
        element("p", F.col("text")),
        F.lit("</text></newsitem>"),
    )
    return (
        documents(spark, sf_dir)
        .join(labels, "doc_id", "left")
        .select(
            F.lit("news.zip").alias("zip_path"),
            lx.sources.news.doc_name(F.col("doc_id") + first_id).alias("entry_name"),
            F.encode(xml, "UTF-8").alias("content"),
        )
    )


def listed(positions: str = "positions") -> Column:
    return F.array_join(F.col(positions).cast("array<string>"), ",").alias("positions")


def rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


# --- queries --------------------------------------------------------------------------------


def tokens(spark, sf_dir):
    return lx.tokenize(documents(spark, sf_dir), STOP_WORDS)


def tokens_long_stop_list(spark, sf_dir):
    """The vocabulary of the conversations as the stop list, joined if it is long."""
    talk = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "text")
    vocabulary = lx.tokenize(talk).select(F.col("raw").alias("word")).distinct()
    return lx.tokenize(documents(spark, sf_dir), vocabulary)


def positional_index(spark, sf_dir):
    postings = lx.positional_postings(documents(spark, sf_dir), STOP_WORDS, unique_ids=True)
    return postings.select("term", "doc_id", "tf", "doc_len", listed())


def positional_index_id_token(spark, sf_dir):
    postings = lx.positional_postings(documents(spark, sf_dir), STOP_WORDS, include_id_token=True, unique_ids=True)
    return postings.select("term", "doc_id", "tf", "doc_len", listed())


def positional_index_shared_ids(spark, sf_dir):
    """Conversation turns as documents: all turns of a conversation share its id."""
    talk = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "text")
    postings = lx.positional_postings(talk, STOP_WORDS, unique_ids=False)
    return postings.select("term", "doc_id", "tf", "doc_len", listed())


def saved_positional_index(spark, sf_dir):
    return index(spark, sf_dir).postings.select("term", "doc_id", "tf", "doc_len", listed())


def uniword_index(spark, sf_dir):
    return lx.uniword_postings(documents(spark, sf_dir), STOP_WORDS, unique_ids=True)


def term_df(spark, sf_dir):
    return lx.document_frequency(lx.uniword_postings(documents(spark, sf_dir), STOP_WORDS, unique_ids=True))


def saved_terms(spark, sf_dir):
    return index(spark, sf_dir).terms.select("term", "df")


def biword_index(spark, sf_dir):
    return lx.biword_postings(documents(spark, sf_dir), STOP_WORDS, unique_ids=True)


def biword_index_reference(spark, sf_dir):
    return lx.biword_postings(documents(spark, sf_dir), STOP_WORDS, include_id_token=True, unique_ids=True, variant="reference")


def biword_df(spark, sf_dir):
    return lx.document_frequency(index(spark, sf_dir, "biword").biwords, "biword")


def saved_biword_terms(spark, sf_dir):
    return index(spark, sf_dir, "biword").biword_terms.select("biword", "df")


def document_lengths(spark, sf_dir):
    return lx.document_lengths(documents(spark, sf_dir))


def corpus_stats(spark, sf_dir):
    return rounded_stats(lx.corpus_stats(lx.document_lengths(documents(spark, sf_dir))))


def corpus_stats_saved(spark, sf_dir):
    return rounded_stats(index(spark, sf_dir).corpus_stats)


def rounded_stats(stats: DataFrame) -> DataFrame:
    return stats.withColumn("avg_len_exact", F.round("avg_len_exact", 6))


def doc_norms(variant: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        norms = lx.document_norms(index(spark, sf_dir).postings, variant)
        return norms.select("doc_id", F.round("norm", 6).alias("norm"))

    return run


def doc_stats_saved(spark, sf_dir):
    return index(spark, sf_dir).doc_stats.select(
        "doc_id",
        "doc_len",
        F.round("norm", 6).alias("norm"),
        F.round("norm_reference", 6).alias("norm_reference"),
    )


def news_body_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", news_body(F.col("url"), F.col("html")).alias("body"))


def posting_weights(spark, sf_dir):
    """tf, idf and BM25 weights of every posting, both variants."""
    ix = index(spark, sf_dir)
    n, tf, df, doc_len = F.lit(ix.stats.n_docs), F.col("tf"), F.col("df"), F.col("doc_len")
    weights = {
        "tf_weight": tf_weight(tf),
        "idf_standard": idf_weight(df, n),
        "idf_reference": idf_weight(df, n, "reference"),
        "bm25_standard": bm25_weight(tf, df, doc_len, n, F.lit(ix.stats.avg_len_exact), 1.2, 0.75),
        "bm25_reference": bm25_weight(tf, df, doc_len, n, F.lit(float(ix.stats.avg_len)), 1.2, 0.75, "reference"),
    }
    return (
        ix.postings.select("shard", "term", "doc_id", "tf", "doc_len")
        .join(ix.terms, ["shard", "term"])
        .select("term", "doc_id", *(F.round(w, 6).alias(name) for name, w in weights.items()))
    )


def query_terms(spark, sf_dir):
    return query_term_rows(benchmark_queries(spark, sf_dir))


def lookup(spark, sf_dir):
    return lx.lookup(index(spark, sf_dir), TERMS)


def lookup_biwords(spark, sf_dir):
    return lx.lookup_biwords(index(spark, sf_dir, "biword"), BIWORDS)


def matched_terms(spark, sf_dir):
    return lx.matched_terms(index(spark, sf_dir), benchmark_queries(spark, sf_dir))


def boolean(query: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: lx.boolean_search(index(spark, sf_dir), query)


def boolean_batch(spark, sf_dir):
    return lx.boolean_search(index(spark, sf_dir), benchmark_chains(spark, sf_dir))


def boolean_malformed(spark, sf_dir):
    """The plain benchmark texts are no chains, but for those of one word."""
    mixed = benchmark_queries(spark, sf_dir).unionByName(benchmark_chains(spark, sf_dir))
    return lx.malformed_queries(mixed)


def lookup_uniword(spark, sf_dir):
    """Terms looked up in an index of words without positions."""
    return lx.lookup(index(spark, sf_dir, "uniword"), TERMS)


def no_hits(spark, sf_dir):
    """Terms that occur nowhere, in every mode."""
    ix, query = index(spark, sf_dir), "absent-term-one absent-term-two"
    found = [lx.search(ix, query.replace(" ", " AND ") if mode == 1 else query, mode) for mode in (1, 2, None)]
    return rounded(found[0].unionByName(found[1]).unionByName(found[2]))


def stop_word_file(spark, sf_dir):
    """Tokens without the words of a stop-word file, the source names and first words of the benchmark."""
    path = scratch_path(spark, "stop-words")
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).distinct()
    words.select("word").where("word <> ''").coalesce(1).write.text(path)
    return lx.tokenize(documents(spark, sf_dir), lx.read_stop_words(spark, path))


def stop_words_with_nulls(spark, sf_dir):
    """A stop list with a null, and with words that only trimming would make equal to tokens."""
    return lx.tokenize(documents(spark, sf_dir), [*STOP_WORDS, None, "\x0btion", " ther"])


def corpus_stats_file(spark, sf_dir):
    path = scratch_path(spark, "statistics")
    lx.write_corpus_stats(index(spark, sf_dir).corpus_stats, path)
    return lx.read_corpus_stats(spark, path)


def line_index(spark, sf_dir):
    """The index as text lines of the standard form, with its statistics, opened again."""
    key = (spark.sparkContext.applicationId, sf_dir + " lines")
    if key not in _indexes:
        ix, path, stats = index(spark, sf_dir), scratch_path(spark, "lines"), scratch_path(spark, "line-stats")
        lx.write_lines(lx.positional_lines(ix.postings, ix.terms), path, "term")
        _indexes[key] = lx.Index.from_lines(spark, path)
    return _indexes[key]


def bm25_from_lines(spark, sf_dir):
    """Documents without any term are unknown to the lines; the statistics come from the index."""
    return rounded(lx.bm25(line_index(spark, sf_dir), RANKED, stats=index(spark, sf_dir).corpus_stats))


def tfidf_from_lines(spark, sf_dir):
    n = index(spark, sf_dir).stats.n_docs
    return rounded(lx.tfidf(line_index(spark, sf_dir), RANKED, n_docs=n))


def bad_posting_lines(spark, sf_dir):
    """Texts of the benchmark among the lines of the index: they are no posting lines."""
    ix = index(spark, sf_dir)
    lines = lx.positional_lines(ix.postings, ix.terms).select("line")
    return lx.bad_posting_lines(lines.unionByName(table(spark, sf_dir, "benchmark").select(F.col("text").alias("line"))))


def news_wide_ids(spark, sf_dir):
    """News whose item ids need more than 32 bits."""
    found = lx.parse_news(news_entries(spark, sf_dir, first_id=WIDE_ID))[0]
    return found.select("doc_id", "doc_name", "headline")


def ranked(search: Callable, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(search(index(spark, sf_dir), RANKED, **options))


def ranked_batch(search: Callable, **options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(
        search(index(spark, sf_dir), benchmark_queries(spark, sf_dir), **options)
    )


def search_modes(spark, sf_dir):
    ix = index(spark, sf_dir)
    parts = [
        lx.search(ix, query, mode).withColumn("mode", F.lit(name))
        for name, mode, query in (("boolean", 1, "tion AND ther"), ("ranked", 2, RANKED[0]), ("bm25", None, RANKED[0]))
    ]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def hydrated_hits(spark, sf_dir):
    hits = lx.bm25(index(spark, sf_dir), RANKED)
    texts = documents(spark, sf_dir).withColumn("headline", F.split_part("text", F.lit("\n"), F.lit(1)))
    return lx.hydrate(hits, texts)


def hit_lines(spark, sf_dir):
    """Names of Boolean hits and ids of ranked hits, as lines."""
    ix = index(spark, sf_dir)
    names = lx.hit_lines(lx.boolean_search(ix, CHAIN), "names").withColumn("style", F.lit("names"))
    ids = lx.hit_lines(lx.tfidf(ix, RANKED), "ids").withColumn("style", F.lit("ids"))
    return names.unionByName(ids)


def hit_lines_scores(spark, sf_dir):
    """Names and scores of BM25 hits, as lines."""
    hits = rounded(lx.bm25(index(spark, sf_dir), RANKED))
    return lx.hit_lines(hits.withColumn("score", F.format_string("%.6f", "score")), "scores")


def documents_written(spark, sf_dir):
    """Documents of BM25 hits written as text files, and read again."""
    path = scratch_path(spark, "results")
    texts = documents(spark, sf_dir).withColumn("headline", F.split_part("text", F.lit("\n"), F.lit(1)))
    lx.write_documents(lx.hydrate(lx.bm25(index(spark, sf_dir), RANKED), texts), path, per_file=True)
    files = spark.read.text(f"{path}/text", wholetext=True)
    name = F.element_at(F.split("_metadata.file_path", "/"), -1)
    return files.select(name.alias("file_name"), F.col("value").alias("content"))


def biword_from_lines(spark, sf_dir):
    """Pairs looked up in a biword index kept as text lines."""
    ix, path = index(spark, sf_dir, "biword"), scratch_path(spark, "biword-lines")
    lx.write_lines(lx.key_lines(ix.biwords, ix.biword_terms, "biword"), path, "biword")
    return lx.lookup_biwords(lx.Index.from_lines(spark, path, kind="biword"), BIWORDS)


def catalog_index(spark, sf_dir):
    """BM25 over tables of the catalog, bucketed by term."""
    prefix = f"lexmill_{uuid.uuid4().hex}"
    whole_index(spark, sf_dir).save_tables(prefix, SHARDS)
    return rounded(lx.bm25(lx.Index.from_tables(spark, prefix), RANKED))


def saved_shared_ids(spark, sf_dir):
    """The postings of an index in which two documents share an id, and all others have their own."""
    docs = documents(spark, sf_dir).withColumn("doc_id", F.when(F.col("doc_id") == 1, 0).otherwise(F.col("doc_id")))
    ix = lx.build_index(docs, scratch_path(spark, "shared-index"), STOP_WORDS, ("positional",), shards=SHARDS)
    return ix.postings.select("term", "doc_id", "tf", "doc_len", listed())


def boolean_long_chain(spark, sf_dir):
    """One chain of every word of the benchmark: thousands of slots."""
    words = benchmark_chains(spark, sf_dir).orderBy("query_id")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("query_id", "q"))), lambda r: r.q), " OR ")
    return lx.boolean_search(index(spark, sf_dir), words.groupBy().agg(F.lit(0).cast("long").alias("query_id"), joined.alias("q")))


def positional_lines(spark, sf_dir):
    ix = index(spark, sf_dir)
    return lx.positional_lines(ix.postings, ix.terms, "reference").select("term", "line")


def positional_lines_parts(spark, sf_dir):
    """Lines of at most 50 postings: successive parts of each term's sorted list."""
    ix = index(spark, sf_dir)
    return lx.positional_lines(ix.postings, ix.terms, "reference", per_line=50)


def uniword_lines(spark, sf_dir):
    ix = index(spark, sf_dir)
    return lx.key_lines(ix.postings.select("term", "doc_id"), ix.terms).select("term", "line")


def biword_lines(spark, sf_dir):
    ix = index(spark, sf_dir, "biword")
    return lx.key_lines(ix.biwords, ix.biword_terms, "biword").select("biword", "line")


def posting_lines_round_trip(spark, sf_dir):
    """Lines of at most about 50 postings, decoded again."""
    ix = index(spark, sf_dir)
    lines = lx.positional_lines(ix.postings, ix.terms, per_line=50)
    return lx.from_posting_lines(lines).select("term", "df", "doc_id", "tf", "doc_len", listed())


def news_from_zips(spark, sf_dir):
    """News entries packed into archives, one per batch, and read back."""

    def zip_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, content in zip(batch["entry_name"], batch["content"]):
                    archive.writestr(name, bytes(content))
            yield pd.DataFrame({"path": ["news.zip"], "content": [buffer.getvalue()]})

    archives = news_entries(spark, sf_dir).mapInPandas(zip_entries, "path string, content binary")
    return lx.parse_news(lx.unzip(archives))[0]


def archive_files(spark: SparkSession, sf_dir: str, headlines: bool = True, cut: bool = False) -> str:
    """The folder of news archives, one for every 50 ids, streamed with 64-bit sizes; cut short inside the last entry, if so wished."""

    def zip_up(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for row in batch.sort_values("doc_id").itertuples():
                with archive.open(row.entry_name, "w", force_zip64=True) as entry:
                    entry.write(bytes(row.content))
                last = archive.infolist()[-1].header_offset
        content = buffer.getvalue()
        return pd.DataFrame({"name": [f"part-{key[0]}/news.zip"], "content": [content[: last + 45] if cut else content]})

    path = scratch_path(spark, "archives")
    doc_id = F.regexp_extract("entry_name", r"^(\d+)", 1).cast("long")
    entries = news_entries(spark, sf_dir, headlines).select(doc_id.alias("doc_id"), "entry_name", "content")
    batches = entries.groupBy(F.floor(F.col("doc_id") / 50).alias("batch"))
    lx.write_files(batches.applyInPandas(zip_up, "name string, content binary"), path)
    return path


def zip_strict_zip64(spark, sf_dir):
    """News read strictly, by ranges of entries, from archives on disk."""
    return lx.parse_news(lx.read_zips(spark, archive_files(spark, sf_dir)))[0]


def zip_lenient_cut(spark, sf_dir):
    """Archives that end inside their last entry give the entries before it."""
    return lx.parse_news(lx.read_zips(spark, archive_files(spark, sf_dir, cut=True), lenient=True))[0]


def archive_corpus_stats(spark, sf_dir):
    """Statistics of an index built from archives; entries without a headline are bad records, which count in N."""
    ix, _, _ = lx.index_archives(spark, archive_files(spark, sf_dir, headlines=False), scratch_path(spark, "news-index"), STOP_WORDS)
    return rounded_stats(ix.corpus_stats)


def news_bad_records(spark, sf_dir):
    """Documents without a label have no headline here, and become bad records."""
    bad = parse_entries(news_entries(spark, sf_dir, headlines=False)).where(F.col("error").isNotNull())
    return bad.select("entry_name", "error")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: BM25 hits of several queries over the indexed corpus."""
    return lx.bm25(index(spark, "/root/testdata/sf0.001"), RANKED)


# What may have been left out: the operators for training data, and the pipeline over them.
OPTIONAL = ("lexmill.llm", "corpus_pipeline")


def optional(module: str):
    """A module, or None if it or the operators it builds on were left out; anything else it needs must be there."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as error:
        if error.name not in OPTIONAL:
            raise
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = search_queries()
    if llm := optional("lexmill.llm.queries"):
        found |= llm.QUERIES
    if pipeline := optional("corpus_pipeline"):
        found["pipeline"] = pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = search_sql()
    if llm := optional("lexmill.llm.queries"):
        found |= llm.SQL
    if (pipeline := optional("corpus_pipeline")) and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def search_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "tokens": tokens,
        "tokens_long_stop_list": tokens_long_stop_list,
        "document_lengths": document_lengths,
        "news_body_pages": news_body_pages,
        "news_from_zips": news_from_zips,
        "news_bad_records": news_bad_records,
        "zip_strict_zip64": zip_strict_zip64,
        "zip_lenient_cut": zip_lenient_cut,
        "archive_corpus_stats": archive_corpus_stats,
        "positional_index": positional_index,
        "positional_index_id_token": positional_index_id_token,
        "positional_index_shared_ids": positional_index_shared_ids,
        "saved_positional_index": saved_positional_index,
        "uniword_index": uniword_index,
        "term_df": term_df,
        "saved_terms": saved_terms,
        "biword_index": biword_index,
        "biword_index_reference": biword_index_reference,
        "biword_df": biword_df,
        "corpus_stats": corpus_stats,
        "corpus_stats_saved": corpus_stats_saved,
        "doc_norms_standard": doc_norms("standard"),
        "doc_norms_reference": doc_norms("reference"),
        "doc_stats_saved": doc_stats_saved,
        "posting_weights": posting_weights,
        "query_terms": query_terms,
        "lookup": lookup,
        "lookup_biwords": lookup_biwords,
        "matched_terms": matched_terms,
        "boolean_and": boolean("tion AND ther"),
        "boolean_or": boolean("tion OR des"),
        "boolean_andnot": boolean("Ther ANDNOT tion"),
        "boolean_single": boolean("ther"),
        "boolean_chain": boolean(CHAIN),
        "boolean_batch": boolean_batch,
        "boolean_malformed": boolean_malformed,
        "lookup_uniword": lookup_uniword,
        "no_hits": no_hits,
        "stop_word_file": stop_word_file,
        "stop_words_with_nulls": stop_words_with_nulls,
        "corpus_stats_file": corpus_stats_file,
        "saved_biword_terms": saved_biword_terms,
        "bm25_from_lines": bm25_from_lines,
        "tfidf_from_lines": tfidf_from_lines,
        "bad_posting_lines": bad_posting_lines,
        "news_wide_ids": news_wide_ids,
        "bm25_standard": ranked(lx.bm25),
        "bm25_reference": ranked(lx.bm25, match="exact", variant="reference"),
        "bm25_substring": ranked(lx.bm25, match="substring", k1=1.5, b=0.5),
        "bm25_substring_reference": ranked(lx.bm25, variant="reference"),
        "bm25_all_hits": ranked(lx.bm25, k=0),
        "bm25_batch": ranked_batch(lx.bm25, k=10),
        "bm25_substring_batch": ranked_batch(lx.bm25, k=10, match="substring"),
        "tfidf_standard": ranked(lx.tfidf),
        "tfidf_reference": ranked(lx.tfidf, variant="reference", n_docs=806791),
        "tfidf_batch": ranked_batch(lx.tfidf, k=10),
        "search_modes": search_modes,
        "hydrated_hits": hydrated_hits,
        "hit_lines": hit_lines,
        "hit_lines_scores": hit_lines_scores,
        "documents_written": documents_written,
        "biword_from_lines": biword_from_lines,
        "catalog_index": catalog_index,
        "saved_shared_ids": saved_shared_ids,
        "boolean_long_chain": boolean_long_chain,
        "positional_lines": positional_lines,
        "positional_lines_parts": positional_lines_parts,
        "uniword_lines": uniword_lines,
        "biword_lines": biword_lines,
        "posting_lines_round_trip": posting_lines_round_trip,
    }


# --- SQL twins ------------------------------------------------------------------------------


def _strings(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _corpus(source: str = "documents", doc_id: str = "doc_id", body: str = "lower(text)", stops: str | None = None) -> str:
    """CTEs b (lengths), e (word tokens), tok (kept tokens), post, df, st."""
    stops = _strings(STOP_WORDS) if stops is None else stops
    return rf"""
      a AS (SELECT {doc_id} AS doc_id, list_filter(regexp_split_to_array({body}, '[ \t\n!,"]+'), lambda x: x <> '') AS r
            FROM {source}),
      b AS (SELECT doc_id, len(r)::integer AS doc_len, list_filter(r, lambda x: regexp_matches(x, '\w')) AS w FROM a),
      e AS (SELECT doc_id, doc_len, unnest(w) AS raw, generate_subscripts(w, 1)::integer AS pos FROM b),
      tok AS (SELECT doc_id, doc_len, pos, raw,
                     translate(regexp_replace(raw, ',?:?\.?\z', ''), '[](){{}}''', '') AS term
              FROM e WHERE raw NOT IN ({stops})),
      post AS (SELECT term, doc_id, count(*)::integer AS tf, max(doc_len)::integer AS doc_len,
                      string_agg(pos::varchar, ',' ORDER BY pos) AS positions
               FROM tok GROUP BY term, doc_id),
      df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
      st AS (SELECT count(*) AS n_docs, sum(doc_len)::bigint AS total_len,
                    (sum(doc_len) // count(*))::bigint AS avg_len, sum(doc_len)::double / count(*) AS avg_len_exact
             FROM b)"""


_NEXT = "SELECT doc_id, term || ' ' || lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS biword FROM tok"
_BIWORDS = f"bi AS (SELECT DISTINCT biword, doc_id FROM ({_NEXT}) WHERE biword IS NOT NULL)"
_RANKED_QUERIES = (
    "q AS (SELECT * FROM (VALUES " + ", ".join(f"({i}::bigint, '{q}')" for i, q in enumerate(RANKED)) + ") t(query_id, q))"
)
_BENCHMARK = "q AS (SELECT item_id AS query_id, text AS q FROM benchmark)"
_QUERY_TERMS = r"""
      qp AS (SELECT query_id, list_filter(regexp_split_to_array(lower(q), '\s+'), lambda x: x <> '') AS p FROM q),
      qr AS (SELECT query_id, unnest(p) AS term, (generate_subscripts(p, 1) - 1)::integer AS slot FROM qp),
      qt AS (SELECT query_id, term, count(*) AS n FROM qr GROUP BY query_id, term)"""
_NORMS = """
      norms AS (SELECT doc_id, sqrt(sum((1 + log10(tf)) * (1 + log10(tf)))) AS norm,
                       sqrt(sum(1 + log10(tf))) AS norm_reference
                FROM post GROUP BY doc_id)"""
_NAME = "doc_id::varchar || 'newsML.xml'"


def _idf_reference(freq: str, n: str) -> str:
    return f"CASE WHEN {n} // {freq} < 1 THEN '-infinity'::double ELSE log10({n} // {freq}) END"


def _bm25_weight(variant: str, k1: float = 1.2, b: float = 0.75) -> str:
    if variant == "standard":
        return (
            f"log10(n_docs / df) * (({k1} + 1) * tf::double"
            f" / ({k1} * ((1 - {b}) + {b} * (doc_len / avg_len_exact)) + tf))"
        )
    return (
        f"({_idf_reference('tf', 'n_docs')}) * (({k1} + 1) * tf::double"
        f" / ({k1} * ((1 - {b}) + {b} * ((CASE WHEN tf = 1 THEN 0 ELSE doc_len END) // avg_len)) + tf))"
    )


def _bm25(
    query: str = _RANKED_QUERIES, k: int = 50, match: str = "exact", variant: str = "standard", k1=1.2, b=0.75
) -> str:
    on = "d.term = t.term" if match == "exact" else "contains(d.term, t.term)"
    keep, ties = "TRUE", "doc_id"
    if variant == "reference":
        keep, ties = "score = 0 OR score >= 0.001", "doc_id::varchar"
    rank = f"(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, {ties}))::integer" if k else "NULL::integer"
    cut = f"WHERE rank <= {k}" if k else ""
    return f"""
      WITH {_corpus()}, {query}, {_QUERY_TERMS},
      pt AS (SELECT t.term AS part, d.term, d.df FROM (SELECT DISTINCT term FROM qt) t JOIN df d ON {on}),
      s AS (SELECT query_id, p.doc_id, round(sum(n * {_bm25_weight(variant, k1, b)}), 9) AS score
            FROM qt JOIN pt ON qt.term = pt.part JOIN post p ON p.term = pt.term CROSS JOIN st
            GROUP BY query_id, p.doc_id)
      SELECT query_id, doc_id, doc_name, round(score, 6) AS score, rank
      FROM (SELECT query_id, doc_id, {_NAME} AS doc_name, score, {rank} AS rank FROM s WHERE {keep}) {cut}"""


def _tfidf(query: str = _RANKED_QUERIES, k: int = 20, variant: str = "standard", n_docs: str = "n_docs") -> str:
    idf = f"log10({n_docs} / df)" if variant == "standard" else _idf_reference("df", n_docs)
    weight = f"(1 + log10(tf)) * ({idf})"
    if variant == "standard":
        scores = f"""
      s AS (SELECT query_id, doc_id, round(sum({weight}) / any_value(norm), 12) AS score
            FROM w GROUP BY query_id, doc_id)"""
    else:
        scores = f"""
      x AS (SELECT query_id, doc_id, round(sum({weight}) / any_value(norm_reference), 12) AS score
            FROM w GROUP BY query_id, doc_id),
      s AS (SELECT query_id, score, max(doc_id) AS doc_id FROM x GROUP BY query_id, score)"""
    return f"""
      WITH {_corpus()}, {query}, {_QUERY_TERMS}, {_NORMS},
      w AS (SELECT query_id, doc_id, term, tf, df, norm, norm_reference, n_docs
            FROM qt JOIN df USING (term) JOIN post USING (term) JOIN norms USING (doc_id) CROSS JOIN st),
      {scores}
      SELECT query_id, doc_id, doc_name, round(score, 6) AS score, rank
      FROM (SELECT query_id, doc_id, {_NAME} AS doc_name, score,
                   (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id))::integer AS rank FROM s)
      WHERE rank <= {k}"""


def _docs_of(term: str) -> str:
    return f"SELECT doc_id FROM post WHERE term = '{term.lower()}'"


def _boolean(query: str) -> str:
    """Set operations, nested from left to right."""
    parts = query.split()
    words = {"AND": "INTERSECT", "OR": "UNION", "ANDNOT": "EXCEPT"}
    sets = _docs_of(parts[0])
    for operator, term in zip(parts[1::2], parts[2::2]):
        sets = f"SELECT doc_id FROM ({sets}) {words[operator.upper()]} ({_docs_of(term)})"
    return f"WITH {_corpus()} SELECT DISTINCT 0::bigint AS query_id, doc_id, {_NAME} AS doc_name FROM ({sets})"


_BENCHMARK_CHAINS = r"""
      qw AS (SELECT item_id AS query_id,
                    list_filter(regexp_split_to_array(lower(regexp_replace(text, '[^\w\s]', '', 'g')), '\s+'),
                                lambda x: x NOT IN ('', 'and', 'or', 'andnot')) AS w FROM benchmark),
      qs AS (SELECT query_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS slot FROM qw),
      ands AS (SELECT query_id, list(slot) AS slots FROM qs WHERE slot % 3 = 1 GROUP BY query_id),
      m AS (SELECT query_id, doc_id, list(slot) AS held,
                   coalesce(max(slot) FILTER (slot = 0 OR slot % 3 = 2), -1) AS decides_in,
                   coalesce(max(slot) FILTER (slot > 0 AND slot % 3 = 0), -1) AS held_out
            FROM qs JOIN post USING (term) GROUP BY query_id, doc_id)"""


def _positional_line(per_line: int | None = None) -> str:
    head = "doc_id || ':' || tf || ':' || (CASE WHEN tf = 1 THEN 0 ELSE doc_len END)"
    posting = f"{head} || '<' || replace(positions, ',', ', ') || '>; '"
    parts = f""",
      n AS (SELECT *, count(*) OVER (PARTITION BY term) AS df,
                   (row_number() OVER (PARTITION BY term ORDER BY posting) - 1) // {per_line} AS part FROM p)
      SELECT term, part, term || ':' || any_value(df) || chr(9) || string_agg(posting, '' ORDER BY posting) AS line
      FROM n GROUP BY term, part"""
    if per_line:
        return f"WITH {_corpus()}, p AS (SELECT term, {posting} AS posting FROM post){parts}"
    return f"""
      WITH {_corpus()}, p AS (SELECT term, {posting} AS posting FROM post)
      SELECT term, term || ':' || count(*) || chr(9) || string_agg(posting, '' ORDER BY posting) AS line
      FROM p GROUP BY term"""


def _key_line(rows: str, key: str) -> str:
    return f"""SELECT {key}, {key} || ':' || count(*) || chr(9)
                      || string_agg(doc_id::varchar, '; ' ORDER BY doc_id::varchar) AS line
               FROM {rows} GROUP BY {key}"""


_POST = "SELECT term, doc_id, tf, doc_len, positions FROM post"
_STATS = "SELECT n_docs, total_len, avg_len, round(avg_len_exact, 6) AS avg_len_exact FROM st"
_FIRST_LINE = "split_part(text, chr(10), 1)"
_NEWS_BODY = r"""lower(replace(trim(split_part(text, chr(10), 1), E' \t\n\r'), '"', '') || ' '
                          || replace(trim(text, E' \t\n\r'), '"', ''))"""
_ID_TOKEN = "'itemid_' || doc_id || ' ' || lower(text)"
_VOCABULARY = r"""SELECT unnest(list_filter(regexp_split_to_array(lower(text), '[ \t\n!,"]+'),
                                            lambda x: regexp_matches(x, '\w'))) FROM conversations"""
_ON_BLANKS = rf"""
      a AS (SELECT doc_id, list_filter(string_split({_ID_TOKEN}, ' '),
                   lambda x: regexp_matches(x, '\w') AND NOT contains(x, chr(10))) AS w FROM documents),
      e AS (SELECT doc_id, unnest(w) AS raw, generate_subscripts(w, 1) AS pos FROM a),
      tok AS (SELECT doc_id, pos, translate(regexp_replace(trim(raw, chr(9)),
                     '[\x00-\x20]*(?:,[\x00-\x20]*)?(?::[\x00-\x20]*)?(?:\.[\x00-\x20]*)?\z', ''), '[](){{}}''', '') AS term
              FROM e WHERE trim(raw, chr(9)) NOT IN ({_strings(STOP_WORDS)}))"""


def _with_mode(sql: str, mode: str) -> str:
    return f"SELECT query_id, doc_id, doc_name, score, rank, '{mode}' AS mode FROM ({sql})"


def _shared_ids(source: str, doc_id: str, united: str) -> str:
    return f"""
      WITH {_corpus(source=source, doc_id=doc_id)},
      p AS (SELECT term, {united} AS doc_id, doc_len, unnest(string_split(positions, ','))::integer AS pos
            FROM post)
      SELECT term, doc_id, count(*)::integer AS tf, max(doc_len) AS doc_len,
             string_agg(pos::varchar, ',' ORDER BY pos) AS positions
      FROM p GROUP BY term, doc_id"""


def search_sql() -> dict[str, str]:
    hits = _bm25()
    return {
        "tokens": f"WITH {_corpus()} SELECT doc_id, doc_len, pos, raw, term FROM tok",
        "tokens_long_stop_list": f"WITH {_corpus(stops=_VOCABULARY)} SELECT doc_id, doc_len, pos, raw, term FROM tok",
        "document_lengths": f"WITH {_corpus()} SELECT doc_id, doc_len FROM b",
        "news_body_pages": r"""
          SELECT page_id, lower(replace(trim(url, E' \t\n\r'), '"', '') || ' '
                                || replace(trim(html, E' \t\n\r'), '"', '')) AS body FROM pages""",
        "news_from_zips": f"""
          SELECT doc_id, {_NAME} AS doc_name, {_FIRST_LINE} AS title, coalesce(quality::varchar, 'none') AS headline, text
          FROM documents LEFT JOIN labels USING (doc_id)""",
        "zip_strict_zip64": f"""
          SELECT doc_id, {_NAME} AS doc_name, {_FIRST_LINE} AS title, coalesce(quality::varchar, 'none') AS headline, text
          FROM documents LEFT JOIN labels USING (doc_id)""",
        "zip_lenient_cut": f"""
          SELECT doc_id, {_NAME} AS doc_name, {_FIRST_LINE} AS title, coalesce(quality::varchar, 'none') AS headline, text
          FROM documents LEFT JOIN labels USING (doc_id)
          WHERE doc_id NOT IN (SELECT max(doc_id) FROM documents GROUP BY doc_id // 50)""",
        "archive_corpus_stats": rf"""
          WITH {_corpus(source="good", body=_NEWS_BODY)},
          g AS (SELECT (SELECT count(*) FROM documents) AS n_docs, coalesce(sum(doc_len), 0)::bigint AS total_len FROM b)
          SELECT n_docs, total_len, (total_len // n_docs)::bigint AS avg_len, round(total_len::double / n_docs, 6) AS avg_len_exact
          FROM g""".replace("WITH", "WITH good AS (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),", 1),
        "news_bad_records": f"""
          SELECT {_NAME} AS entry_name, 'missing headline' AS error
          FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "positional_index": f"WITH {_corpus()} {_POST}",
        "positional_index_id_token": f"WITH {_corpus(body=_ID_TOKEN)} {_POST}",
        "positional_index_shared_ids": _shared_ids("conversations", "conv_id * 100000 + turn", "doc_id // 100000"),
        "saved_shared_ids": _shared_ids("documents", "doc_id", "CASE WHEN doc_id = 1 THEN 0 ELSE doc_id END"),
        "saved_positional_index": f"WITH {_corpus()} {_POST}",
        "uniword_index": f"WITH {_corpus()} SELECT DISTINCT term, doc_id FROM tok",
        "term_df": f"WITH {_corpus()} SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term",
        "saved_terms": f"WITH {_corpus()} SELECT term, df FROM df",
        "biword_index": f"WITH {_corpus()}, {_BIWORDS} SELECT biword, doc_id FROM bi",
        "biword_index_reference": f"WITH {_ON_BLANKS}, {_BIWORDS} SELECT biword, doc_id FROM bi",
        "biword_df": f"WITH {_corpus()}, {_BIWORDS} SELECT biword, count(*) AS df FROM bi GROUP BY biword",
        "corpus_stats": f"WITH {_corpus()} {_STATS}",
        "corpus_stats_saved": f"WITH {_corpus()} {_STATS}",
        "doc_norms_standard": f"WITH {_corpus()}, {_NORMS} SELECT doc_id, round(norm, 6) AS norm FROM norms",
        "doc_norms_reference": f"WITH {_corpus()}, {_NORMS} SELECT doc_id, round(norm_reference, 6) AS norm FROM norms",
        "doc_stats_saved": f"""
          WITH {_corpus()}, {_NORMS}
          SELECT doc_id, doc_len, round(coalesce(norm, 0), 6) AS norm,
                 round(coalesce(norm_reference, 0), 6) AS norm_reference
          FROM b LEFT JOIN norms USING (doc_id)""",
        "posting_weights": f"""
          WITH {_corpus()}
          SELECT term, doc_id, round(1 + log10(tf), 6) AS tf_weight, round(log10(n_docs / df), 6) AS idf_standard,
                 round({_idf_reference('df', 'n_docs')}, 6) AS idf_reference,
                 round({_bm25_weight('standard')}, 6) AS bm25_standard,
                 round({_bm25_weight('reference')}, 6) AS bm25_reference
          FROM post JOIN df USING (term) CROSS JOIN st""",
        "query_terms": f"WITH {_BENCHMARK}, {_QUERY_TERMS} SELECT query_id, slot, term FROM qr",
        "lookup": f"""
          WITH {_corpus()} SELECT term, df, doc_id, tf, doc_len FROM post JOIN df USING (term)
          WHERE term IN ({_strings([t.lower() for t in TERMS])})""",
        "lookup_biwords": f"""
          WITH {_corpus()}, {_BIWORDS}
          SELECT biword, count(*) OVER (PARTITION BY biword) AS df, doc_id FROM bi
          WHERE biword IN ({_strings([t.lower() for t in BIWORDS])})""",
        "matched_terms": f"""
          WITH {_corpus()}, {_BENCHMARK}, {_QUERY_TERMS}
          SELECT query_id, count(*) AS n_matched FROM qt JOIN df USING (term) GROUP BY query_id""",
        "boolean_and": _boolean("tion AND ther"),
        "boolean_or": _boolean("tion OR des"),
        "boolean_andnot": _boolean("Ther ANDNOT tion"),
        "boolean_single": _boolean("ther"),
        "boolean_chain": _boolean(CHAIN),
        "boolean_batch": f"""
          WITH {_corpus()}, {_BENCHMARK_CHAINS}
          SELECT query_id, doc_id, {_NAME} AS doc_name FROM m LEFT JOIN ands USING (query_id)
          WHERE decides_in > greatest(held_out,
                                      coalesce(list_max(list_filter(slots, lambda s: NOT list_contains(held, s))), -1))""",
        "boolean_malformed": r"""
          SELECT item_id AS query_id, text AS q FROM benchmark
          WHERE len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) > 1""",
        "lookup_uniword": f"""
          WITH {_corpus()} SELECT term, df, doc_id, NULL::integer AS tf, NULL::integer AS doc_len
          FROM post JOIN df USING (term) WHERE term IN ({_strings([t.lower() for t in TERMS])})""",
        "no_hits": """
          SELECT doc_id AS query_id, doc_id, text AS doc_name, 0.0::double AS score, 0::integer AS rank
          FROM documents WHERE false""",
        "stop_word_file": f"""
          WITH {_corpus(stops="SELECT unnest(regexp_split_to_array(lower(text), '[ " + "\\t\\n\\r]+')) FROM benchmark")}
          SELECT doc_id, doc_len, pos, raw, term FROM tok""",
        "stop_words_with_nulls": f"WITH {_corpus()} SELECT doc_id, doc_len, pos, raw, term FROM tok",
        "corpus_stats_file": f"WITH {_corpus()} SELECT n_docs, avg_len FROM st",
        "saved_biword_terms": f"WITH {_corpus()}, {_BIWORDS} SELECT biword, count(*) AS df FROM bi GROUP BY biword",
        "bm25_from_lines": hits,
        "tfidf_from_lines": _tfidf(),
        "bad_posting_lines": "SELECT text AS line FROM benchmark",
        "news_wide_ids": f"""
          SELECT doc_id + {WIDE_ID} AS doc_id, (doc_id + {WIDE_ID})::varchar || 'newsML.xml' AS doc_name,
                 coalesce(quality::varchar, 'none') AS headline
          FROM documents LEFT JOIN labels USING (doc_id)""",
        "bm25_standard": hits,
        "bm25_reference": _bm25(k=51, variant="reference"),
        "bm25_substring": _bm25(match="substring", k1=1.5, b=0.5),
        "bm25_substring_reference": _bm25(k=51, match="substring", variant="reference"),
        "bm25_all_hits": _bm25(k=0),
        "bm25_batch": _bm25(_BENCHMARK, k=10),
        "bm25_substring_batch": _bm25(_BENCHMARK, k=10, match="substring"),
        "tfidf_standard": _tfidf(),
        "tfidf_reference": _tfidf(k=21, variant="reference", n_docs="806791"),
        "tfidf_batch": _tfidf(_BENCHMARK, k=10),
        "search_modes": " UNION ALL ".join(
            [
                _with_mode(
                    f"SELECT *, NULL::double AS score, NULL::integer AS rank FROM ({_boolean('tion AND ther')})", "boolean"
                ),
                f"SELECT * FROM ({_with_mode(_tfidf(), 'ranked')}) WHERE query_id = 0",
                f"SELECT * FROM ({_with_mode(hits, 'bm25')}) WHERE query_id = 0",
            ]
        ),
        "hydrated_hits": f"""
          SELECT query_id, rank, score, h.doc_id, doc_name, replace(doc_name, 'xml', 'txt') AS file_name,
                 {_FIRST_LINE} AS headline, text, replace(doc_name, 'xml', 'txt') || ';' || {_FIRST_LINE} AS manifest
          FROM ({hits}) h JOIN documents d ON h.doc_id = d.doc_id""",
        "hit_lines": f"""
          SELECT query_id, doc_id, NULL::integer AS rank, doc_name AS line, 'names' AS style FROM ({_boolean(CHAIN)})
          UNION ALL
          SELECT query_id, doc_id, rank, doc_id::varchar AS line, 'ids' AS style FROM ({_tfidf()})""",
        "hit_lines_scores": f"""
          SELECT query_id, doc_id, rank, doc_name || chr(9) || format('{{:.6f}}', score) AS line FROM ({hits})""",
        "documents_written": f"""
          SELECT DISTINCT replace(doc_name, 'xml', 'txt') AS file_name,
                 {_FIRST_LINE} || chr(10) || chr(10) || text AS content
          FROM ({hits}) h JOIN documents d ON h.doc_id = d.doc_id""",
        "biword_from_lines": f"""
          WITH {_corpus()}, {_BIWORDS}
          SELECT biword, count(*) OVER (PARTITION BY biword) AS df, doc_id FROM bi
          WHERE biword IN ({_strings([t.lower() for t in BIWORDS])})""",
        "catalog_index": hits,
        "boolean_long_chain": f"""
          WITH {_corpus()},
          qw AS (SELECT item_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS slot
                 FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(regexp_replace(text, '[^\\w\\s]', '', 'g')), '\\s+'),
                                                   lambda x: x NOT IN ('', 'and', 'or', 'andnot')) AS w FROM benchmark)),
          qs AS (SELECT term, CASE WHEN slot = 0 OR slot % 3 = 2 THEN 'OR' WHEN slot % 3 = 1 THEN 'AND' ELSE 'ANDNOT' END AS op,
                        row_number() OVER (ORDER BY item_id, slot) AS slot FROM qw),
          ands AS (SELECT list(slot) AS slots FROM qs WHERE op = 'AND'),
          m AS (SELECT doc_id, list(slot) AS held, coalesce(max(slot) FILTER (op = 'OR'), -1) AS decides_in,
                       coalesce(max(slot) FILTER (op = 'ANDNOT'), -1) AS held_out
                FROM qs JOIN post USING (term) GROUP BY doc_id)
          SELECT 0::bigint AS query_id, doc_id, {_NAME} AS doc_name FROM m, ands
          WHERE decides_in > held_out
            AND decides_in > coalesce(list_max(list_filter(slots, lambda s: s > decides_in AND NOT list_contains(held, s))), -1)""",
        "positional_lines": _positional_line(),
        "positional_lines_parts": _positional_line(50),
        "uniword_lines": f"WITH {_corpus()} {_key_line('post', 'term')}",
        "biword_lines": f"WITH {_corpus()}, {_BIWORDS} {_key_line('bi', 'biword')}",
        "posting_lines_round_trip": f"""
          WITH {_corpus()} SELECT term, df, doc_id, tf, doc_len, positions FROM post JOIN df USING (term)""",
    }
