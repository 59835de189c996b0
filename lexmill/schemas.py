"""Schemas of the tables the package reads and writes."""

from pyspark.sql import types as T

ARCHIVE_ENTRIES = T.StructType([
    T.StructField("zip_path", T.StringType()),
    T.StructField("entry_name", T.StringType()),
    T.StructField("content", T.BinaryType()),
])

PARSED_NEWS = T.StructType([
    T.StructField("zip_path", T.StringType()),
    T.StructField("entry_name", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("error", T.StringType()),
])

POSTINGS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("tf", T.IntegerType()),
    T.StructField("doc_len", T.IntegerType()),
    T.StructField("positions", T.ArrayType(T.IntegerType())),
    T.StructField("norm", T.DoubleType()),
    T.StructField("norm_reference", T.DoubleType()),
    T.StructField("shard", T.IntegerType()),
])

MAXIMA = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("max_tf", T.IntegerType()),
    T.StructField("min_len", T.IntegerType()),
    T.StructField("max_ratio", T.DoubleType()),
    T.StructField("shard", T.IntegerType()),
])

UNIWORDS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("shard", T.IntegerType()),
])

BIWORDS = T.StructType([
    T.StructField("biword", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("shard", T.IntegerType()),
])

TERMS = T.StructType([
    T.StructField("term", T.StringType()),
    T.StructField("df", T.LongType()),
    T.StructField("shard", T.IntegerType()),
])

BIWORD_TERMS = T.StructType([
    T.StructField("biword", T.StringType()),
    T.StructField("df", T.LongType()),
    T.StructField("shard", T.IntegerType()),
])

DOC_STATS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("doc_len", T.IntegerType()),
    T.StructField("norm", T.DoubleType()),
    T.StructField("norm_reference", T.DoubleType()),
])

CORPUS_STATS = T.StructType([
    T.StructField("n_docs", T.LongType()),
    T.StructField("total_len", T.LongType()),
    T.StructField("avg_len", T.LongType()),
    T.StructField("avg_len_exact", T.DoubleType()),
])

QUERIES = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("q", T.StringType()),
])

HIT_COLUMNS = ["query_id", "doc_id", "doc_name", "score", "rank"]
