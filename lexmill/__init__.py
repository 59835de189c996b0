"""Text indexing and search as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from lexmill.operators.bm25 import bm25
from lexmill.operators.boolean import boolean_search, malformed_queries
from lexmill.operators.hydrate import hydrate
from lexmill.operators.lookup import lookup, lookup_biwords, matched_terms
from lexmill.operators.postings import (
    biword_postings,
    document_frequency,
    positional_postings,
    uniword_postings,
)
from lexmill.operators.stats import corpus_stats, document_lengths, document_norms
from lexmill.operators.tfidf import tfidf
from lexmill.operators.tokens import tokenize
from lexmill.plans.index import Index, build_index
from lexmill.plans.search import index_archives, search
from lexmill.sinks.files import write_files
from lexmill.sinks.posting_lines import key_lines, positional_lines, write_lines
from lexmill.sinks.results import hit_lines, write_corpus_stats, write_documents, write_hits
from lexmill.sources.archives import read_zips, unzip
from lexmill.sources.lines import read_corpus_stats, read_stop_words
from lexmill.sources.news import parse_news
from lexmill.sources.posting_lines import bad_posting_lines, from_posting_lines, read_posting_lines

# Tasks that unpack archives carry their code along, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Index",
    "bad_posting_lines",
    "biword_postings",
    "bm25",
    "boolean_search",
    "build_index",
    "corpus_stats",
    "document_frequency",
    "document_lengths",
    "document_norms",
    "from_posting_lines",
    "hit_lines",
    "hydrate",
    "index_archives",
    "key_lines",
    "lookup",
    "malformed_queries",
    "lookup_biwords",
    "matched_terms",
    "parse_news",
    "positional_lines",
    "positional_postings",
    "read_corpus_stats",
    "read_posting_lines",
    "read_stop_words",
    "read_zips",
    "search",
    "tfidf",
    "tokenize",
    "uniword_postings",
    "unzip",
    "write_corpus_stats",
    "write_documents",
    "write_files",
    "write_hits",
    "write_lines",
]
