"""From documents to packed training sequences: five operators of ``lexmill.llm`` in a row.

Each stage is written as Parquet in the shared folder and read back, so that a lost
executor never sends the work further back than to the stage before.

Nulls in any column, empty texts, repeated rows and an empty table are allowed in
every stage; what each stage makes of them is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import exact_dedup, mixing, packing, simhash_dedup, tokens, toxicity
from lexmill.llm.common import staged

# Fixed values of the near-dedup stage: words in a shingle, and the bits in which linked fingerprints may differ.
SHINGLE = 3
RADIUS = 3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labelled ones, does not reject.
    A null text counts as empty; repeated rows are judged alike and stay repeated."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, a null text counting as empty: the one with the largest doc_id (null is smallest)."""
    return exact_dedup.drop_repeats(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; texts without words are one group."""
    return simhash_dedup.keep_one(docs, RADIUS, SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, repeated rows and all.
    A null source is a source of its own; documents of a source without any words are not taken."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of 2048; a null or empty text is just its end id, repeated rows are packed each."""
    return packing.pack(docs, tokens.vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Tree ensembles, fingerprints and packing are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
