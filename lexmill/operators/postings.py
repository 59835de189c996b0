"""Inverted indexes as rows: uniword, biword and positional postings.

Postings are one row per (term, document), never one array per term, so a term
that occurs in a third of all documents is just many rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as txt
from lexmill.functions.text import normalized
from lexmill.functions.weights import tf_weight
from lexmill.operators.tokens import StopWords, document_body, inline_stop_words, kept_words, term_arrays


def with_entries(terms: DataFrame) -> DataFrame:
    """Add ``entries``: array<struct<term, tf, positions>> of each document.

    Sorting a document's (term, pos) pairs puts equal terms side by side; the
    places where the term changes bound the runs.
    """
    size = F.size("s")
    starts = F.array_compact(
        F.transform("s", lambda x, i: F.when((i == 0) | (x.term != F.get("s", i - 1).term), i))
    )
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(size))

    def entry(start: Column, end: Column) -> Column:
        run = F.slice("s", start + 1, end - start)
        return F.struct(
            F.get("s", start).term.alias("term"),
            (end - start).alias("tf"),
            F.transform(run, lambda x: x.pos).alias("positions"),
        )

    return (
        terms.select("*", F.sort_array("terms").alias("s"))
        .select("*", starts.alias("starts"))
        .select("*", ends.alias("ends"))
        .select(
            *terms.columns,
            F.when(size == 0, F.expr("array()")).otherwise(F.zip_with("starts", "ends", entry)).alias("entries"),
        )
    )


# The array column of each index kind, and its type.
ARRAY_COLUMNS = {"positional": "entries", "uniword": "uniwords", "biword": "biwords"}
ARRAY_TYPES = {
    "positional": "array<struct<term:string,tf:int,positions:array<int>>>",
    "uniword": "array<string>",
    "biword": "array<string>",
}

# Tokens that are turned into arrays at once.
CHUNK_TOKENS = 500_000

# Distinct tokens a task remembers before it starts anew (some 100 MB).
REMEMBERED = 500_000

# In place of a term's number: a token that is no word, and a stop word, which takes up a position.
NO_WORD, STOP_WORD = -2, -1


class TermNumbers(dict):
    """The number of each raw token's term; ``terms`` has the terms by number."""

    def __init__(self, stop_words: list[str]):
        super().__init__()
        self.stop_words = frozenset(stop_words)
        self.numbers: dict[str, int] = {}
        self.terms: list[str] = []
        self.is_word = re.compile(txt.WORD_CHAR, re.ASCII).search
        self.has_line_end = re.compile(txt.LINE_TERMINATOR).search
        self.normalized = txt.normalizer()

    def __missing__(self, raw: str) -> int:
        if not self.is_word(raw) or self.has_line_end(raw):
            number = NO_WORD
        elif raw.strip(txt.TRIMMED_CHARS) in self.stop_words:
            number = STOP_WORD
        else:
            term = self.normalized(raw)
            number = self.numbers.setdefault(term, len(self.terms))
            if number == len(self.terms):
                self.terms.append(term)
        self[raw] = number
        return number


def document_arrays(docs: DataFrame, kinds: Iterable[str], stop_words: StopWords = None, include_id_token: bool = False) -> DataFrame:
    """``kind_arrays`` of the ``kept_words`` of documents.

    With a short stop list, texts are cut in the Arrow batches, and whether a token is a word,
    a stop word, and what its term is, is found once for each distinct token of a task.
    """
    if stop_words is not None and not isinstance(stop_words, DataFrame):
        stop_words = list(stop_words)
    inline = inline_stop_words(stop_words)
    if inline is None:
        return kind_arrays(kept_words(docs, stop_words, include_id_token), kinds)
    kinds = [kind for kind in ARRAY_COLUMNS if kind in set(kinds)]
    body = document_body(docs)
    if include_id_token:
        body = txt.with_id_token(body, F.col("doc_id"))
    names, schema = _array_schema(docs, kinds)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, numbers = re.compile(txt.TOKEN).findall, TermNumbers(inline)
        for batch in batches:
            start, held, found = 0, 0, []
            for i, text in enumerate(batch.column("body"), 1):
                tokens = cut(text.as_py() or "")
                found.append(np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)))
                held += len(tokens)
                if held >= CHUNK_TOKENS or i == batch.num_rows:
                    rows = batch.slice(start, i - start)
                    lengths = pa.array(list(map(len, found)), pa.int32(), mask=rows.column("body").is_null().to_numpy(zero_copy_only=False))
                    yield pa.record_batch([rows.column("doc_id"), lengths, *_numbered_arrays(found, numbers.terms, kinds)], names=names)
                    start, held, found = i, 0, []
                    if len(numbers) > REMEMBERED:
                        numbers = TermNumbers(inline)

    return docs.select("doc_id", body.alias("body")).mapInArrow(build, schema)


def _array_schema(docs: DataFrame, kinds: list[str]) -> tuple[list[str], str]:
    columns = [f"{ARRAY_COLUMNS[kind]} {ARRAY_TYPES[kind]}" for kind in kinds]
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return ["doc_id", "doc_len", *(ARRAY_COLUMNS[kind] for kind in kinds)], ", ".join([f"doc_id {doc_id}", "doc_len int", *columns])


def _numbered_arrays(found: list[np.ndarray], terms: list[str], kinds: list[str]) -> list[pa.ListArray]:
    """The arrays of documents whose tokens have these numbers."""
    n_docs, number = len(found), np.concatenate(found)
    doc = np.repeat(np.arange(n_docs, dtype=np.int64), list(map(len, found)))
    words = number != NO_WORD
    number, doc = number[words], doc[words]
    in_doc = np.bincount(doc, minlength=n_docs)
    pos = np.arange(1, len(doc) + 1) - (np.cumsum(in_doc) - in_doc)[doc]
    kept = number != STOP_WORD
    number, doc, pos = number[kept], doc[kept], pos[kept]
    own = np.flatnonzero(np.bincount(number))
    texts = [terms[i] for i in own]
    order = sorted(range(len(texts)), key=texts.__getitem__)
    rank = np.empty(int(own[-1]) + 1 if len(own) else 0, np.int64)
    rank[own[order]] = np.arange(len(own))
    return _kind_lists(doc, pos, rank[number], [texts[i] for i in order], n_docs, kinds)


def kind_arrays(kept: DataFrame, kinds: Iterable[str]) -> DataFrame:
    """(doc_id, doc_len) and the array column of each kind: what ``with_entries``, ``with_uniwords`` and
    ``with_biwords`` make of ``kept_words``, in Arrow batches.

    Tokens are numbered by their distinct texts, which alone are normalized, and sorted as
    numbers; a sort of (term, position) structs per document costs several times as much.
    """
    kinds = [kind for kind in ARRAY_COLUMNS if kind in set(kinds)]
    names, schema = _array_schema(kept, kinds)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _chunks(batch):
                arrays = _arrays(rows.column("kept"), kinds)
                yield pa.record_batch([rows.column("doc_id"), rows.column("doc_len"), *arrays], names=names)

    return kept.select("doc_id", "doc_len", "kept").mapInArrow(build, schema)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Successive rows with up to about ``CHUNK_TOKENS`` tokens each."""
    before = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("kept")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        limit = (before[start - 1] if start else 0) + CHUNK_TOKENS
        end = max(start + 1, int(np.searchsorted(before, limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _listed(docs: np.ndarray, n_docs: int, values: pa.Array) -> pa.ListArray:
    """Values as lists, one for each document; ``docs`` are sorted."""
    ends = np.append(0, np.bincount(docs, minlength=n_docs).cumsum())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _arrays(kept: pa.ListArray, kinds: list[str]) -> list[pa.ListArray]:
    n_docs, tokens = len(kept), kept.flatten()
    sizes = pc.fill_null(pc.list_value_length(kept), 0).to_numpy(zero_copy_only=False)
    raw = pc.struct_field(tokens, "raw").dictionary_encode()
    pos = pc.struct_field(tokens, "pos").to_numpy(zero_copy_only=False)
    of_raw = normalized(raw.dictionary.to_pylist())
    terms = sorted(set(of_raw))
    numbers = {term: i for i, term in enumerate(terms)}
    term = np.fromiter((numbers[t] for t in of_raw), np.int64, len(of_raw))[raw.indices.to_numpy(zero_copy_only=False)]
    doc = np.repeat(np.arange(n_docs, dtype=np.int64), sizes)
    return _kind_lists(doc, pos, term, terms, n_docs, kinds)


def _kind_lists(doc: np.ndarray, pos: np.ndarray, term: np.ndarray, terms: list[str], n_docs: int, kinds: list[str]) -> list[pa.ListArray]:
    """The array of each kind, of kept words in order: documents, positions, and terms as places in the sorted ``terms``."""
    texts, width = pa.array(terms, pa.string()), max(len(terms), 1)
    found = {}
    if "positional" in kinds or "uniword" in kinds:
        key = doc * width + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        docs, own = key[starts] // width, texts.take(pa.array(key[starts] % width))
        ends = np.append(starts, len(key))
        if "positional" in kinds:
            positions = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pos[order], pa.int32()))
            entries = pa.StructArray.from_arrays([own, pa.array(np.diff(ends), pa.int32()), positions], ["term", "tf", "positions"])
            found["positional"] = _listed(docs, n_docs, entries)
        if "uniword" in kinds:
            found["uniword"] = _listed(docs, n_docs, own)
    if "biword" in kinds:
        inside = np.flatnonzero(doc[1:] == doc[:-1])
        pairs, number = np.unique(term[inside] * width + term[inside + 1], return_inverse=True)
        wide = max(len(pairs), 1)
        key = np.sort(doc[inside] * wide + number)  # np.unique would hash them, which takes several times as long
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        first, second = (texts.take(pa.array(half)) for half in (pairs // width, pairs % width))
        joined = pc.binary_join_element_wise(first, second, " ")
        found["biword"] = _listed(key // wide, n_docs, joined.take(pa.array(key % wide)))
    return [found[kind] for kind in kinds]


def explode_entries(entries: DataFrame, norms: tuple[str, ...] = ()) -> DataFrame:
    """Postings (term, doc_id, tf, doc_len, positions) of per-document entries, and their columns ``norms``."""
    return (
        entries.select("doc_id", "doc_len", *norms, F.inline_outer("entries"))
        .where(F.col("term").isNotNull())
        .select("term", "doc_id", "tf", "doc_len", "positions", *norms)
    )


def merge_postings(postings: DataFrame) -> DataFrame:
    """Unite postings of documents that share an id."""
    return postings.groupBy("term", "doc_id").agg(
        F.sum("tf").cast("int").alias("tf"),
        F.max("doc_len").alias("doc_len"),
        F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"),
    )


def positional_postings(
    docs: DataFrame,
    stop_words: StopWords = None,
    include_id_token: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """(term, doc_id, tf, doc_len, positions).

    Documents that share an id are united. With ``unique_ids=True``, for ids known
    to be unique, this is a projection of the documents, without a shuffle.
    """
    kept = kept_words(docs, stop_words, include_id_token)
    postings = explode_entries(with_entries(term_arrays(kept)))
    return postings if unique_ids else merge_postings(postings)


def with_uniwords(terms: DataFrame) -> DataFrame:
    """Add ``uniwords``: the distinct terms of each document."""
    return terms.select("*", F.array_distinct(F.transform("terms", lambda t: t.term)).alias("uniwords"))


def with_biwords(terms: DataFrame) -> DataFrame:
    """Add ``biwords``: the distinct pairs of neighbouring kept words."""
    pairs = F.greatest(F.size("t") - 1, F.lit(0))
    joined = F.zip_with(F.slice("t", 1, pairs), F.slice("t", 2, pairs), lambda a, b: F.concat_ws(" ", a, b))
    return terms.select("*", F.transform("terms", lambda t: t.term).alias("t")).select(
        *terms.columns, F.array_distinct(joined).alias("biwords")
    )


def explode_keys(arrays: DataFrame, column: str, key: str, unique_ids: bool = True) -> DataFrame:
    """(key, doc_id) rows of an array column of distinct keys."""
    rows = arrays.select(F.explode_outer(column).alias(key), "doc_id").where(F.col(key).isNotNull())
    return rows if unique_ids else rows.distinct()


def uniword_postings(
    docs: DataFrame,
    stop_words: StopWords = None,
    include_id_token: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """(term, doc_id), each pair once."""
    terms = term_arrays(kept_words(docs, stop_words, include_id_token))
    return explode_keys(with_uniwords(terms), "uniwords", "term", unique_ids)


def biword_postings(
    docs: DataFrame,
    stop_words: StopWords = None,
    include_id_token: bool = False,
    unique_ids: bool = False,
    variant: str = "standard",
) -> DataFrame:
    """(biword, doc_id), each pair once.

    The reference variant splits on blanks only, so that a chunk with a line
    break inside is no word.
    """
    kept = kept_words(docs, stop_words, include_id_token, on_blanks=variant == "reference")
    return explode_keys(with_biwords(term_arrays(kept)), "biwords", "biword", unique_ids)


def document_frequency(postings: DataFrame, key: str = "term") -> DataFrame:
    """(key, df). Counts are combined before the shuffle, so a hot term is cheap."""
    return postings.groupBy(key).agg(F.count("*").alias("df"))


def norm_columns(entries: str = "entries") -> list[Column]:
    """L2 norm, and root of the plain weight sum, of a document's tf weights."""

    def total(weight) -> Column:
        return F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + weight(tf_weight(e.tf)))

    return [
        F.sqrt(total(lambda w: w * w)).alias("norm"),
        F.sqrt(total(lambda w: w)).alias("norm_reference"),
    ]
