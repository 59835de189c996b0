"""Query terms matched inside index terms."""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lexmill.session import local_copy, salted, small_rows

# Up to this many query rows are tested in one scan of the dictionary.
INLINE_TERMS = 64
GRAM = 3

# Up to so many query rows, of so many queries, are tested on the postings themselves, a batch at a time.
MASK_TERMS = 20_000
MASK_QUERIES = 1_000

# Index terms a worker remembers before it starts anew (some 100 MB).
REMEMBERED = 300_000

# Cells of documents and query terms that are summed up at once.
CELLS = 1_000_000

# Postings that are looked at together, at least.
TOGETHER = 50_000


def substring_terms(dictionary: DataFrame, query_terms: DataFrame) -> DataFrame:
    """(query_id, n, term, df): dictionary terms that contain a query term.

    Few query terms are tested directly while the dictionary is scanned. Many
    are found by an equi-join on a character gram, then verified.
    """
    rows = small_rows(query_terms, INLINE_TERMS)
    if rows is None:
        matched = _by_gram(dictionary, query_terms)
    elif not rows:
        return dictionary.join(query_terms, "term").select("query_id", "term", "df", "n")
    else:
        matched = _by_scan(dictionary, local_copy(query_terms, rows), sorted({r.term for r in rows}))
    # A query may hold several parts of one index term; their counts add up.
    return matched.groupBy("query_id", "term", "df").agg(F.sum("n").alias("n"))


def _by_scan(dictionary: DataFrame, query_terms: DataFrame, parts: list[str]) -> DataFrame:
    wanted = reduce(lambda a, c: a | c, [F.col("term").contains(p) for p in parts])
    held = F.filter(F.array(*map(F.lit, parts)), lambda p: F.contains(F.col("term"), p))
    return (
        dictionary.where(wanted)
        .select("term", "df", F.explode_outer(held).alias("part"))
        .join(F.broadcast(query_terms.withColumnRenamed("term", "part")), "part")
    )


def _grams(n: int) -> Column:
    """All substrings of length n of a term."""
    starts = F.sequence(F.lit(1), F.length("term") - n + 1)
    return F.when(
        F.length("term") >= n, F.transform(starts, lambda i: F.substring(F.col("term"), i, F.lit(n)))
    ).otherwise(F.expr("array()"))


def _by_gram(dictionary: DataFrame, query_terms: DataFrame) -> DataFrame:
    """Join on the first gram of the query term, salted as short grams are hot."""
    shortest = query_terms.agg(F.min(F.length("term"))).first()[0]
    lengths = range(min(GRAM, shortest), GRAM + 1)
    grams_of = F.array_distinct(F.concat(*[_grams(n) for n in lengths]))
    grams = dictionary.select("term", "df", grams_of.alias("grams")).select(
        "term", "df", F.explode_outer("grams").alias("gram")
    )
    parts = query_terms.select("query_id", "n", F.col("term").alias("part"), F.substring("term", 1, GRAM).alias("gram"))
    grams, parts = salted(grams, parts, "term")
    return grams.join(parts, ["gram", "salt"]).where(F.col("term").contains(F.col("part")))


def mask_rows(query_terms: DataFrame) -> list[Row] | None:
    """Query rows that are too many for one scan of the dictionary, but few enough for ``substring_sums``."""
    rows = small_rows(query_terms, MASK_TERMS)
    if rows is None or len(rows) <= INLINE_TERMS:
        return None
    return rows if len({row.query_id for row in rows}) <= MASK_QUERIES else None


class HeldParts(dict):
    """The number of each index term; the places of the query terms it contains are in ``held``, from ``starts``.

    Parts are looked up by the substrings of a term that are as long as some part: those of a
    term are few, whereas a test for every part takes thousands of tests a term.
    """

    def __init__(self, parts: list[str]):
        super().__init__()
        self.place = {part: i for i, part in enumerate(parts)}
        self.lengths = sorted({len(part) for part in parts})
        self.held, self.starts = array("i"), array("q", [0])

    def __missing__(self, term: str) -> int:
        size, get = len(term), self.place.get
        found = {get(term[i : i + n]) for n in self.lengths if n <= size for i in range(size - n + 1)}
        found.discard(None)
        self.held.extend(found)
        self.starts.append(len(self.held))
        number = self[term] = len(self.starts) - 2
        return number

    def of(self, terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The parts of some terms, one after the other, and their number in each term."""
        numbers = np.fromiter(map(self.__getitem__, terms), np.int64, len(terms))
        starts, held = (np.array(a) for a in (self.starts, self.held))
        sizes = starts[numbers + 1] - starts[numbers]
        return held[_runs(starts[numbers], sizes)], sizes


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _whole_documents(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, of batches sorted by document; no document is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        docs = table["doc_id"].combine_chunks()
        last = docs[len(docs) - 1]
        same = pc.is_null(docs) if not last.is_valid else pc.fill_null(pc.equal(docs, last), False)
        cut = len(docs) - pc.sum(same).as_py()
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def substring_sums(weighted: DataFrame, rows: list[Row]) -> DataFrame:
    """(query_id, doc_id, total): of ``weighted(doc_id, term, weight)``, sums over the terms that contain a query term.

    Short query terms are part of most index terms, so the pairs of a query and a matched
    term, and of a query and a matched posting, are many times the postings. They are never
    rows here: postings are dealt by document, the weights of a document are summed by query
    term, and a matrix of documents and query terms, times one of query terms and queries,
    gives the totals. Postings without a weight count for nothing.
    """
    parts = sorted({row.term for row in rows})
    ids = sorted({row.query_id for row in rows})
    query = {q: i for i, q in enumerate(ids)}
    place = {part: i for i, part in enumerate(parts)}
    wanted = np.array([(place[row.term], query[row.query_id], row.n) for row in rows], np.int64).T
    at_once = max(CELLS // len(parts), 1)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, asking = HeldParts(parts), np.array(ids, np.int64)
        asked = np.zeros((len(parts), len(ids)))
        np.add.at(asked, (wanted[0], wanted[1]), wanted[2])
        asks = (asked > 0).astype(np.float32)
        for table in _whole_documents(batches, TOGETHER):
            terms, docs = (table[c].combine_chunks().dictionary_encode(null_encoding="encode") for c in ("term", "doc_id"))
            if len(known) > REMEMBERED:
                known = HeldParts(parts)
            held, sizes = known.of(terms.dictionary.to_pylist())
            doc, term = (a.indices.to_numpy(zero_copy_only=False) for a in (docs, terms))
            weight = table["weight"].to_numpy()
            begins = np.cumsum(sizes) - sizes
            for first in range(0, len(docs.dictionary), at_once):
                # a document's rows are side by side
                some = slice(*np.searchsorted(doc, [first, first + at_once]))
                n = min(at_once, len(docs.dictionary) - first)
                each = sizes[term[some]]
                part = held[_runs(begins[term[some]], each)]
                cell = np.repeat(doc[some].astype(np.int64) - first, each) * len(parts) + part
                sums = np.bincount(cell, np.repeat(weight[some], each), n * len(parts)).reshape(n, -1)
                met = np.bincount(cell, minlength=n * len(parts)).reshape(n, -1) > 0
                hit = np.nonzero(met.astype(np.float32) @ asks)
                totals = (sums @ asked)[hit]
                ids_of = docs.dictionary.take(pa.array(hit[0] + first))
                yield pa.record_batch([pa.array(asking[hit[1]]), ids_of, pa.array(totals)], names=["query_id", "doc_id", "total"])

    dealt = weighted.select("doc_id", "term", "weight").where("weight is not null").repartition("doc_id").sortWithinPartitions("doc_id")
    return dealt.mapInArrow(add_up, "query_id long, doc_id long, total double")
