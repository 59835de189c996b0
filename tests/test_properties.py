"""Properties over generated inputs, against plain Python."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

import lexmill as lx
from lexmill.functions.text import normalize_term
from lexmill.operators import queries as query_ops
from lexmill.operators import ranking, substring, tokens

WORDS = ["oil", "gold", "tin", "iron", "zinc", "lead", "silver", "tinoil"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(7)
    docs = [(i, " ".join(rng.choices(WORDS, weights=[30, 8, 4, 4, 3, 2, 1, 2], k=rng.randint(1, 9)))) for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    index = lx.build_index(frame, str(tmp_path_factory.mktemp("corpus") / "ix"), shards=4, rows_per_file=100)
    return dict(docs), index


def evaluate(query, docs):
    holding = {w: {i for i, text in docs.items() if w in text.split()} for w in WORDS}
    parts = query.split()
    result = set(holding.get(parts[0], set()))
    for operator, word in zip(parts[1::2], parts[2::2]):
        other = holding.get(word, set())
        result = {"AND": result & other, "OR": result | other, "ANDNOT": result - other}[operator]
    return result


def random_query(rng, n_terms):
    parts = [rng.choice([*WORDS, "none"])]
    for _ in range(n_terms - 1):
        parts += [rng.choice(["AND", "OR", "ANDNOT"]), rng.choice([*WORDS, "none"])]
    return " ".join(parts)


def test_boolean_chains_equal_set_algebra(corpus):
    docs, index = corpus
    rng = random.Random(11)
    # Chains beyond 62 and 124 slots take two and three bit words.
    batch = [random_query(rng, n) for n in [*range(1, 9)] * 5 + [62, 63, 70, 124, 125, 150]]
    hits = lx.boolean_search(index, batch).collect()
    found = {i: {h.doc_id for h in hits if h.query_id == i} for i in range(len(batch))}
    assert found == {i: evaluate(q, docs) for i, q in enumerate(batch)}
    assert len(hits) == sum(len(s) for s in found.values())


def test_postings_properties(corpus):
    docs, index = corpus
    rows = index.postings.collect()
    assert sum(r.tf for r in rows) == sum(len(t.split()) for t in docs.values())
    for r in rows:
        assert r.positions == [i + 1 for i, w in enumerate(docs[r.doc_id].split()) if w == r.term]
        assert (r.tf, r.doc_len) == (len(r.positions), len(docs[r.doc_id].split()))
    df = {r.term: r.df for r in index.terms.collect()}
    assert df == {w: sum(w in t.split() for t in docs.values()) for w in df}


@pytest.mark.parametrize("broadcast_bytes", [query_ops.BROADCAST_BYTES, 0])
def test_large_batches_give_the_same_hits(corpus, monkeypatch, broadcast_bytes):
    docs, index = corpus
    batch = ["oil gold", "tin", "none"]
    calls = {
        "bm25": lambda: lx.bm25(index, batch),
        "tfidf": lambda: lx.tfidf(index, batch),
        "boolean": lambda: lx.boolean_search(index, ["oil AND gold", "tin OR none"]),
        "substring": lambda: lx.bm25(index, batch, match="substring"),
        "lookup": lambda: lx.lookup(index, ["oil", "tin"]),
        "biwords": lambda: lx.lookup_biwords(index, ["oil gold", "oil oil"]),
        "matched": lambda: lx.matched_terms(index, batch),
    }

    def outputs():
        return {name: sorted(map(str, call().collect())) for name, call in calls.items()}

    few = outputs()
    monkeypatch.setattr(query_ops, "small_rows", lambda df: None)
    monkeypatch.setattr(query_ops, "BROADCAST_BYTES", broadcast_bytes)
    assert outputs() == few


def test_substring_gram_join_equals_scan(spark, corpus, monkeypatch):
    _, index = corpus
    queries = [(0, "o", 1), (0, "oil", 2), (1, "in", 1), (1, "silver", 1), (2, "tinoilx", 1), (2, "tino", 3)]
    parts = spark.createDataFrame(queries, "query_id long, term string, n long")
    expected = {}
    df = {r.term: r.df for r in index.terms.collect()}
    for query_id, part, n in queries:
        for word in df:
            if part in word:
                key = (query_id, word, df[word])
                expected[key] = expected.get(key, 0) + n

    def found():
        return {(r.query_id, r.term, r.df): r.n for r in substring.substring_terms(index.terms, parts).collect()}

    assert found() == expected
    monkeypatch.setattr(substring, "INLINE_TERMS", 1)
    assert found() == expected


def test_long_stop_list_is_joined(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "oil and gold"), (1, "and gold oil"), (2, "and and"), (3, "")], "doc_id long, text string"
    )
    stops = spark.createDataFrame([("and",), ("and",), ("x",)], "word string")

    def outputs():
        return [
            sorted(map(tuple, lx.tokenize(docs, stops).collect())),
            sorted(map(tuple, lx.biword_postings(docs, stops, unique_ids=False).collect())),
            sorted(map(tuple, tokens.kept_words(docs, stops).select("doc_id", "doc_len", F.size("kept")).collect())),
        ]

    inline = outputs()
    monkeypatch.setattr(tokens, "INLINE_STOP_WORDS", 1)
    assert outputs() == inline
    monkeypatch.setattr(tokens, "BROADCAST_STOP_BYTES", 0)
    assert outputs() == inline
    assert inline[1] == [("gold oil", 1), ("oil gold", 1)]


def test_shared_document_ids_are_united(spark, tmp_path):
    docs = spark.createDataFrame([(1, "oil gold"), (1, "oil oil tin"), (2, "oil")], "doc_id long, text string")
    index = lx.build_index(docs, str(tmp_path / "ix"), kinds=["positional", "uniword", "biword"], shards=2)
    rows = {(r.term, r.doc_id): (r.tf, r.doc_len, r.positions) for r in index.postings.collect()}
    assert rows[("oil", 1)] == (3, 3, [1, 1, 2])
    assert index.uniwords.count() == 4 and index.biwords.count() == 3
    assert {r.term: r.df for r in index.terms.collect()} == {"oil": 2, "gold": 1, "tin": 1}
    assert index.stats.n_docs == 3 and index.doc_stats.count() == 2
    norms = {r.doc_id: r.norm for r in lx.document_norms(index.postings).collect()}
    assert {r.doc_id: pytest.approx(r.norm) for r in index.doc_stats.collect()} == norms


def test_top_hits_beyond_the_group_limit(spark, monkeypatch):
    scored = spark.range(5000).select(
        (F.col("id") % 2).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 97).cast("double").alias("score")
    )
    top = ranking.top_hits(scored, 1500).collect()
    rows = [(r.query_id, r.doc_id, r.score) for r in scored.collect()]
    for query in (0, 1):
        best = sorted((r for r in rows if r[0] == query), key=lambda r: (-r[2], r[1]))[:1500]
        hits = sorted((h for h in top if h.query_id == query), key=lambda h: h.rank)
        assert [h.doc_id for h in hits] == [r[1] for r in best]
        assert [h.rank for h in hits] == list(range(1, 1501))


def test_normalization_equals_the_single_steps(spark):
    blanks = "".join(map(chr, range(0x21)))
    rng = random.Random(3)
    raws = {"".join(rng.choices("ab.:,[(')\x0b\t", k=rng.randint(1, 9))) for _ in range(20000)}
    raws = sorted(raw for raw in raws if set(raw) & set("ab"))

    def expected(raw):
        term = raw.strip(blanks)
        for mark in ".:,":
            if term.endswith(mark):
                term = term[:-1].strip(blanks)
        return "".join(c for c in term if c not in "[](){}'").strip(blanks)

    frame = spark.createDataFrame([(raw,) for raw in raws], "raw string")
    rows = frame.select("raw", normalize_term(F.col("raw")).alias("term")).collect()
    assert [(r.raw, r.term) for r in rows if r.term != expected(r.raw)] == []
    long_run = spark.range(1).select(normalize_term(F.concat(F.lit("a"), F.repeat(F.lit("\x0b"), 200000), F.lit("b"))))
    assert len(long_run.first()[0]) == 200002


def test_many_substring_terms_are_summed_by_document(spark, corpus, monkeypatch):
    """Without a row for each pair of a query and a matched term, and with the same hits as by such rows."""
    _, index = corpus
    parts = [f"{a}{b}" for a in "abcdefghijklmnopqrst0123456789" for b in ["", "a", "1"]]
    batch = spark.createDataFrame([(i, " ".join(parts[i::3] * (1 + i % 2))) for i in range(4)], "query_id long, q string")

    def hits(variant):
        found = lx.bm25(index, batch, match="substring", variant=variant)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return sorted((r.query_id, r.rank, r.doc_id, round(r.score, 6)) for r in found.collect()), plan

    for variant in ("standard", "reference"):
        got, plan = hits(variant)
        assert got and "MapInArrow" in plan
        monkeypatch.setattr("lexmill.operators.substring.MASK_QUERIES", 0)
        rows, plan = hits(variant)
        assert "MapInArrow" not in plan and got == rows
        monkeypatch.undo()


def test_substring_sums_have_one_row_for_a_document(spark, monkeypatch):
    """Whatever the batches, a document's total is whole; postings without a weight are no hits."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        monkeypatch.setattr(substring, "TOGETHER", 2)
        monkeypatch.setattr(substring, "CELLS", 5)
        order = random.Random(5)
        terms = ["".join(order.choices("abc", k=order.randrange(1, 7))) for _ in range(60)]
        rows = [(d, t, order.random()) for d in (*range(30), None) for t in set(order.sample(terms, 9))]
        weighted = spark.createDataFrame([*rows, (7, "zzz", None), (99, "abab", None)], "doc_id long, term string, weight double")
        wanted = [Row(query_id=q, term=t, n=n) for q, t, n in ((4, "ab", 1), (4, "c", 2), (9, "abca", 1), (9, "zz", 1), (9, "b", 3))]
        found = [tuple(r) for r in substring.substring_sums(weighted, wanted).collect()]
        expected = {}
        for d, t, w in rows:
            for r in wanted:
                if r.term in t:
                    expected[r.query_id, d] = expected.get((r.query_id, d), 0.0) + w * r.n
        assert len(found) == len(expected)
        assert {(q, d): pytest.approx(total) for q, d, total in found} == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_large_side_of_terms_is_broadcast(spark, monkeypatch):
    """Terms that were measured to be too many are not broadcast for the size of their files."""
    monkeypatch.setattr(query_ops, "small_rows", lambda df: None)
    monkeypatch.setattr(query_ops, "BROADCAST_BYTES", 0)
    table = spark.createDataFrame([("a", i, 3) for i in range(50)], "term string, doc_id long, shard int")
    for shards in (4, None):
        side = query_ops.TermSide(spark.createDataFrame([(1, "a")], "query_id long, term string"), shards)
        joined = side.join(table.withColumn("shard", query_ops.shard_of(F.col("term"), 4)) if shards else table.drop("shard"))
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 50
