"""Layout of a saved index, documents that share ids, indexes of one kind, and the entry file on its own."""

import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import lexmill as lx
from lexmill.plans import index as index_plan

REPO = Path(__file__).parent.parent


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents that all hold one term, and rare terms."""
    order = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(["hot", *order.choices(words, k=order.randrange(12))])) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows_of(postings):
    return sorted((r.term, r.doc_id, r.tf, r.doc_len, tuple(r.positions)) for r in postings.collect())


@pytest.mark.parametrize("shards,rows_per_file", [(1, 100), (3, 64), (8, 10**6)])
def test_files_are_of_like_size_whatever_the_skew(spark, corpus, tmp_path, shards, rows_per_file):
    path = str(tmp_path / "index")
    ix = lx.build_index(corpus, path, shards=shards, rows_per_file=rows_per_file)
    assert rows_of(ix.postings) == rows_of(lx.positional_postings(corpus, unique_ids=True))
    assert sorted(map(tuple, ix.biwords.select("biword", "doc_id").collect())) == sorted(map(tuple, lx.biword_postings(corpus, unique_ids=True).collect()))
    stored = spark.read.parquet(f"{path}/postings").withColumn("file", F.input_file_name())
    sizes = [r["count"] for r in stored.groupBy("file").count().collect()]
    assert max(sizes) <= 2 * rows_per_file
    hot = stored.where("term = 'hot'").select("file").distinct().count()
    assert hot == (1 if rows_per_file > 400 else -(-400 // rows_per_file))
    for file in stored.select("file").distinct().limit(3).collect():
        keys = [(r.term, r.doc_id) for r in spark.read.parquet(file.file).collect()]
        assert keys == sorted(keys)
    hits = lx.bm25(ix, "hot w1 w2", k=5).collect()
    assert [r.doc_id for r in hits] == [r.doc_id for r in lx.bm25(lx.build_index(corpus, str(tmp_path / "plain"), shards=2), "hot w1 w2", k=5).collect()]


def test_one_shared_id_leaves_the_others_alone(spark, corpus, tmp_path):
    docs = corpus.withColumn("doc_id", F.when(F.col("doc_id").isin(7, 9, 11), 7).otherwise(F.col("doc_id")))
    kinds = ("positional", "uniword", "biword")
    ix = lx.build_index(docs, str(tmp_path / "index"), kinds=kinds, shards=2)
    assert rows_of(ix.postings) == rows_of(lx.positional_postings(docs))
    pairs = sorted(map(tuple, lx.uniword_postings(docs).collect()))
    assert sorted(map(tuple, ix.uniwords.select("term", "doc_id").collect())) == pairs
    assert {(r.term, r.df) for r in ix.terms.collect()} == {tuple(r) for r in lx.document_frequency(lx.uniword_postings(docs)).collect()}
    norms = {r.doc_id: r.norm for r in lx.document_norms(ix.postings).collect()}
    stats = ix.doc_stats.collect()
    assert len(stats) == 398 and all(r.norm == pytest.approx(norms[r.doc_id]) for r in stats)
    assert all(r.norm == pytest.approx(norms[r.doc_id]) for r in ix.postings.collect())


def test_build_observes_nothing(spark, corpus, tmp_path):
    """An observation would keep models of Spark ML in the same session from being sent to tasks."""
    source = (REPO / "lexmill/plans/index.py").read_text()
    assert "Observation" not in source and "repartitionByRange(files" not in source


def test_biword_only_index_says_what_it_lacks(spark, corpus, tmp_path):
    ix = lx.build_index(corpus, str(tmp_path / "index"), kinds=("biword",), shards=2)
    for search in (lx.lookup, lx.boolean_search, lx.matched_terms):
        with pytest.raises(ValueError, match="positional or uniword"):
            search(ix, ["hot"])
    assert lx.lookup_biwords(ix, ["hot w1"]).count() > 0
    lx.write_lines(lx.key_lines(ix.biwords, ix.biword_terms, "biword"), str(tmp_path / "lines"), "biword")
    again = lx.Index.from_lines(spark, str(tmp_path / "lines"), kind="biword")
    assert sorted(map(tuple, lx.lookup_biwords(again, ["hot w1"]).collect())) == sorted(map(tuple, lx.lookup_biwords(ix, ["hot w1"]).collect()))
    with pytest.raises(ValueError):
        lx.Index.from_lines(spark, str(tmp_path / "lines"), kind="other")


@pytest.mark.parametrize("ands", [5, 62, 63, 200])
def test_long_boolean_chains_against_sets(spark, corpus, tmp_path_factory, ands):
    ix = lx.build_index(corpus, str(tmp_path_factory.mktemp("chain") / "index"), shards=2)
    held = {r.doc_id: set(r.text.split()) for r in corpus.collect()}
    order = random.Random(ands)
    chain = ["w0"]
    for i in range(3 * ands):
        chain += [("AND" if i < ands else order.choice(["OR", "ANDNOT"])), f"w{order.randrange(70)}"]
    pairs = list(zip(chain[1::2], chain[2::2]))
    order.shuffle(pairs)
    pairs += [("OR", "w3"), ("AND", "hot"), ("AND", "w4"), ("OR", "w5"), ("ANDNOT", "w6"), ("AND", "hot")]
    docs = {i for i, words in held.items() if "w0" in words}
    for operator, term in pairs:
        own = {i for i, words in held.items() if term in words}
        docs = docs & own if operator == "AND" else docs | own if operator == "OR" else docs - own
    query = " ".join(["w0", *(part for pair in pairs for part in pair)])
    assert {r.doc_id for r in lx.boolean_search(ix, query).collect()} == docs and docs


def test_entry_file_without_the_training_data_operators(tmp_path):
    """The search queries stay, whichever of the optional parts is left out."""
    copy = tmp_path / "repo"
    leave = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache")
    shutil.copytree(REPO, copy, ignore=leave)
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), len(q.keys() & e.search_queries().keys()), sorted(q.keys() - s.keys()))"
    run = lambda: subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    for _ in range(2):
        done = run()
        assert done.returncode == 0, done.stderr
        total, own, unmatched = done.stdout.split(maxsplit=2)
        assert total == own and int(own) > 60 and unmatched.strip() == "[]"
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    (copy / "lexmill" / "plans" / "search.py").unlink()  # what is not optional must be there
    assert run().returncode != 0


def test_documents_of_one_row_group_are_spread(spark, tmp_path):
    """A row group is read by one task, however many splits its file has."""
    import __spark_entry__ as entry_file

    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.option("parquet.block.size", 1 << 30).parquet(str(tmp_path / "documents.parquet"))
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in before:
        spark.conf.set(key, "8k")
    try:
        docs = entry_file.documents(spark, str(tmp_path))
        sizes = [r["count"] for r in docs.groupBy(F.spark_partition_id()).count().collect()]
        assert sorted(docs.collect()) == sorted(rows.collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    assert sum(sizes) == 4000 and max(sizes) * cores <= 2 * 4000


def test_kind_arrays_are_those_of_the_column_functions(spark, monkeypatch):
    from lexmill.operators import postings as ops
    from lexmill.operators.tokens import kept_words, term_arrays

    order = random.Random(5)
    parts = ["a.", "b", "(b)", "c:,", "d'e", "ü,", "x.y.", "the", "\x0bz", "z\x0b.", "_", "[_]", "\n", "B", "f g"]
    texts = ["", None, "the the", "one", *(" ".join(order.choices(parts, k=order.randrange(30))) for _ in range(200))]
    docs = spark.createDataFrame([(i % 190, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(2)
    kept = kept_words(docs, ["the"])
    plain = ops.with_entries(ops.with_biwords(ops.with_uniwords(term_arrays(kept))))
    columns = ["doc_id", "doc_len", "entries", F.sort_array("uniwords"), F.sort_array("biwords")]
    expected = sorted(map(str, plain.select(columns).collect()))
    for tokens in (7, 500_000):
        monkeypatch.setattr(ops, "CHUNK_TOKENS", tokens)
        assert sorted(map(str, ops.kind_arrays(kept, ops.ARRAY_COLUMNS).select(columns).collect())) == expected


def test_document_arrays_are_those_of_kept_words(spark, monkeypatch):
    """Texts cut in Arrow batches, once per distinct token, give what the column functions give."""
    from lexmill.operators import postings as ops
    from lexmill.operators import tokens

    order = random.Random(6)
    parts = ["a.", "b", "(b)", "c:,", "d'e", "ü,", "x.y.", "the", "THE", "\x0bthe", "\x0bz", "z\x0b.", "_", "[_]", "\n", "\r", "q\u2028r", "é", "!\"", "B", "f\tg", "İx"]
    texts = ["", None, "the the", "one", *(" ".join(order.choices(parts, k=order.randrange(30))) for _ in range(200))]
    docs = spark.createDataFrame([(i % 190 or None, t, parts[i % 9]) for i, t in enumerate(texts)], "doc_id long, text string, title string").coalesce(2)
    columns = ["doc_id", "doc_len", "entries", "uniwords", "biwords"]
    for source in (docs, docs.drop("title")):
        for stops, with_id in ((["the", None], False), (None, True)):
            kept = tokens.kept_words(source, stops, with_id)
            expected = sorted(map(str, ops.kind_arrays(kept, ops.ARRAY_COLUMNS).select(columns).collect()))
            for chunk, remembered in ((7, 3), (500_000, 500_000)):
                monkeypatch.setattr(ops, "CHUNK_TOKENS", chunk)
                monkeypatch.setattr(ops, "REMEMBERED", remembered)
                found = ops.document_arrays(source, ops.ARRAY_COLUMNS, stops, with_id)
                assert sorted(map(str, found.select(columns).collect())) == expected
                assert "array_remove" not in found._jdf.queryExecution().toString()  # no array of tokens is made per row


def test_files_are_cut_by_first_characters(spark, tmp_path, monkeypatch):
    """Counts of whole pairs are as many as the pairs; only those of common first characters are needed."""
    counted, staged = {}, index_plan.stage

    def spy(df, name):
        table = staged(df, name)
        counted.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(index_plan, "stage", spy)
    order = random.Random(11)
    rows = [(i, " ".join(["same same", *(f"{order.choice(['ab', 'héé', 'zz'])}{order.randrange(10**6)}" for _ in range(20))])) for i in range(150)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "index")
    ix = lx.build_index(corpus, path, kinds=("biword",), shards=2, rows_per_file=60)
    assert sorted(map(tuple, ix.biwords.select("biword", "doc_id").collect())) == sorted(map(tuple, lx.biword_postings(corpus, unique_ids=True).collect()))
    assert max(counted["first-characters"]) < 500 < 2500 < ix.biword_terms.count()
    sizes = {r.file: r["count"] for r in spark.read.parquet(f"{path}/biwords").groupBy(F.input_file_name().alias("file")).count().collect()}
    assert max(sizes.values()) <= 120 and len(sizes) > 20
    df = {r.biword: r.df for r in ix.biword_terms.collect()}
    assert df == {r.biword: r.df for r in lx.document_frequency(ix.biwords, "biword").collect()} and df["same same"] == 150
    assert {tuple(r) for r in lx.lookup_biwords(ix, ["same same"]).collect()} == {("same same", 150, i) for i in range(150)}


def test_documents_of_lines_are_added_up_once(spark, corpus, tmp_path, monkeypatch):
    """The length and both norms of the documents of posting lines come from one aggregate, without a join."""
    plans, staged = {}, index_plan.stage

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    ix = lx.build_index(corpus, str(tmp_path / "index"), kinds=("positional",), shards=2)
    lx.write_lines(lx.positional_lines(ix.postings, ix.terms), str(tmp_path / "lines"))
    monkeypatch.setattr(index_plan, "stage", spy)
    found = lx.Index.from_lines(spark, str(tmp_path / "lines")).doc_stats.collect()
    assert plans["doc-stats"].count("Aggregate") == 1 and "Join" not in plans["doc-stats"]
    expected = {r.doc_id: r for r in ix.doc_stats.collect()}
    assert len(found) == len(expected)
    for row in found:
        for name in ("doc_len", "norm", "norm_reference"):
            assert row[name] == pytest.approx(expected[row.doc_id][name])
