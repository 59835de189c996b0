"""Hand-derived results over two news items."""

import math

import pytest
from pyspark.sql import functions as F

import lexmill as lx


def lines(frame):
    return {row.line for row in frame.collect()}


def test_lengths_and_stats(spark, news, news_index):
    lengths = {r.doc_id: r.doc_len for r in news_index.doc_stats.collect()}
    assert lengths == {2: 8, 10: 7}
    assert (news_index.stats.n_docs, news_index.stats.avg_len) == (2, 7)


def test_positional_lines(news_index):
    written = lines(lx.positional_lines(news_index.postings, news_index.terms, "reference"))
    assert "oil:2\t10:1:0<5>; 2:3:8<2, 4, 7>; " in written
    assert "gold:1\t10:2:7<2, 3>; " in written
    assert "rises:1\t2:1:0<5>; " in written
    assert "steady:1\t10:1:0<6>; " in written


def test_uniword_lines(news_index):
    assert "oil:2\t10; 2" in lines(lx.key_lines(news_index.uniwords, news_index.terms))


def test_biwords(news_index):
    pairs = {(r.doc_id, r.biword) for r in news_index.biwords.collect()}
    assert pairs == {
        (2, "itemid_2 oil"),
        (2, "oil prices"),
        (2, "prices oil"),
        (2, "oil rises"),
        (2, "rises oil"),
        (2, "oil market"),
        (10, "itemid_10 gold"),
        (10, "gold gold"),
        (10, "gold oil"),
        (10, "oil steady"),
    }


@pytest.mark.parametrize(
    ("query", "expected"),
    [
        ("oil AND gold", {10}),
        ("oil ANDNOT gold", {2}),
        ("gold OR oil", {2, 10}),
        ("gold", {10}),
        ("absent OR oil and Gold", {10}),
        ("absent AND oil", set()),
    ],
)
def test_boolean(news_index, query, expected):
    assert {r.doc_id for r in lx.boolean_search(news_index, query).collect()} == expected


def test_bm25_reference(news_index):
    hits = lx.bm25(news_index, "oil", variant="reference").collect()
    assert [(h.doc_id, h.doc_name, h.rank) for h in hits] == [(10, "10newsML.xml", 1)]
    assert hits[0].score == pytest.approx(math.log10(2) * 2.2 / 1.3, abs=1e-6)


def test_tfidf_reference_collapses_equal_scores(news_index):
    hits = lx.tfidf(news_index, "oil", variant="reference").collect()
    assert [(h.doc_id, h.score) for h in hits] == [(10, 0.0)]


def test_tfidf_standard_keeps_equal_scores(news_index):
    hits = lx.tfidf(news_index, "oil").orderBy("rank").collect()
    assert [(h.doc_id, h.rank) for h in hits] == [(2, 1), (10, 2)]


def test_idf_of_truncated_quotient_is_minus_infinity(news_index):
    hits = lx.tfidf(news_index, "oil", variant="reference", n_docs=1).collect()
    assert [h.score for h in hits] == [-math.inf]


def test_bm25_counts_repeated_terms(news_index):
    once = lx.bm25(news_index, "gold").collect()
    twice = lx.bm25(news_index, "gold  gold").collect()
    assert twice[0].score == pytest.approx(2 * once[0].score, abs=2e-6)


def test_substring_match(news_index):
    exact = lx.bm25(news_index, "ol").collect()
    inside = lx.bm25(news_index, "ol", match="substring").collect()
    assert exact == [] and {h.doc_id for h in inside} == {10}


def test_search_modes(news_index):
    by_mode = {mode: lx.search(news_index, "gold", mode).columns for mode in (1, 2, 3, None)}
    assert {tuple(sorted(c)) for c in by_mode.values()} == {("doc_id", "doc_name", "query_id", "rank", "score")}
    assert lx.search(news_index, "gold", "2").count() == 1


def test_hydrate(news, news_index):
    row = lx.hydrate(lx.bm25(news_index, "gold"), news).first()
    assert (row.file_name, row.headline, row.manifest) == ("10newsML.txt", "Gold flat", "10newsML.txt;Gold flat")
    assert row.text == "Gold and oil - steady"


def test_lookup_and_matched_terms(news_index):
    found = {(r.term, r.df, r.doc_id, r.tf, r.doc_len) for r in lx.lookup(news_index, ["OIL", "none"]).collect()}
    assert found == {("oil", 2, 2, 3, 8), ("oil", 2, 10, 1, 7)}
    pairs = {(r.biword, r.df, r.doc_id) for r in lx.lookup_biwords(news_index, ["gold OIL"]).collect()}
    assert pairs == {("gold oil", 1, 10)}
    assert lx.matched_terms(news_index, "oil oil gold none").first().n_matched == 2


def test_no_hits_is_an_empty_frame(news_index):
    for mode in ("boolean", "tfidf", "bm25"):
        assert lx.search(news_index, "absent", mode).collect() == []
    assert lx.bm25(news_index, "  ").collect() == []
    assert lx.bm25(news_index, "  ", match="substring").collect() == []


def test_normalization(spark):
    docs = spark.createDataFrame([(1, "(Word) it's a.: end.: x:. the. the ... _ İ")], "doc_id long, text string")
    rows = lx.tokenize(docs, ["the"]).orderBy("pos").collect()
    assert [(r.pos, r.raw, r.term) for r in rows] == [
        (1, "(word)", "word"),
        (2, "it's", "its"),
        (3, "a.:", "a."),
        (4, "end.:", "end."),
        (5, "x:.", "x"),
        (6, "the.", "the"),
        (8, "_", "_"),
        (9, "i̇", "i̇"),
    ]
    assert {r.doc_len for r in rows} == {10}


def test_documents_without_words(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "the the"), (2, "... -"), (3, ""), (4, None), (5, "word")], "doc_id long, text string"
    )
    index = lx.build_index(docs, str(tmp_path / "ix"), ["the"], shards=2)
    assert {(r.doc_id, r.doc_len, r.norm) for r in index.doc_stats.collect()} == {
        (1, 2, 0.0), (2, 2, 0.0), (3, 0, 0.0), (4, 0, 0.0), (5, 1, 1.0),
    }
    assert index.stats.n_docs == 5 and index.stats.total_len == 5
    assert index.biwords.count() == 0
    assert [r.term for r in index.terms.collect()] == ["word"]


def test_empty_corpus(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    index = lx.build_index(docs, str(tmp_path / "ix"), shards=2)
    assert (index.stats.n_docs, index.stats.avg_len) == (0, 0)
    assert lx.bm25(index, "word").collect() == []
    assert lx.boolean_search(index, "a OR b").collect() == []


def test_uniword_index_answers_boolean_queries(spark, news, tmp_path):
    index = lx.build_index(news, str(tmp_path / "ix"), kinds=["uniword"], shards=2)
    assert {r.doc_id for r in lx.boolean_search(index, "oil ANDNOT gold").collect()} == {2}
    assert index.doc_stats.where(F.col("norm").isNotNull()).count() == 0


def test_bad_arguments(spark, news, news_index, tmp_path):
    with pytest.raises(ValueError):
        lx.build_index(news, str(tmp_path / "ix"), kinds=["triword"])
    with pytest.raises(ValueError):
        lx.bm25(news_index, "oil", variant="other")
    with pytest.raises(ValueError):
        lx.bm25(news_index, "oil", match="fuzzy")
    for query in ("AND oil", "oil AND", "oil gold AND up", "oil AND OR gold", ""):
        with pytest.raises(ValueError):
            lx.boolean_search(news_index, query)
