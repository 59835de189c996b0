"""Archives, news XML, line files, saved indexes."""

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

import lexmill as lx
from lexmill.sinks import posting_lines
from lexmill.sources import archives
from lexmill.sources.archives import DamagedArchive, archive_entries
from lexmill.sources.news import parse_item


def item(item_id, title="T", headline="H", text="X", root="newsitem"):
    return (
        f'<?xml version="1.0" encoding="UTF-8"?><{root} itemid="{item_id}"><title>{title}</title>'
        f"<headline>{headline}</headline><text>{text}</text></{root}>"
    ).encode()


def zipped(entries, method=zipfile.ZIP_DEFLATED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as archive:
        for name, content in entries:
            archive.writestr(name, content)
    return buffer.getvalue()


class Unseekable(io.RawIOBase):
    """Makes zipfile write sizes into data descriptors."""

    def __init__(self):
        self.data = b""

    def writable(self):
        return True

    def write(self, chunk):
        self.data += bytes(chunk)
        return len(chunk)


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_archive_entries(method):
    entries = [("a.xml", b"one" * 500), ("empty/", b""), ("b.xml", bytes(range(256)))]
    assert list(archive_entries(zipped(entries, method))) == entries


def test_archive_with_data_descriptors():
    stream = Unseekable()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("a", b"first" * 99)
        archive.writestr("b", b"second")
    assert list(archive_entries(stream.data)) == [("a", b"first" * 99), ("b", b"second")]


def test_damaged_archives():
    entries = [("a", b"one" * 100), ("b", bytes(range(256)) * 8)]
    whole = zipped(entries, zipfile.ZIP_STORED)
    second = whole.index(b"PK\x03\x04", 4)
    truncated = whole[: second + 200]
    assert list(archive_entries(truncated, lenient=True)) == entries[:1]
    with pytest.raises(DamagedArchive):
        list(archive_entries(truncated))
    flipped = bytearray(whole)
    flipped[second + 100] ^= 255
    assert list(archive_entries(bytes(flipped), lenient=True)) == entries[:1]
    with pytest.raises(DamagedArchive):
        list(archive_entries(bytes(flipped)))
    deflated = zipped(entries)
    assert list(archive_entries(deflated[: deflated.index(b"PK\x03\x04", 4) + 40], lenient=True)) == entries[:1]
    for empty in (zipped([]), b"no archive at all, but some bytes here"):
        assert list(archive_entries(empty)) == []
    for nothing in (b"", b"P", b"PK", b"PK\x03"):
        damage = []
        assert list(archive_entries(nothing, True, damage)) == [] and len(damage) == 1
        with pytest.raises(DamagedArchive):
            list(archive_entries(nothing))


def test_archives_that_end_too_early():
    entries = [("a", b"one" * 100), ("b", b"two" * 100), ("c", b"three")]
    whole = zipped(entries)
    second = whole.index(b"PK\x03\x04", 4)
    third = whole.index(b"PK\x03\x04", second + 4)
    directory = whole.index(b"PK\x01\x02")
    for cut, n in ((second, 1), (second + 10, 1), (third, 2), (directory, 3), (directory + 2, 3)):
        damage = []
        assert list(archive_entries(whole[:cut], True, damage)) == entries[:n]
        assert len(damage) == 1
        with pytest.raises(DamagedArchive):
            list(archive_entries(whole[:cut]))
    damage = []
    assert list(archive_entries(whole, True, damage)) == entries and damage == []


@pytest.mark.parametrize("zip64", [False, True])
def test_streamed_archives(zip64):
    """Sizes after the content, of 4 or 8 bytes."""

    class Stream(io.BytesIO):
        def seekable(self):
            return False

        def seek(self, *place):
            raise io.UnsupportedOperation

        def tell(self):
            raise io.UnsupportedOperation

    entries = [(f"{i}", bytes([65 + i]) * 1000) for i in range(3)]
    stream = Stream()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries:
            with archive.open(name, "w", force_zip64=zip64) as entry:
                entry.write(content)
    assert list(archive_entries(stream.getvalue())) == entries


def test_cut_archive_is_a_bad_record_that_does_not_count(spark, tmp_path):
    data = zipped([(f"{i}newsML.xml", item(i)) for i in range(3)])
    (tmp_path / "zips").mkdir()
    (tmp_path / "zips" / "cut.zip").write_bytes(data[: data.index(b"PK\x03\x04", 4)])
    (tmp_path / "zips" / "nothing.zip").write_bytes(b"PK")
    ix, documents, bad = lx.index_archives(spark, str(tmp_path / "zips"), str(tmp_path / "index"), lenient=True)
    assert documents.count() == 1 and ix.stats.n_docs == 1
    records = bad.collect()
    assert len(records) == 2 and all(r.entry_name is None and r.error.startswith("archive cut short") for r in records)
    with pytest.raises(Exception, match="nothing.zip|cut.zip"):
        lx.read_zips(spark, str(tmp_path / "zips"))


def test_large_central_header_is_not_an_entry():
    name = b"n" * 40
    header = struct.pack("<4s5H3I2H", b"PK\x03\x04", 20, 1, 8, 0, 0, 0, 0, 0, len(name), 0)
    with pytest.raises(DamagedArchive):
        list(archive_entries(header + name))


def test_read_zips(spark, tmp_path):
    for n in range(2):
        (tmp_path / f"{n}.zip").write_bytes(zipped([(f"{n}{i}newsML.xml", item(10 * n + i)) for i in range(3)]))
    (tmp_path / "other.txt").write_text("not an archive")
    entries = lx.read_zips(spark, str(tmp_path))
    assert {r.entry_name for r in entries.collect()} == {f"{n}{i}newsML.xml" for n in range(2) for i in range(3)}
    assert entries.select("zip_path").distinct().count() == 2


def test_read_zips_lenient_and_strict(spark, tmp_path):
    data = zipped([("a", item(1)), ("b", item(2))], zipfile.ZIP_STORED)
    (tmp_path / "cut.zip").write_bytes(data[: data.index(b"PK\x03\x04", 4) + 60])
    assert [r.entry_name for r in lx.read_zips(spark, str(tmp_path), lenient=True).collect()] == ["a"]
    with pytest.raises(Exception, match="archive ends inside"):
        lx.read_zips(spark, str(tmp_path)).collect()


def test_large_sparse_archive(spark, tmp_path, monkeypatch):
    """Entries five gigabytes apart, past 32-bit offsets, in ranges of their own; the hole takes no disk."""
    monkeypatch.setattr(archives, "RANGE_BYTES", 2000)
    entries = [(f"{i}.xml", bytes([65 + i]) * 1500) for i in range(6)]
    with zipfile.ZipFile(tmp_path / "sparse.zip", "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
        for i, (name, content) in enumerate(entries):
            archive.writestr(name, content)
            if i == 2:
                archive.start_dir += 5 << 30
    assert (tmp_path / "sparse.zip").stat().st_size > 5 << 30
    found = archives.catalogue(spark, str(tmp_path))
    assert found.select("range").distinct().count() > 2
    assert [(r.entry_name, bytes(r.content)) for r in lx.read_zips(spark, str(tmp_path)).orderBy("entry_name").collect()] == entries
    assert lx.read_zips(spark, str(tmp_path), lenient=True).count() == 6


def test_lenient_reading_ends_at_the_first_damage_over_all_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "RANGE_BYTES", 700)
    entries = [(f"{i}", bytes([65 + i]) * 600) for i in range(8)]
    data = bytearray(zipped(entries, zipfile.ZIP_STORED))
    for i in (6, 3):
        data[data.index(entries[i][1]) + 5] ^= 1
    (tmp_path / "a.zip").write_bytes(bytes(data))
    (tmp_path / "b.zip").write_bytes(zipped(entries))
    lenient = lx.read_zips(spark, str(tmp_path), lenient=True).collect()
    names = {path: sorted(r.entry_name for r in lenient if r.zip_path.endswith(path)) for path in ("a.zip", "b.zip")}
    assert names == {"a.zip": ["0", "1", "2"], "b.zip": [str(i) for i in range(8)]}
    (end,) = archives.catalogue(spark, str(tmp_path), lenient=True).where("name is null").collect()
    assert end.path.endswith("a.zip") and end.number == 3 and "checksum" in end.damage
    with pytest.raises(Exception, match="a.zip: checksum mismatch"):
        lx.read_zips(spark, str(tmp_path)).collect()


def test_walk_reads_zip64_sizes_of_a_cut_archive():
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(3):
            with archive.open(f"{i}", "w", force_zip64=True) as entry:
                entry.write(b"wide" * 100)
    whole = stream.getvalue()
    damage = []
    cut = whole[: whole.index(b"PK\x01\x02") - 20]
    assert [n for n, _ in archive_entries(cut, True, damage)] == ["0", "1"] and "ends inside" in damage[0]


def test_files_of_their_own_names(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [("a.txt", b"one"), ("deep/b.txt", b"\x00two"), ("empty.txt", None)]
    lx.write_files(spark.createDataFrame(rows, "name string, content binary"), path)
    lx.write_files(spark.createDataFrame([("a.txt", "three")], "name string, content string"), path)
    found = {p.relative_to(path).as_posix(): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert found == {"a.txt": b"three", "deep/b.txt": b"\x00two", "empty.txt": b""}
    for name in ("../x", "/x", None, "_temporary/x"):
        with pytest.raises(Exception, match="not a file name"):
            lx.write_files(spark.createDataFrame([(name, b"x")], "name string, content binary"), path)
    assert not (tmp_path / "out" / "_temporary").exists()


def test_parse_item_fields():
    content = item(7, " A &amp; B ", "Head", '<p>one "two"</p> <p>three <![CDATA[<4>]]></p><!-- no -->')
    assert parse_item(content) == (7, " A & B ", "Head", 'one "two" three <4>', None)


def test_parse_item_first_descendant_and_last_item():
    inner = "<x><title>first</title></x><title>second</title><headline>h</headline><text>t<title>u</title></text>"
    content = f'<r><newsitem itemid="1">{inner}</newsitem><newsitem itemid="+2">{inner}</newsitem></r>'.encode()
    assert parse_item(content) == (2, "first", "h", "tu", None)


def test_parse_item_stops_at_first_bad_item():
    good = item(1).split(b"?>")[1]
    bad = b'<newsitem itemid="2"><title>t</title></newsitem>'
    assert parse_item(b"<r>" + good + bad + good.replace(b'"1"', b'"3"') + b"</r>")[0] == 1
    assert parse_item(b"<r>" + bad + good + b"</r>")[4] == "missing headline"


@pytest.mark.parametrize(
    ("content", "error"),
    [
        (b"", "malformed XML"),
        (item(1)[:-3], "malformed XML"),
        (item(1) + b"<again/>", "malformed XML"),
        (b'<?xml version="1.0" encoding="no-such"?><a/>', "malformed XML"),
        (b"<a/>", "no news item"),
        (item("x"), "bad item id"),
        (item(""), "bad item id"),
        (item(2**63), "bad item id"),
    ],
)
def test_parse_item_errors(content, error):
    parsed = parse_item(content)
    assert parsed[:4] == (None,) * 4 and parsed[4].startswith(error)


def test_parse_item_encodings():
    for encoding in ("ISO-8859-1", "UTF-16", "windows-1252"):
        content = item(3, "Été", root="newsitem").decode().replace("UTF-8", encoding).encode(encoding)
        assert parse_item(content)[1] == "Été"
    assert parse_item(b"\xef\xbb\xbf" + item(3, "Été"))[1] == "Été"


def test_parse_news(spark, tmp_path):
    (tmp_path / "n.zip").write_bytes(zipped([("a", item(1)), ("b", b"<bad"), ("dir/", b"")]))
    documents, bad = lx.parse_news(lx.read_zips(spark, str(tmp_path)))
    assert [(r.doc_id, r.doc_name, r.text) for r in documents.collect()] == [(1, "1newsML.xml", "X")]
    assert {r.entry_name for r in bad.collect()} == {"b", "dir/"}


@pytest.mark.parametrize("partitions", [None, 3])
def test_index_archives(spark, tmp_path, partitions):
    entries = [("2newsML.xml", item(2, "Oil prices", "Oil up", "Oil rises. The oil, market")), ("b", b"<bad")]
    (tmp_path / "n.zip").write_bytes(zipped(entries))
    stops = spark.createDataFrame([("the",)], "word string")
    index, documents, bad = lx.index_archives(
        spark, str(tmp_path), str(tmp_path / "ix"), stops, partitions=partitions, include_id_token=True, shards=2
    )
    assert (documents.count(), bad.count()) == (1, 1)
    assert (index.stats.n_docs, index.stats.total_len, index.stats.avg_len) == (2, 8, 4)
    hits = lx.hydrate(lx.search(index, "oil and market", 1), documents)
    assert [r.manifest for r in hits.collect()] == ["2newsML.txt;Oil up"]


def test_stop_words_end_at_first_blank_line(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_bytes(b"the\r\n and \nof\n  \nnot\n")
    assert [r.word for r in lx.read_stop_words(spark, str(path)).collect()] == ["the", " and ", "of"]
    path.write_bytes(b"one\ntwo")
    assert [r.word for r in lx.read_stop_words(spark, str(path)).collect()] == ["one", "two"]
    path.write_bytes(b"\nnone\n")
    assert lx.read_stop_words(spark, str(path)).collect() == []


def test_corpus_stats_line(spark, news_index, tmp_path):
    lx.write_corpus_stats(news_index.corpus_stats, str(tmp_path / "stats"))
    assert [tuple(r) for r in lx.read_corpus_stats(spark, str(tmp_path / "stats")).collect()] == [(2, 7)]
    (tmp_path / "two.txt").write_text("1\t2\n3\t4\n\n5\t6\n")
    assert [tuple(r) for r in lx.read_corpus_stats(spark, str(tmp_path / "two.txt")).collect()] == [(3, 4)]


def test_text_index_round_trip(spark, news_index, tmp_path):
    path = str(tmp_path / "lines")
    lx.write_lines(lx.positional_lines(news_index.postings, news_index.terms), path, files=4)
    back = lx.read_posting_lines(spark, path)
    key = ["term", "doc_id", "tf", "doc_len", "positions"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, news_index.postings.select(key).collect()))
    for part in (tmp_path / "lines").glob("part-*"):
        terms = [line.split("\t")[0].rsplit(":", 1)[0] for line in part.read_text().splitlines()]
        assert terms == sorted(terms)


def test_key_lines_round_trip(spark, news_index):
    df = lx.document_frequency(news_index.biwords, "biword")
    back = lx.from_posting_lines(lx.key_lines(news_index.biwords, df, "biword"))
    assert {(r.term, r.doc_id) for r in back.collect()} == {(r.biword, r.doc_id) for r in news_index.biwords.collect()}
    assert back.where(F.col("tf").isNotNull()).count() == 0


def test_terms_with_separators_survive_lines(spark):
    docs = spark.createDataFrame([(1, "10:30 a;b c<d>"), (2, "10:30 10:30")], "doc_id long, text string")
    postings = lx.positional_postings(docs)
    back = lx.from_posting_lines(lx.positional_lines(postings, lx.document_frequency(postings)))
    assert {(r.term, r.df, r.doc_id, tuple(r.positions)) for r in back.collect()} == {
        ("10:30", 2, 1, (1,)), ("10:30", 2, 2, (1, 2)), ("a;b", 1, 1, (2,)), ("c<d>", 1, 1, (3,)),
    }


def test_hot_terms_take_several_lines(spark):
    postings = spark.range(250).select(
        F.lit("hot").alias("term"), F.col("id").alias("doc_id"), F.lit(1).alias("tf"), F.lit(1).alias("doc_len"),
        F.array(F.lit(1)).alias("positions"),
    )
    lines = lx.positional_lines(postings, lx.document_frequency(postings), per_line=50).collect()
    assert len(lines) == 5 and all(r.line.startswith("hot:250\t") for r in lines)
    back = lx.from_posting_lines(spark.createDataFrame(lines))
    assert {r.doc_id for r in back.collect()} == set(range(250))


def test_lists_that_fit_memory_are_cut_without_ranks(spark, monkeypatch):
    """Short lines do not make terms hot; the lines are those of ranked postings."""
    postings = spark.range(400).select(
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("term"), (F.col("id") * 7).alias("doc_id"), F.lit(1).alias("tf"),
        F.lit(4).alias("doc_len"), F.array(F.lit(2)).alias("positions"),
    )
    terms = lx.document_frequency(postings)

    def lines():
        return sorted(tuple(r) for r in lx.positional_lines(postings, terms, per_line=50).collect())

    def none(*args, **options):
        raise AssertionError("ranked")

    monkeypatch.setattr(posting_lines, "POSTINGS_IN_MEMORY", 60)
    ranked = lines()
    monkeypatch.undo()
    monkeypatch.setattr(posting_lines, "ranked", none)
    assert lines() == ranked and len(ranked) == 9


def test_long_lines_are_split_once(spark):
    """What is read off a line is read ahead of its postings: a line of many postings costs no more for each."""
    text = "hot:3\t" + "".join(f"{i}:2:9<1, {i}>; " for i in range(20_000)) + "7; x; 8:1:4<>;  9:1:2<3>"
    rows = lx.from_posting_lines(spark.createDataFrame([(text,), ("no line",)], "line string"))
    above, below = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate ", 1)
    assert "line#" not in above and "line#" not in below.split("\n", 1)[0]
    found = [(r.term, r.df, r.doc_id, r.tf, r.doc_len, r.positions) for r in rows.collect()]
    assert found[:20_000] == [("hot", 3, i, 2, 9, [1, i]) for i in range(20_000)]
    assert found[20_000:] == [("hot", 3, 7, None, None, None), ("hot", 3, 8, 1, 4, None), ("hot", 3, 9, 1, 2, [3])]


def test_load_equals_built(spark, news, tmp_path):
    path = str(tmp_path / "ix")
    built = lx.build_index(news, path, ["the"], shards=3)
    loaded = lx.Index.load(spark, path)
    for name in ("postings", "terms", "biwords", "doc_stats", "corpus_stats"):
        assert sorted(map(str, getattr(loaded, name).collect())) == sorted(map(str, getattr(built, name).collect()))
    assert loaded.shards == 3


def test_catalog_tables(spark, news_index):
    news_index.save_tables("news_test", buckets=4)
    index = lx.Index.from_tables(spark, "news_test")
    assert {r.doc_id for r in lx.boolean_search(index, "oil AND gold").collect()} == {10}
    expected = [tuple(r) for r in lx.bm25(news_index, "oil gold").orderBy("rank").collect()]
    assert [tuple(r) for r in lx.bm25(index, "oil gold").orderBy("rank").collect()] == expected
    counted = index.postings.where("term = 'oil'").groupBy("term").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 1 out of 4" in plan and "Exchange" not in plan


def test_write_hits_and_documents(spark, news, news_index, tmp_path):
    hits = lx.bm25(news_index, "oil gold")
    for style in ("parquet", "names", "scores", "ids"):
        lx.write_hits(hits, str(tmp_path / style), style)
    ranked = [r.doc_id for r in hits.orderBy("rank").collect()]

    def written(name):
        return [line for p in sorted((tmp_path / name).glob("part-*")) for line in p.read_text().splitlines()]

    assert spark.read.parquet(str(tmp_path / "parquet")).count() == len(ranked)
    assert written("names") == [f"{i}newsML.xml" for i in ranked]
    assert written("ids") == [str(i) for i in ranked]
    assert [line.split("\t")[0] for line in written("scores")] == written("names")
    with pytest.raises(ValueError):
        lx.write_hits(hits, str(tmp_path / "x"), "pages")
    lx.write_documents(lx.hydrate(hits, news), str(tmp_path / "table"))
    stored = spark.read.parquet(str(tmp_path / "table" / "text")).collect()
    assert ("10newsML.txt", "Gold flat\n\nGold and oil - steady") in [tuple(r) for r in stored]
    lx.write_documents(lx.hydrate(hits, news), str(tmp_path / "out"), per_file=True)
    assert (tmp_path / "out" / "text" / "10newsML.txt").read_text() == "Gold flat\n\nGold and oil - steady"
    assert written("out/manifest")[0].endswith("newsML.txt;Gold flat")


def test_search_over_a_text_index(spark, news_index, tmp_path):
    lines, stats = str(tmp_path / "lines"), str(tmp_path / "stats")
    lx.write_lines(lx.positional_lines(news_index.postings, news_index.terms, "reference"), lines, files=2)
    lx.write_corpus_stats(news_index.corpus_stats, stats)
    index = lx.Index.from_lines(spark, lines, stats)
    for search in (lx.bm25, lx.tfidf):
        expected = [tuple(r) for r in search(news_index, "oil gold", variant="reference").collect()]
        assert [tuple(r) for r in search(index, "oil gold", variant="reference").collect()] == expected
    assert {r.doc_id for r in lx.boolean_search(index, "oil ANDNOT gold").collect()} == {2}
    uniwords = str(tmp_path / "uniwords")
    lx.write_lines(lx.key_lines(news_index.uniwords, news_index.terms), uniwords, files=2)
    index = lx.Index.from_lines(spark, uniwords)
    assert {r.doc_id for r in lx.boolean_search(index, "oil OR gold").collect()} == {2, 10}
    assert index.stats.n_docs == 2


def test_given_stats_replace_those_of_the_index(spark, news_index):
    stats = spark.createDataFrame([(200, 7)], "n_docs long, avg_len long")
    assert lx.bm25(news_index, "oil", stats=stats).count() == 2
    assert lx.bm25(news_index, "oil", variant="reference", stats=stats).count() == 2
