import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from lexmill.llm import ppm, queries, unigrams

ORDER = ppm.ORDER


def marked(text):
    return [ppm.START] * ORDER + list(text) + [ppm.END]


def plain_trie(texts):
    """Counts of the symbol after every context of up to ORDER symbols."""
    trie = defaultdict(Counter)
    for text in texts:
        row = marked(text)
        for i in range(ORDER, len(row)):
            for k in range(ORDER + 1):
                trie[tuple(row[i - k : i])][row[i]] += 1
    return trie


def plain_score(trie, text):
    """PPM with escape method C and symbol exclusion, symbol by symbol."""
    row, total = marked(text), 0.0
    for i in range(ORDER, len(row)):
        excluded = set()
        for k in range(ORDER, -1, -1):
            seen = trie.get(tuple(row[i - k : i]))
            if seen is None:
                continue
            left = {s: c for s, c in seen.items() if s not in excluded}
            if row[i] in left:
                total += math.log10(left[row[i]] / (sum(left.values()) + len(left)))
                break
            if left:
                total += math.log10(len(left) / (sum(left.values()) + len(left)))
            excluded |= set(seen)
        else:
            total -= math.log10(ppm.SYMBOLS - len(excluded))
    return total


def plain_tokens(text):
    return [*text.split(), b""]


def plain_base(texts, training):
    counts = Counter(t for text in training for t in plain_tokens(text))
    n, v = sum(counts.values()), len(counts)
    for text in texts:
        own = plain_tokens(text)
        yield len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in own)


def is_held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def test_query_against_plain_trie(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode().lower() for r in queries.table(spark, SF_DIR, "documents").collect()}
    found = {r["doc_id"]: r for r in queries.op12_lm_scores(spark, SF_DIR).collect()}
    assert sorted(found) == sorted(docs)
    training = [t for i, t in docs.items() if not is_held_out(i)]
    for (i, text), base in zip(docs.items(), plain_base(docs.values(), training)):
        row = found[i]
        assert row["held_out"] == is_held_out(i)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == base[:3]
        assert row["base_score"] == pytest.approx(base[3], rel=1e-9)
    trie = plain_trie(training)
    shortest = sorted(docs, key=lambda i: len(docs[i]))
    for i in shortest[:60] + shortest[100:110]:
        assert found[i]["score"] == pytest.approx(plain_score(trie, docs[i]), rel=1e-9)
    new = [r for r in found.values() if r["held_out"]]
    assert all(r["score"] < 0 for r in found.values()) and len(new) > 20


@pytest.mark.parametrize("chunk", [2 << 20, 50])
def test_model_in_pieces_gives_the_same(spark, monkeypatch, chunk):
    monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk)
    docs = queries.table(spark, SF_DIR, "documents").select("doc_id", F.col("text").cast("binary").alias("text")).where("doc_id < 120")
    model = ppm.train(docs.where("doc_id % 3 > 0").select("text"))
    at_once = {r["doc_id"]: r["score"] for r in ppm.score(docs, model).collect()}
    pieces = ppm.score(docs, model, most=0, piece_rows=3000)
    assert pieces.columns == ["doc_id", "text", "score"]
    in_pieces = {r["doc_id"]: r["score"] for r in pieces.collect()}
    assert len(at_once) == docs.count() and in_pieces == pytest.approx(at_once, rel=1e-9)


def test_odd_texts(spark, odd_documents, no_documents):
    text = F.col("text").cast("binary")
    docs = odd_documents.withColumn("text", text).withColumn("training", F.col("doc_id") != 8)
    rows = docs.collect()
    model = ppm.train(docs.where("training").select("text"))
    found = unigrams.scored(ppm.score(docs, model)).collect()
    assert len(found) == len(rows)
    training = [bytes(r["text"] or b"") for r in rows if r["training"]]
    trie = plain_trie(training)
    texts = [bytes(r["text"] or b"") for r in rows]
    key = lambda i, n, score: (str(i), n, round(score, 6))
    lowered = [t.lower() for t in texts]
    base = list(plain_base(lowered, [t.lower() for t in training]))
    expected = sorted(key(r["doc_id"], b[0], b[3]) for r, b in zip(rows, base))
    assert sorted(key(r["doc_id"], r["n_tokens"], r["base_score"]) for r in found) == expected
    short = sorted(round(plain_score(trie, t), 6) for t in texts if len(t) < 200)
    scores = sorted(round(r["score"], 6) for r in found)
    assert all(s in scores for s in short)
    nothing = no_documents.withColumn("text", text).withColumn("training", F.lit(True))
    empty = ppm.train(nothing.select("text"))
    assert unigrams.scored(ppm.score(nothing, empty)).count() == 0
    alone = ppm.score(docs.where("doc_id = 3").select("doc_id", "text"), empty).first()["score"]
    assert alone == pytest.approx(-math.log10(255))


def test_probabilities_of_a_context_sum_to_one(spark):
    texts = spark.createDataFrame([("abracadabra abraham",), ("bracket",)], "text string").select(F.col("text").cast("binary"))
    model = ppm.Model.of(ppm.train(texts).toArrow())
    for before in (b"", b"abra", b"zz", b"cad", b"ham"):
        context = ppm.symbols(before)[:-1][-ORDER:]
        rows = [np.append(context, s).astype(np.uint8) for s in range(ppm.SYMBOLS)]
        assert np.exp(model.logs(np.concatenate([ppm.grams(r) for r in rows]))).sum() == pytest.approx(1)


def test_long_text_in_parts(spark, monkeypatch):
    monkeypatch.setattr(unigrams, "SHARD_TOKENS", 50)
    monkeypatch.setattr(ppm, "HELD_GRAMS", 100)
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 64)
    texts = [b" ".join(b"w%d" % (i * k % 37) for i in range(200)) for k in range(1, 9)]
    docs = spark.createDataFrame([(i, t, i != 3) for i, t in enumerate(texts)], "doc_id long, text binary, training boolean")
    found = {r["doc_id"]: r for r in unigrams.scored(ppm.score(docs, ppm.train(docs.where("training").select("text")))).collect()}
    training = [t for i, t in enumerate(texts) if i != 3]
    trie = plain_trie(training)
    for i, base in enumerate(plain_base(texts, training)):
        assert found[i]["base_score"] == pytest.approx(base[3]) and found[i]["score"] == pytest.approx(plain_score(trie, texts[i]))


def test_pieces_are_asked_once_a_shard(spark, monkeypatch):
    """One row goes to a piece and one comes back for each shard of texts, not one for each gram of each text."""
    monkeypatch.setattr(unigrams, "SHARD_TOKENS", 500)
    docs = queries.table(spark, SF_DIR, "documents").where("doc_id < 60").select("doc_id", F.col("text").cast("binary").alias("text"))
    docs = docs.withColumn("training", F.col("doc_id") % 3 > 0)
    model = ppm.train(docs.where("training").select("text"))
    pieces, told = ppm.Pieces(model, piece_rows=3000), []
    answers = pieces.told

    def counted(asked):
        answered = answers(asked).cache()
        told.append((asked.count(), answered.count(), answered.select("shard", "piece").distinct().count()))
        return answered

    pieces.told = counted
    in_pieces = {r["doc_id"]: r for r in unigrams.scored(docs, pieces=pieces).collect()}
    at_once = {r["doc_id"]: r for r in unigrams.scored(docs, ppm.scorer(model)).collect()}
    (shards, rows, places), = told
    assert shards > 1 and rows == places <= shards * pieces.pieces
    for i, row in at_once.items():
        assert in_pieces[i]["score"] == pytest.approx(row["score"], rel=1e-9) and in_pieces[i]["n_known"] == row["n_known"]
        assert in_pieces[i]["base_score"] == pytest.approx(row["base_score"], rel=1e-12)
    assert len(in_pieces) == docs.count()
