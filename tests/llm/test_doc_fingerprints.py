import hashlib
import random

import numpy as np
import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from lexmill.llm import doc_fingerprints, queries
from lexmill.llm.doc_fingerprints import fingerprint, likeness, term_hashes, words_of


def plain(rows):
    """The query's columns, one document after the other."""
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")
    rows = sorted(rows, key=key)
    texts = [r["text"] or "" for r in rows]
    prints = [fingerprint(term_hashes(words_of(t))) for t in texts]
    digits = lambda b: "".join(f"{int(v) % 2**64:016x}" for v in b.view("<i8")[::-1])
    found = []
    for i, t in enumerate(texts):
        following = (i + 1) % len(texts)
        cut = len(t) // 4
        edited = t[: len(t) - cut] + texts[following][:cut]
        bits = fingerprint(term_hashes(words_of(edited)))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        near = round(likeness(prints[i], bits), 9), round(likeness(prints[i], prints[following]), 9)
        found.append((rows[i]["doc_id"], len(t), sha, digits(prints[i]), digits(bits), *near))
    return found, prints


def rounded(rows):
    return [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows]


def test_query_matches_brute_force(spark):
    docs = queries.table(spark, SF_DIR, "documents").collect()
    expected, prints = plain(docs)
    rows = queries.op4_doc_fingerprints(spark, SF_DIR).collect()
    assert sorted(rounded(rows)) == sorted(expected)
    ids = np.array([e[0] for e in expected])
    for r in rows:
        if r["doc_id"] % 50:
            assert r["rows_near"] is None and r["first_near"] is None
        else:
            own = prints[int(np.flatnonzero(ids == r["doc_id"])[0])]
            near = [i for i, p in zip(ids, prints) if np.bitwise_count(p ^ own).sum() <= 3]
            assert (r["rows_near"], r["first_near"]) == (len(near), min(near))
    assert sum(e[5] for e in expected) > 2 * sum(e[6] for e in expected)


def test_odd_documents(spark, odd_documents, no_documents):
    rows = doc_fingerprints.compared(odd_documents)
    digits = doc_fingerprints.hex_digits
    shown = rows.select("*", digits("high", "low").alias("fingerprint"), digits("edited_high", "edited_low").alias("edited_fingerprint"))
    assert sorted(map(str, rounded(shown.collect()))) == sorted(map(str, plain(odd_documents.collect())[0]))
    assert doc_fingerprints.compared(no_documents).count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h", 1)], "doc_id long, text string, piece int")
    assert doc_fingerprints.compared(one).collect()[0]["near_next"] == 1.0


@pytest.mark.parametrize("radius,bucket", [(3, 4096), (3, 8), (7, 4096)])
def test_search_matches_all_pairs(spark, monkeypatch, radius, bucket):
    monkeypatch.setattr(doc_fingerprints, "BUCKET", bucket)
    order = random.Random(radius)
    middles = [(order.randrange(-(2**63), 2**63), order.randrange(-(2**63), 2**63)) for _ in range(3)]
    rows = []
    for i in range(400):
        high, low = order.choice(middles)
        for _ in range(order.randrange(4)):
            low ^= 1 << order.randrange(63)
        high ^= order.choice([0, 0, 1 << 40])
        rows.append((None if i == 7 else i, high, low))
    frame = spark.createDataFrame(rows, "doc_id long, high long, low long")
    found = doc_fingerprints.searched(frame, F.col("doc_id") % 5 == 0, radius).collect()
    assert len(found) == len(rows)
    for r in found:
        near = [i for i, h, l in rows if ((h ^ r["high"]) % 2**64).bit_count() + ((l ^ r["low"]) % 2**64).bit_count() <= radius]
        if r["doc_id"] is not None and r["doc_id"] % 5 == 0:
            assert (r["rows_near"], r["first_near"]) == (len(near), min(i for i in near if i is not None))
        else:
            assert r["rows_near"] is None


def test_weights_vote():
    often = fingerprint(term_hashes(words_of("a b c " * 50 + "d e f")))
    assert likeness(often, fingerprint(term_hashes(words_of("a b c " * 50)))) > 0.7
    assert likeness(often, often) == 1.0
    assert not fingerprint(term_hashes([])).any()
