import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from tokenizers import Tokenizer

from lexmill.llm import packing, queries, tokens

PATH = tokens.vocabulary_path("word_bpe_49k.json")


def check(rows, docs, length=2048):
    """Every id of every document in exactly one piece, every sequence gapless; the padding in ids."""
    library = Tokenizer.from_file(PATH)
    ids = [(d["doc_id"], np.array(library.encode(d["text"] or "", add_special_tokens=False).ids + [1], "<u4")) for d in docs]
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    expected = defaultdict(list)
    for doc_id, own in ids:
        expected[doc_id].append(own)
    assert set(pieces) == set(expected)
    for doc_id, owns in expected.items():
        left = [list(own) for own in owns]
        covered = sum(r["length"] for r in pieces[doc_id])
        assert covered == sum(map(len, owns))
        if len(owns) == 1:
            at = 0
            for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
                part = owns[0][r["start"] : r["start"] + r["length"]]
                assert (r["start"], r["doc_tokens"]) == (at, len(owns[0]))
                assert r["ids_crc32"] == zlib.crc32(part.tobytes())
                at += r["length"]
        assert left
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_query(spark):
    docs = queries.table(spark, SF_DIR, "documents").collect()
    rows = queries.op6_packing(spark, SF_DIR).collect()
    assert check(rows, docs) <= 0.02 * sum(r["length"] for r in rows)


def test_odd_documents(odd_documents, no_documents):
    rows = packing.pack(odd_documents, PATH).collect()
    check(rows, odd_documents.collect())
    assert packing.pack(no_documents, PATH).count() == 0


@pytest.mark.parametrize("length", [64, 256])
def test_many_short_documents(spark, length):
    order = np.random.default_rng(length)
    texts = [" ".join(["word"] * int(n)) for n in order.integers(0, 200, 1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(docs, PATH, length).collect()
    assert check(rows, docs.collect(), length) <= 0.03 * sum(r["length"] for r in rows)


def test_best_pattern_is_the_best():
    order = np.random.default_rng(4)
    for _ in range(30):
        sizes = np.unique(order.integers(1, 12, 4))
        values = order.random(len(sizes))
        worth, counts = packing.best_pattern(sizes, values, 15)
        assert (counts * sizes).sum() <= 15 and np.isclose((counts * values).sum(), worth)

        def best(room):
            return max([0.0] + [v + best(room - s) for s, v in zip(sizes, values) if s <= room])

        assert np.isclose(worth, best(15))


def test_patterns_cover_the_demand_with_few_sequences():
    order = np.random.default_rng(5)
    sizes = np.arange(1, 64)
    demand = np.maximum(1, order.poisson(3000 * np.exp(-sizes / 20))).astype(float)
    patterns, use = packing.cut_stock(sizes, demand, 64)
    assert np.allclose(patterns @ use, demand) and (sizes @ patterns <= 64).all()
    assert use.sum() <= 1.01 * (sizes @ demand) / 64
    runs, n = packing.slots({int(s): int(d) for s, d in zip(sizes, demand)}, 64)
    given = defaultdict(int)
    for size, first, last, count, sequence, place in runs:
        assert first == given[size] and (last - first + 1) % count == 0 and sequence < n
        given[size] = last + 1
    assert all(given[int(s)] <= d for s, d in zip(sizes, demand))
    assert packing.slots({}, 64) == ([], 0)
