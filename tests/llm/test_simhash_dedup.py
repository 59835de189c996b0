import random

import numpy as np
import pytest
import xxhash
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from pyspark.sql import functions as F

from lexmill.llm import queries, simhash_dedup
from lexmill.llm.components import components
from lexmill.llm.simhash_dedup import bits_of, differing, forest, grouped_bits, thresholds


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius):
    """component of each (doc_id, fingerprint) row, comparing all pairs"""
    prints = sorted({p for _, p in rows})
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return {p: least.get(find(p)) for p in prints}


def near_texts(n, seed):
    random.seed(seed)
    base = [" ".join(random.choices("alpha beta gamma delta eps zeta eta theta".split(), k=120)) for _ in range(5)]
    texts = []
    for _ in range(n):
        words = random.choice(base).split()
        for _ in range(random.randrange(4)):
            words[random.randrange(len(words))] = random.choice(["Changed", "other", "x"])
        texts.append(" ".join(words))
    return texts


def test_query_matches_all_pairs(spark):
    docs = {r["doc_id"]: plain_fingerprint(r["text"]) for r in queries.table(spark, SF_DIR, "documents").collect()}
    groups = plain_groups(list(docs.items()), 3)
    found = queries.op1_simhash_dedup(spark, SF_DIR).collect()
    assert len(found) == len(docs)
    for row in found:
        assert row["fingerprint"] == f"{docs[row['doc_id']]:016x}"
        assert row["component_id"] == groups[docs[row["doc_id"]]]


@pytest.mark.parametrize("radius,bucket", [(3, 4096), (8, 4096), (3, 16)])
def test_groups_of_near_texts(spark, monkeypatch, radius, bucket):
    monkeypatch.setattr(simhash_dedup, "BUCKET", bucket)
    texts = near_texts(300, 7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [(i, plain_fingerprint(t)) for i, t in enumerate(texts)]
    groups = plain_groups(rows, radius)
    found = {r["doc_id"]: r["component_id"] for r in simhash_dedup.near_duplicates(docs, radius).collect()}
    assert found == {i: groups[p] for i, p in rows}
    assert len(set(found.values())) < len({p for _, p in rows})


def test_odd_documents(odd_documents):
    found = simhash_dedup.near_duplicates(odd_documents).collect()
    assert len(found) == odd_documents.count()
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in odd_documents.collect()]
    groups = plain_groups(rows, 3)
    expected = sorted((str(i), p, groups[p]) for i, p in rows)
    assert sorted((str(r["doc_id"]), r["fingerprint"] % 2**64, r["component_id"]) for r in found) == expected
    assert groups[0] == 3  # empty, blank and null texts


def test_keep_one(odd_documents, no_documents):
    kept = simhash_dedup.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = sorted((r["doc_id"], (r["text"] or "")[:3]) for r in kept.select("doc_id", "text").collect())
    assert ids == sorted([(1, "The"), (3, ""), (6, "wor"), (7, "one"), (7, "two"), (8, "É p")])
    assert simhash_dedup.keep_one(no_documents).count() == 0
    assert simhash_dedup.near_duplicates(no_documents).count() == 0


def test_keep_one_of_a_large_cluster(spark, monkeypatch):
    """Thousands of distinct near copies of one text, over many chunks of one value, beside texts of their own."""
    monkeypatch.setattr(simhash_dedup, "BUCKET", 64)
    order = random.Random(11)
    base = [f"w{order.randrange(900)}" for _ in range(300)]
    texts = []
    for i in range(2000):
        words = list(base)
        for _ in range(3):
            words[order.randrange(300)] = f"x{i}"
        texts.append(" ".join(words))
    texts += [" ".join(f"own{i}a{k}" for k in range(40)) for i in range(50)]
    prints = [simhash_dedup.fingerprint(t, 3) % 2**64 for t in texts]
    groups = plain_groups(list(enumerate(prints)), 3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in simhash_dedup.keep_one(docs).select("doc_id").collect())
    assert kept == [i for i, p in enumerate(prints) if groups[p] == i]
    assert len(kept) < 1000 < len(set(prints))


@pytest.mark.parametrize("radius,m", [(0, 1), (3, 1), (3, 2), (3, 3), (3, 4), (8, 5), (8, 9)])
def test_thresholds_miss_no_pair(radius, m):
    """Every pair within the radius is within the threshold of some part, whatever the counts are."""
    order = np.random.default_rng(radius * 10 + m)
    prints = order.integers(-(2**63), 2**63, 400)
    bits = bits_of(prints)
    parts = grouped_bits(len(prints), (bits.T.astype(float) @ bits), m)
    assert sorted(b for p in parts for b in p) == list(range(64))
    tables = [
        [order.random((1 << len(block), radius + 1)) for block in simhash_dedup.blocks_of(part)] for part in parts
    ]
    limits = thresholds(bits, parts, tables, radius, 10**6)
    assert ((limits + 1).sum(axis=1) == radius + 1).all() and limits.min() >= -1
    for _ in range(20):
        flips = np.zeros((len(prints), 64), dtype=np.uint8)
        for row in flips:
            row[order.choice(64, radius, replace=False)] = 1
        apart = np.stack([flips[:, part].sum(axis=1) for part in parts], axis=1)
        assert (apart <= limits).any(axis=1).all()


def test_forest_joins_what_is_linked():
    order = np.random.default_rng(3)
    run = np.sort(order.integers(0, 6, 500))
    prints = order.integers(0, 40, 6)[run] ^ (np.int64(1) << order.integers(0, 20, 500)) ^ (np.int64(1) << 63)
    role = order.integers(1, 4, 500)
    a, b = forest(run, prints, role, 2)

    def groups(pairs):
        parent = {p: p for p in prints.tolist()}

        def find(p):
            while parent[p] != p:
                p = parent[p]
            return p

        for x, y in pairs:
            parent[find(x)] = find(y)
        return {frozenset(q for q in parent if find(q) == find(p)) for p in parent}

    true = [
        (int(prints[i]), int(prints[j]))
        for i in range(500)
        for j in range(i + 1, 500)
        if run[i] == run[j]
        and differing(prints[i : i + 1], prints[j : j + 1])[0] <= 2
        and (role[i] & 2 and role[j] & 1 or role[j] & 2 and role[i] & 1)
    ]
    assert groups(zip(a.tolist(), b.tolist())) == groups(true)


def test_components(spark):
    random.seed(5)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)]
    links += [(1000, i) for i in range(1001, 1100)]
    parent = {n: n for pair in links for n in pair}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    found = components(spark.createDataFrame(links, "a long, b long"))
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert {(r["node"], r["root"]) for r in found.collect()} == {(n, find(n)) for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("node")).first()[0] == 0
