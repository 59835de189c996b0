import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF_DIR, no_documents, odd_documents  # noqa: F401
from oracle import connect, differences

from lexmill.llm import collocations, queries
from lexmill.llm.collocations import extended, transform


def plain(rows, least, most_words=5, k=2000):
    """Counting every phrase, by the words of the contract."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for m in range(1, most_words + 1):
                counts.update((lang or "und", tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    kept = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    inside = {}
    for (lang, words), f in kept.items():
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                if j - i < len(words):
                    inside[lang, words[i:j]] = max(f, inside.get((lang, words[i:j]), 0))
    found = {}
    for (lang, words), a in kept.items():
        if 100 * inside.get((lang, words), -1) >= 100 * a:
            continue
        cuts = []
        for at in range(1, len(words)):
            left, right = counts[lang, words[:at]], counts[lang, words[at:]]
            cuts.append((1000 * a * totals[lang] // (left * right), at, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, phrases in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(phrases)[:k], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found_in(docs, least, **more):
    return sorted(tuple(r) for r in collocations.collocations(docs, least, **more).collect())


def test_query_matches_sql(spark):
    # sf0.001 has no phrase of 100 occurrences
    sf_dir = "/root/testdata/sf0.01"
    frame = queries.op13_collocations(spark, sf_dir)
    assert differences(frame, connect(sf_dir), queries.SQL["op13_collocations"]) == [] and frame.count() > 50


@pytest.mark.parametrize("shard_tokens,least,k,broadcast", [(40, 3, 2000, 10**6), (300, 2, 25, 0), (150, 2, 2000, 60)])
def test_against_all_phrases(spark, monkeypatch, shard_tokens, least, k, broadcast):
    """With levels that are broadcast, joined, and first the one and then the other."""
    monkeypatch.setattr(collocations, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(collocations, "BROADCAST_PHRASES", broadcast)
    order = random.Random(8)
    words = "a B c dd é new york Times, of. the; of the\nNew-York \t x! \x85y".split(" ")
    rows = [(order.choice(["en", "de", None]), " ".join(order.choices(words, k=order.randrange(60)))) for _ in range(120)]
    rows += [("en", "one two three four five six seven")] * 5 + [("en", "one two three four")] * 2
    docs = spark.createDataFrame(rows, "lang string, text string")
    expected = plain(rows, least, k=k)
    assert found_in(docs, least, k=k) == expected and len({len(r[2].split()) for r in expected}) >= 3
    if shard_tokens == 40:
        assert found_in(docs, least, most_words=3) == plain(rows, least, 3)


def test_odd_documents(odd_documents, no_documents):
    rows = [(r["lang"], r["text"]) for r in odd_documents.select("lang", "text").collect()]
    assert found_in(odd_documents, 10) == plain(rows, 10)
    assert found_in(no_documents, 1) == []
    with pytest.raises(ValueError):
        collocations.collocations(no_documents, most_words=6)


def test_intervals_are_counts():
    """Both intervals of every phrase of up to five numbers have its count, whichever way it grows."""
    order = np.random.default_rng(2)
    text = np.append(np.append(0, order.integers(0, 4, 400)), 0).astype(np.int32)
    left, right = transform(text), transform(text[::-1])
    starts = np.cumsum(np.bincount(text, minlength=4))
    state = {(w,): (starts[w - 1], starts[w] - starts[w - 1], starts[w - 1]) for w in range(1, 4)}
    for length in range(2, 6):
        phrases = list(state)
        low, size, right_low = (np.array([state[p][i] for p in phrases]) for i in range(3))
        if length % 2:
            parent, number, low, size, right_low = extended(left, low, size, right_low)
            grown = [(int(w), *phrases[p]) for p, w in zip(parent, number)]
        else:
            parent, number, right_low, size, low = extended(right, right_low, size, low)
            grown = [(*phrases[p], int(w)) for p, w in zip(parent, number)]
        state = dict(zip(grown, zip(low, size, right_low)))
        true = Counter(t for t in (tuple(text[i : i + length].tolist()) for i in range(len(text) - length + 1)) if 0 not in t)
        assert {p: s for p, (_, s, _) in state.items()} == true


def test_rare_pairs_are_no_rows(spark, monkeypatch):
    """Of 10,000 pairs of frequent words, those few that a bucket of the hash can hold often enough are counted as rows."""
    counted = []
    monkeypatch.setattr(collocations, "from_words", lambda *a, kept=collocations.from_words, **k: counted.append(kept(*a, **k)) or counted[-1])
    order = random.Random(3)
    words = [f"w{i}" for i in range(100)]
    rows = [("en", " ".join(order.choices(words, k=100))) for _ in range(200)] + [("en", "w1 w2 w3. w2 w3")] * 30
    expected = plain(rows, 30)
    assert found_in(spark.createDataFrame(rows, "lang string, text string"), 30) == expected and len(expected) >= 2
    assert len({(r["prefix"], r["suffix"]) for r in counted[0].collect()}) < 50
