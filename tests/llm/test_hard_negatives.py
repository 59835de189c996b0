import math
import random

import numpy as np
import pytest
from llm_cases import SF_DIR
from oracle import connect, differences
from pyspark.sql import functions as F

from lexmill.llm import hard_negatives, queries
from lexmill.llm.hard_negatives import Best, Lists

VECTORS = "vec_id long, label int, embedding array<double>, score double, pair long"


def plain(rows, positives=5, negatives=3):
    """All pairs, by the words of the contract."""
    once = {}
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (label, [math.floor(256 * x) for x in vector])
        once[i] = min(once.get(i, row), row)
    found = []
    for anchor, (label, vector) in once.items():
        if anchor % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, own) for i, (own, v) in once.items() if i != anchor)
        for score, i, _ in [s for s in scored if s[2] == label][:positives]:
            window = [s for s in scored if s[2] != label and 50 * -score <= -100 * s[0] <= 95 * -score]
            found += [(anchor, i, rank, j, -score, -s) for rank, (s, j, _) in enumerate(window[:negatives], 1)]
    return sorted(found)


def mined(spark, rows, **more):
    vectors = spark.createDataFrame([(*r, None, 7) for r in rows], VECTORS)
    usable = hard_negatives.usable(vectors)
    return sorted(tuple(r) for r in hard_negatives.mine(usable, F.col("vec_id") % 50 == 0, **more).collect())


def test_query_matches_sql(spark):
    assert differences(queries.op11_hard_negatives(spark, SF_DIR), connect(SF_DIR), queries.SQL["op11_hard_negatives"]) == []


@pytest.mark.parametrize("block,anchors,step", [(8192, 1024, 16), (16, 3, 1)])
def test_blocks_and_ties(spark, monkeypatch, block, anchors, step):
    """Few distinct components, so that many scores tie, over one and over many blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "FIRST_STEP", step)
    order = random.Random(4)
    rows = [(i, order.randrange(3), [order.randrange(-2, 4) / 256 for _ in range(4)]) for i in range(300)]
    expected = plain(rows)
    assert mined(spark, rows) == expected and len(expected) > 20


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (50, 1, [1.0, 1.0]), (50, 1, [1.0, 1.0]), (100, 2, [0.0, 0.0]), (150, 1, []), (200, None, [1.0, 1.0]),
        (250, 1, None), (300, 1, [nan, 1.0]), (350, 1, [1.0, inf]), (400, 1, [None, 1.0]), (None, 1, [1.0, 1.0]), (450, 1, [-1.0, -1.0]),
        (1, 1, [1.0, 0.5]), (2, 2, [0.5, 0.5, 9.0]), (3, 2, [0.25, 1.0]), (4, 3, [1.0]), (5, 3, [0.7, 0.7]), (5, 2, [0.7, 0.6]),
    ]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=1, negatives=1) == plain(rows, 1, 1)
    assert mined(spark, rows[5:11]) == [] and mined(spark, []) == []


def test_large_components_are_exact(spark):
    big = float(2**40)
    rows = [(0, 1, [big, 1.0]), (1, 1, [1.5, 3.0]), (2, 2, [0.75, 5.0]), (3, 2, [0.75, 4.0]), (4, 2, [1.0, 0.0])]
    assert mined(spark, rows) == plain(rows) and len(plain(rows)) == 3


def test_search_stops_early_and_misses_nothing():
    """A skewed block: the search sees a small part of the rows, and the best are the best of all."""
    order = np.random.default_rng(5)
    vectors = order.integers(-5, 6, (4000, 8))
    vectors[:40] *= 200
    lists = Lists(np.arange(4000), np.zeros(4000, dtype=np.int64), vectors)
    for anchor in order.integers(-9, 10, (20, 8)):
        best = Best(3)
        seen = lists.search(anchor, lambda at, scores, best=best: best.offer(at, scores), best.done)
        scores = vectors @ anchor
        assert best.ids.tolist() == np.lexsort((np.arange(4000), -scores))[:3].tolist()
        assert seen < 2000
