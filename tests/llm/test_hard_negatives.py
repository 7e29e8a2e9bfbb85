"""Hard negatives against all scores, with many ties, few positives, several blocks, and rows that take no part."""

from __future__ import annotations

import math
import random

import pytest

from calado.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, every=100, n_pos=5, n_neg=5, low=80, high=100):
    sound = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            w = [math.floor(256 * c) for c in v]
            sound[i] = min(sound.get(i, (label, w)), (label, w))
    out = []
    for a, (label, v) in sound.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, (other, w) in sound.items() if i != a)
        for down, i, _ in [s for s in scored if s[2] == label][:n_pos]:
            fit = [(-d, j) for d, j, other in scored if other != label and -low * down <= -high * d <= -high * down]
            out += [(a, i, r + 1, j, -down, s) for r, (s, j) in enumerate(fit[:n_neg])]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in H.mine_hard_negatives(df, **kw).collect())


@pytest.mark.parametrize("grain", [1, 4, 64])
def test_as_all_scores(spark, grain, monkeypatch):
    """Coarse components give ties at all limits."""
    rng = random.Random(grain)
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), [rng.randrange(-grain, grain + 2) / grain for _ in range(6)]) for i in range(900)]
    want = plain(rows, every=30)
    assert len(want) > 300 and mined(spark, rows, anchor_every=30) == want
    monkeypatch.setattr(H, "_ANCHORS", 8 * 6 * 7)  # several blocks of anchors and of rows, and slices of scores
    monkeypatch.setattr(H, "_ROWS", 8 * 6 * 50)
    monkeypatch.setattr(H, "_RUN", 3)
    monkeypatch.setattr(H, "_SCORES", 8 * 50 * 2)
    assert mined(spark, rows, anchor_every=30) == want
    assert mined(spark, rows, anchor_every=30, n_positives=3, n_negatives=2, low=50, high=200) == plain(rows, 30, 3, 2, 50, 200)


def test_one_vector_of_a_third_of_all_rows(spark):
    rng = random.Random(1)
    rows = [(i, i % 3, [1.0, 0.5] if i % 3 else [rng.random(), rng.random()]) for i in range(1200)]
    assert mined(spark, rows) == plain(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 1.0]), (1, 1, [1.0]), (2, 2, [0.9]), (3, None, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 2, [None, 1.0]), (7, 2, [inf, 1.0]), (8, 2, []), (9, 1, []),
        (10, 2, [0.9]), (10, 2, [0.9]), (11, 1, [-1.0, -1.0]), (12, 2, [-0.9, -0.9]), (100, 7, [1.0, 1.0]), (200, 1, [0.0, 0.0]), (None, 2, [0.95]),
    ]
    want = plain(rows)
    assert mined(spark, rows) == want and {r[0] for r in want} == {0, 200}
    assert H.mine_hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mined(spark, [(1, 1, [1.0])]) == []
    clash = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA + ", score int, slot int, _block string")
    assert sorted(tuple(r) for r in H.mine_hard_negatives(clash).collect()) == want


def test_large_components(spark):
    """Beyond two bytes a component scores are exact; where they would not be, it is an error."""
    rows = [(i * 10, i % 2, [3000.0 + i, -2000.0 - i * i]) for i in range(30)]
    assert mined(spark, rows) == plain(rows) != []
    with pytest.raises(Exception, match="would not be exact"):
        mined(spark, [*rows, (7, 1, [1e30])])
