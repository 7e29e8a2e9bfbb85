"""Pairs of options by blocks, and sections whose places lie on cell borders."""

from __future__ import annotations

import math

import pytest

from calado.operators import aggregates, spatial


def test_a_place_on_a_border_is_added_up_in_turn(spark):
    site = spark.createDataFrame([(1, 160.0, 0.0, 90.0)], "site long, x double, y double, heading double")
    got = spatial.strip_grid(site, [-40.0], [-125.0]).first()
    turn = math.radians(90.0)
    assert got["px"] == 160.0 + -40.0 * math.sin(turn) + -125.0 * math.cos(turn) < 120
    assert got["py"] == 0.0 + -40.0 * math.cos(turn) - -125.0 * math.sin(turn)


@pytest.mark.parametrize("sparse", [False, True])
def test_separation_by_blocks(spark, sparse):
    rows = [(f"o{o:02d}", s, float(o * s % 17), None if (o + s) % 13 == 0 else float(o * o % 11 + s)) for o in range(40) for s in range(6) if (o + s) % 4]
    rows += [(f"o{o:02d}", 100 + o // 2 + 50 * r, 1.0 * o, 2.0 * r) for o in range(40) for r in range(9)] + [("o03", 2, 5.0, 5.0), ("o04", 2, 6.0, 1.0)] if sparse else []
    df = spark.createDataFrame(rows, "grp string, s long, x double, y double")
    got = aggregates.separation(df, "grp", "s", block=7)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = {}
    for a, s, x, y in rows:
        for b, t, u, v in rows:
            if a < b and s == t:
                d, n = want.get((a, b), (None, 0))
                e = None if y is None or v is None else math.hypot(x - u, y - v)
                want[a, b] = (e if d is None else d if e is None else max(d, e), n + 1)
    found = {(r["a"], r["b"]): (r["separation"], r["chainages"]) for r in got.collect()}
    assert found.keys() == want.keys()
    for k, (d, n) in want.items():
        assert found[k] == (None if d is None else pytest.approx(d), n)
