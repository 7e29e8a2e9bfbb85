"""What A29 sends for its pairs of blocks."""

from __future__ import annotations

import math

import pytest

from calado.operators import aggregates


def test_blocks_are_sent_not_rows(spark):
    """Before, each row was shuffled once for each block."""
    rows = [(o, s, float(o * s % 17), float(o * o % 11 + s)) for o in range(60) for s in range(5) if (o + s) % 4]
    df = spark.createDataFrame(rows, "grp int, s long, x double, y double")
    got = aggregates.separation(df, "grp", "s", block=9)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("FlatMapGroupsInArrow") < plan.index("Generate explode") < plan.index("MapInArrow")
    at = {(o, s): (x, y) for o, s, x, y in rows}
    want = {}
    for a in range(60):
        for b in range(a + 1, 60):
            met = [math.dist(at[a, s], at[b, s]) for s in range(5) if (a, s) in at and (b, s) in at]
            if met:
                want[a, b] = (pytest.approx(max(met)), len(met))
    assert {(r["a"], r["b"]): (r["separation"], r["chainages"]) for r in got.collect()} == want
    assert aggregates.separation(df.limit(0), "grp", "s").collect() == []
