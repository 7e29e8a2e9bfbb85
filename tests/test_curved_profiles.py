"""Profiles under a radius against all vertices of their linear programme."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from calado.operators import windows


def best_deviation(s, z, caps, radius, ties):
    """The least deviation, from every corner of heights and deviation that enough constraints make; None if there is none."""
    n = len(s)
    rows, bound = [], []

    def add(at, b):
        row = np.zeros(n + 1)
        for i, v in at.items():
            row[i] = v
        rows.append(row)
        bound.append(b)

    for i in range(n):
        add({i: 1, n: -1}, z[i])
        add({i: -1, n: -1}, -z[i])
        if ties[i] is not None:
            add({i: 1}, ties[i])
            add({i: -1}, -ties[i])
    h = np.diff(s)
    for i in range(n - 1):
        for sign in (1, -1):
            add({i: sign, i + 1: -sign}, caps[i + 1] * h[i])
    for i in range(1, n - 1):
        for sign in (1, -1):
            add({i - 1: sign / h[i - 1], i: -sign * (1 / h[i - 1] + 1 / h[i]), i + 1: sign / h[i]}, (h[i] + h[i - 1]) / 2 / radius)
    a, b = np.array(rows), np.array(bound)
    pick = np.array(list(combinations(range(len(b)), n + 1)))
    pick = pick[np.abs(np.linalg.det(a[pick])) > 1e-12]
    corner = np.linalg.solve(a[pick], b[pick][..., None])[..., 0]
    good = (corner @ a.T <= b + 1e-7).all(axis=1)
    return corner[good, n].min() if good.any() else None


def lines():
    rng = np.random.default_rng(4)
    out = []
    for g in range(24):
        n = int(rng.integers(2, 5))
        s = np.cumsum(rng.uniform(15, 35, n)) if g % 2 else np.arange(n) * 25.0
        z = rng.uniform(0, 40, n).round(2)
        ties = [None] * n
        if g % 3 == 1:
            ties[int(rng.integers(n))] = float(z.mean())
        if g % 6 == 2:
            ties[0], ties[-1] = float(z[0]), float(z[0] + (200 if g % 12 == 2 else 2))
        out.append([(g, float(x), float(v), i == 1, t) for i, (x, v, t) in enumerate(zip(s, z, ties, strict=True))])
    return out


@pytest.mark.parametrize("radius", [60.0, 1e-3, 1e9])
def test_curved_profiles_are_the_best(spark, radius):
    made = lines()
    df = spark.createDataFrame([r for line in made for r in line], "g int, s double, z double, station boolean, tie double")
    got = {}
    for r in windows.curved_grade(df, ["g"], 0.4, radius, 0.1, F.col("station"), F.col("tie")).collect():
        got.setdefault(r["g"], []).append(r)
    unmet = 0
    for g, line in enumerate(made):
        s, z, ties = ([r[i] for r in line] for i in (1, 2, 4))
        caps = [0.1 if r[3] else 0.4 for r in line]
        want, rows = best_deviation(np.array(s), z, caps, radius, ties), sorted(got[g], key=lambda r: r["s"])
        if want is None:
            unmet += 1
            assert all(r["fit"] is None and r["deviation"] is None for r in rows)
            continue
        assert rows[0]["deviation"] == pytest.approx(want, abs=1e-6)
        fit = np.array([r["fit"] for r in rows])
        grade = np.diff(fit) / np.diff(s)
        assert max(abs(r["residual"]) for r in rows) <= want + 1e-6
        assert (np.abs(grade) <= np.array(caps[1:]) + 1e-7).all()
        assert (np.abs(np.diff(grade)) <= (np.array(s)[2:] - np.array(s)[:-2]) / 2 / radius + 1e-7).all()
        assert all(t is None or f == pytest.approx(t, abs=1e-6) for f, t in zip(fit, ties, strict=True))
    assert unmet >= 1


def test_small_radius_is_the_envelope(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(g, i * 25.0, float(rng.uniform(0, 60))) for g in range(5) for i in range(60)], "g int, s double, z double")
    want = {r["g"]: r["deviation"] for r in windows.minimax_grade(df, ["g"], 0.5, 0.5, F.lit(False)).collect()}
    got = windows.curved_grade(df, ["g"], 0.5, 1e-3).collect()
    assert all(r["deviation"] == pytest.approx(want[r["g"]], abs=1e-6) for r in got) and len(got) == 300


def test_lines_without_ground_are_errors(spark):
    schema = "g int, s double, z double, extra string"
    one = windows.curved_grade(spark.createDataFrame([(None, 5.0, 3.0, "x")], schema), ["g"], 0.5, 100.0).collect()
    assert [tuple(r) for r in one] == [(None, 5.0, 3.0, 3.0, 0.0, 0.0)]
    assert windows.curved_grade(spark.createDataFrame([], schema), ["g"], 0.5, 100.0).collect() == []
    for bad in ([(1, 0.0, None, "x")], [(1, None, 2.0, "x")], [(1, 0.0, float("nan"), "x")], [(1, 0.0, 1.0, "x"), (1, 0.0, 1.0, "x")]):
        with pytest.raises(Exception, match="without ground|at one distance"):
            windows.curved_grade(spark.createDataFrame(bad, schema), ["g"], 0.5, 100.0).collect()
    with pytest.raises(Exception, match="more than 2 rows"):
        windows.curved_grade(spark.createDataFrame([(1, float(i), 1.0, "x") for i in range(3)], schema), ["g"], 0.5, 100.0, most=2).collect()


def test_lines_step_on_together_and_fits_keep_their_bounds(spark):
    """Lines of many lengths in few blocks give the deviations of their own, and no fit leaves its caps, its radius or its deviation."""
    rng = np.random.default_rng(1)
    lines = {}
    for g in range(40):
        n = int(rng.integers(1, 90))
        ties = [float("nan")] * n
        if n > 9:
            ties[9] = 200.0
        lines[g] = [np.arange(1, n + 1) * 25.0, rng.uniform(0, 500, n).round(2), np.array(ties), np.where(rng.random(n) < 0.2, 0.1, 0.5)]
    df = spark.createDataFrame([(g, *map(float, row)) for g, line in lines.items() for row in zip(*line, strict=True)], "g int, s double, z double, tie double, cap double")
    got = {}
    solved = windows.curved_grade(df, ["g"], 0.5, 100.0, 0.1, F.col("cap") < 0.5, F.nanvl("tie", F.lit(None).cast("double")), block=1000)
    assert solved.rdd.getNumPartitions() >= 4
    for r in solved.collect():
        got.setdefault(r["g"], []).append(r)
    for g, (s, z, ties, caps) in lines.items():
        rows = sorted(got[g], key=lambda r: r["s"])
        fit, best = np.array([r["fit"] for r in rows]), rows[0]["deviation"]
        assert len({r["deviation"] for r in rows}) == 1 and max(abs(fit - z)) <= best + 1e-6
        if len(s) == 1:
            continue
        around = [windows._curved_line(s, np.where(np.isnan(ties), z - t, ties), np.where(np.isnan(ties), z + t, ties), caps[1:], 100.0) for t in (best - 1e-6, best + 1e-6)]
        assert around[1] and (not around[0] or best == pytest.approx(windows._curved_deviations(s, z, ties, caps, np.array([0]), np.array([len(s)]), 100.0, 1e-8)[0], abs=1e-6))
        grade = np.diff(fit) / np.diff(s)
        assert (np.abs(grade) <= caps[1:] + 1e-7).all() and (np.abs(np.diff(grade)) <= 0.25 + 1e-7).all()
        assert np.nanmax(np.abs(fit - ties), initial=0.0) <= 1e-6
