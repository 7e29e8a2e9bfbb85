"""Printed tables, polygons with holes, contours, nearest sets and k nearest points against plain loops."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from calado.functions import polygons as G
from calado.operators import aggregates, gates, joins, spatial

RINGS = "array<array<struct<x double, y double>>>"


def printed(spark, *pages, **kw):
    rows = [(p, i, line) for p, page in enumerate(pages) for i, line in enumerate(page.split("\n"))]
    out = gates.tables_from_lines(spark.createDataFrame(rows, "page int, line_no int, text string").repartition(3), ["page"], **kw).collect()
    found = {}
    for r in sorted(out, key=lambda r: (r["page"], r["table_no"], r["row_no"], r["column_no"])):
        found.setdefault((r["page"], r["table_no"]), {}).setdefault(r["row_no"], []).append(r["text"])
    return {k: list(v.values()) for k, v in found.items()}


def test_printed_tables(spark):
    page = """Passengers by city, thousands of trips
City            2019    2020
Porto           12.5       8
Vila Real                  3
Braga, centre    7.0     6.1
The source is a survey.
one line
x | y | z
1 |   | 3"""
    got = printed(spark, page, "no table here\n\nat all", "only  one")
    assert got == {(0, 0): [["City", "2019", "2020"], ["Porto", "12.5", "8"], ["Vila Real", "", "3"], ["Braga, centre", "7.0", "6.1"]], (0, 1): [["x", "y", "z"], ["1", "", "3"]]}


def test_heading_across_columns_does_not_join_them(spark):
    lines = ["group      both years together", *[f"city {i}     {i:3d}       {i * 7:4d}" for i in range(1, 9)]]
    got = printed(spark, "\n".join(lines))[0, 0]
    assert got[0] == ["group", "both years together", ""] and got[3] == ["city 3", "3", "21"]


def test_small_or_empty_tables_are_none(spark):
    assert printed(spark, "a  b", "", "a  b\ntext\nc  d") == {}
    assert printed(spark, "a  b\nc  d", least_cells=5) == {} and printed(spark, "a\tb\nc\td") == {(0, 0): [["a", "b"], ["c", "d"]]}


def ring(rng, x, y, r, n):
    """A star-shaped ring, mostly concave."""
    return [(x + math.cos(2 * math.pi * i / n) * (rad := r * rng.uniform(0.3, 1)), y + math.sin(2 * math.pi * i / n) * rad) for i in range(n)]


def parity(rings, x, y):
    odd = False
    for r in rings:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1], strict=True):
            if (ay > y) != (by > y) and x < ax + (y - ay) / (by - ay) * (bx - ax):
                odd = not odd
    return odd


def test_holed_polygons_by_parity(spark):
    rng = random.Random(3)
    shapes = [(i, [ring(rng, cx := rng.uniform(0, 80), cy := rng.uniform(0, 80), 20, 9), ring(rng, cx, cy, 5, 5), ring(rng, cx + 60, cy, 8, 4)]) for i in range(12)]
    points = [(i, rng.uniform(-20, 160), rng.uniform(-20, 110)) for i in range(400)] + [(900, None, 1.0), (901, float("nan"), 1.0)]
    df = spark.createDataFrame([(i, [[{"x": x, "y": y} for x, y in r] for r in rings]) for i, rings in shapes], f"polygon_id int, rings {RINGS}")
    got = {(r["id"], r["polygon_id"]) for r in joins.covers_join(spark.createDataFrame(points, "id int, x double, y double"), df, 15.0).collect()}
    want = {(p, i) for p, x, y in points if x is not None for i, rings in shapes if parity(rings, x, y)}
    assert got == want != set()
    inner = df.select("polygon_id", G.inner_point(G.edges(F.col("rings"))).alias("p")).select("polygon_id", "p.x", "p.y").collect()
    assert all(parity(dict(shapes)[r["polygon_id"]], r["x"], r["y"]) for r in inner) and len(inner) == 12


def test_sides_and_corners_are_covered(spark):
    square, hole = [(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)], [(2, 2), (2, 6), (6, 6), (6, 2)]
    df = spark.createDataFrame([(1, [[{"x": float(x), "y": float(y)} for x, y in r] for r in (square, hole)]), (2, [[{"x": 1.0, "y": 1.0}, {"x": 5.0, "y": 1.0}]])], f"polygon_id int, rings {RINGS}")
    points = [(0, 0.0, 0.0), (1, 8.0, 3.0), (2, 2.0, 4.0), (3, 4.0, 4.0), (4, 6.0, 6.0), (5, 8.5, 3.0), (6, 3.0, 1.0), (7, 7.0, 7.0)]
    got = sorted((r["id"], r["polygon_id"]) for r in joins.covers_join(spark.createDataFrame(points, "id int, x double, y double"), df, 3.0).collect())
    assert got == [(0, 1), (1, 1), (2, 1), (4, 1), (6, 1), (6, 2), (7, 1)]
    inner = {r[0]: r[1] for r in df.select("polygon_id", G.inner_point(G.edges(F.col("rings")))).collect()}
    assert tuple(inner[1]) == (1.0, 4.0) and inner[2] is None


def test_common_area_against_a_fine_grid(spark):
    rng = random.Random(4)
    pairs = [([ring(rng, 10, 10, 9, 11), ring(rng, 10, 10, 2, 5)], [ring(rng, rng.uniform(6, 14), rng.uniform(6, 14), 9, 8)]) for _ in range(6)]
    rows = [(i, *[[[{"x": x, "y": y} for x, y in r] for r in rings] for rings in pair]) for i, pair in enumerate(pairs)]
    out = spark.createDataFrame(rows, f"i int, a {RINGS}, b {RINGS}").select("i", G.overlap_area(G.edges(F.col("a")), G.edges(F.col("b")))).collect()
    step = 0.1
    for i, got in out:
        a, b = pairs[i]
        near = sum(parity(a, (x + 0.5) * step, (y + 0.5) * step) and parity(b, (x + 0.5) * step, (y + 0.5) * step) for x in range(250) for y in range(250)) * step * step
        assert got == pytest.approx(near, abs=1.5), i


def test_contours_15_30_45(spark):
    square = lambda r, x=0.0: [[{"x": x + dx * r, "y": dy * r} for dx, dy in ((-1, -1), (1, -1), (1, 1), (-1, 1))]]
    rows = [("a", 15, square(15.0)), ("a", 30, square(30.0)), ("a", 45, square(45.0)), ("b", 15, square(15.0, 16.0)), ("b", 30, square(30.0)), ("c", 15, square(15.0)), ("c", 30, [square(30.0)[0], square(3.0)[0]])]
    got = {(r["g"], r["level"]): (r["area"], round(r["outside"], 9), r["nested"]) for r in spatial.contour_nesting(spark.createDataFrame(rows, f"g string, level int, rings {RINGS}"), "g", "level").collect()}
    assert got == {("a", 15): (900.0, 0.0, True), ("a", 30): (3600.0, 0.0, True), ("b", 15): (900.0, round(1 / 30, 9), False), ("c", 15): (900.0, 0.04, False)}


def plain_nearest(sets):
    out = {}
    for a, x in sets.items():
        best = min(((-len(x & y) / len(x | y), b, len(x & y)) for b, y in sets.items() if b != a and x & y), default=None)
        out[a] = (len(x), best and best[1], best and best[2], best and round(-best[0], 9))
    return out


@pytest.mark.parametrize("hot", [2, 8, 1000])
def test_nearest_sets(spark, hot):
    """Hot members that all or most sets hold, equal sets, sets of one member, and some that share nothing."""
    rng = random.Random(hot)
    sets = {i: {rng.randrange(40) for _ in range(rng.randrange(1, 9))} | ({100} if i % 2 else set()) | ({101} if i % 3 else set()) for i in range(90)}
    sets |= {200 + i: {100} for i in range(5)} | {300: {100, 900}, 301: {100, 901}, 302: {902}, 303: {100, 101}, 304: set(range(40))} | {400 + i: {100, 101, 500 + i} for i in range(20)}
    rows = [(i, m) for i, members in sets.items() for m in members] * 2 + [(None, 1), (1, None)]
    got = {r["i"]: (r["n"], r["other"], r["common"], None if r["jaccard"] is None else round(r["jaccard"], 9)) for r in aggregates.nearest_set(spark.createDataFrame(rows, "i int, m int"), "i", "m", hot=hot).collect()}
    assert got == plain_nearest(sets)


def test_k_nearest_with_ties(spark):
    rng = random.Random(6)
    a = [(i, rng.randrange(50) * 1.0, rng.randrange(50) * 1.0) for i in range(60)] + [(100, 5000.0, -3000.0), (101, None, 1.0), (102, float("nan"), 2.0)]
    b = [(i, rng.randrange(20) * 3.0, rng.randrange(20) * 3.0) for i in range(70)] + [(200, None, None)]
    A, B = spark.createDataFrame(a, "p int, x double, y double"), spark.createDataFrame(b, "q int, x double, y double")
    for k in (1, 4, 100):
        got = sorted((r["p"], r["rank"], r["q"]) for r in joins.k_nearest(A, B, "p", "q", k, 2.0).collect())
        want = [(p, n + 1, q) for p, x, y in a if x is not None and x == x for n, (_, q) in enumerate(sorted((math.hypot(x - u, y - v), q) for q, u, v in b if u is not None)[:k])]
        assert got == sorted(want)
    assert joins.k_nearest(A, B.limit(0), "p", "q", 3, 2.0).collect() == [] == joins.k_nearest(A.limit(0), B, "p", "q", 3, 2.0).collect()


def test_area_catchment_without_pairs(spark):
    """Equals the sums over all pairs: concave and holed shapes, narrow zones, copies, features without area or weight, and one far larger than the tiles."""
    rng = random.Random(11)
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    features = [(i, [ring(rng, rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(1, 3), 6)], None if i % 7 == 0 else float(i)) for i in range(300)]
    features += [(400 + i, [box(10.0, 10.0, 14.0, 14.0), box(11.0, 11.0, 13.0, 13.0)[::-1]], 2.0) for i in range(20)]
    features += [(500, [box(5.0, 5.0, 5.0, 5.0)], 9.0), (501, [box(-50.0, -50.0, 90.0, 80.0)], 1000.0), (502, [[(20.0, 0.0), (20.0, 30.0)]], 4.0)]
    zones = [(i, [ring(rng, cx := rng.uniform(0, 60), cy := rng.uniform(0, 60), 25, 9), ring(rng, cx, cy, 4, 5)]) for i in range(12)]
    zones += [(20, [box(30.0, -20.0, 30.2, 70.0)]), (21, [box(-9.0, -9.0, 70.0, 70.0), box(12.0, 20.0, 40.0, 20.5)]), (22, [box(200.0, 0.0, 210.0, 9.0)]), (23, [box(0.0, 0.0, 12.0, 12.0), box(6.0, 6.0, 18.0, 18.0)])]
    at = lambda rings: [[{"x": x, "y": y} for x, y in r] for r in rings]
    A = spark.createDataFrame([(i, at(r), w) for i, r, w in features], f"id int, rings {RINGS}, w double")
    B = spark.createDataFrame([(i, at(r)) for i, r in zones], f"polygon_id int, rings {RINGS}")
    cut = aggregates.cut_features(A, B, "id", "w", 10.0).withColumn("cut_area", F.when(F.col("cut_area") > 1e-9, F.col("cut_area")).otherwise(0.0))
    want = {r["polygon_id"]: r for r in aggregates.area_catchment(cut, ["polygon_id"], "area", "cut_area", "w").collect()}
    for width in (3.0, 25.0):
        found = aggregates.area_catchment_of(A, B, "w", width)
        got = {r["polygon_id"]: r for r in found.collect()}
        assert set(got) == set(want) and 22 not in got
        for k, r in want.items():
            assert got[k][1:4] == r[1:4] and got[k]["people"] == pytest.approx(r["people"], rel=1e-9), k
    alone = aggregates.area_catchment_of(A.where("w IS NULL"), B.where("polygon_id = 21"), "w", 9.0).first()
    assert alone["people"] is None and alone["intersecting"] == 43 == alone["met"]
    assert aggregates.area_catchment_of(A.limit(0), B, "w", 9.0).collect() == [] == aggregates.area_catchment_of(A, B.limit(0), "w", 9.0).collect()


def test_area_catchment_query_makes_no_pairs(spark):
    """One row a zone and block comes from the tiles: the plan has no row for a feature and a zone."""
    from calado.plans import registry

    plan = registry.queries()["A03_area_catchment"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "cut_area" not in plan


def test_printed_pages_in_arrays_as_by_windows(spark):
    """Random pages of blanks, bars, tabs and letters of several bytes, empty and null lines, gaps between lines and a page without a name: found in arrays, over
    several batches, as by windows."""
    rng = random.Random(13)
    parts = ["a", "é", "日本", "x y", " ", "  ", "   ", "|", " | ", "\t", "12,5", "𝛼", "\n"]
    rows = [(None if p == 7 else f"p{p % 60}", p // 60 * 1000 + i * (2 if rng.random() < 0.03 else 1), None if rng.random() < 0.02 else "".join(rng.choices(parts, k=rng.randrange(0, 12)))) for p in range(120) for i in range(rng.randrange(1, 25))]
    rows = list({r[:2]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "page string, line_no int, text string").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        for kw in ({}, {"least_rows": 3, "least_columns": 3, "spanning": 0.6}, {"least_rows": 1, "least_columns": 1, "least_cells": 1, "spanning": 0.0}):
            found = gates.tables_from_lines(df, ["page"], **kw)
            assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
            got = sorted(map(tuple, found.collect()), key=str)
            assert got == sorted(map(tuple, gates.tables_from_lines(df, ["page"], most_lines=0, **kw).collect()), key=str) != []
            assert got == sorted(map(tuple, gates.tables_from_lines(df, ["page"], most_lines=20, **kw).collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
