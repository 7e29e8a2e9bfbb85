"""Joins of places where many rows lie in few cells, against the plain pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from calado.operators import aggregates, joins, spatial


@pytest.fixture(scope="module")
def crowd(spark):
    rng = np.random.default_rng(7)
    xy = rng.integers(0, 60, (900, 2)) / 2
    return [(i, float(x), float(y), None if i % 11 == 0 else float(i % 7)) for i, (x, y) in enumerate(xy)]


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double, w double").coalesce(1)


def rects(spark, n=300):
    rng = np.random.default_rng(9)
    rows = [(i, float(x), float(y), float(x + 1 + i % 9), float(y + 1 + i % 5)) for i, (x, y) in enumerate(rng.integers(0, 30, (n, 2)))]
    return spark.createDataFrame(rows, "rect long, xmin double, ymin double, xmax double, ymax double").coalesce(1), rows


def test_blocks_bound_a_key_and_keep_all_pairs(spark):
    a, b = spark.range(1000).selectExpr("0 AS k", "id AS a"), spark.range(700).selectExpr("0 AS k", "id AS b")
    left, right, tasks = joins.blocks(a, b, ["k"], (100, 100))
    assert left.groupBy("_i", "_j").count().agg(F.max("count")).first()[0] < 200 and tasks >= 4
    assert left.join(right, ["k", "_i", "_j"]).select("a", "b").distinct().count() == left.join(right, ["k", "_i", "_j"]).count() == 700_000


def test_polygon_joins_are_spread_and_equal_the_plane(spark, crowd):
    zones = spark.createDataFrame([(i, float(3 * i % 29), float(7 * i % 31), 2.0 + i % 6) for i in range(40)], "polygon_id long, x double, y double, r double")
    corner = lambda dx, dy: F.struct((F.col("x") + dx * F.col("r")).alias("x"), (F.col("y") + dy * F.col("r")).alias("y"))
    ring = lambda k: F.array(corner(k, 0), corner(0, k), corner(-k, 0), corner(0, -k))
    shapes = zones.withColumn("rings", F.array(ring(1), ring(0.5))).withColumn("ring", ring(1)).coalesce(1)
    away = {(z["polygon_id"], p[0]): (abs(p[1] - z["x"]) + abs(p[2] - z["y"])) / z["r"] for z in zones.collect() for p in crowd}
    got = joins.covers_join(points(spark, crowd).select("id", "x", "y"), shapes, 100.0)
    assert got.rdd.getNumPartitions() >= 4
    assert sorted((r["polygon_id"], r["id"]) for r in got.collect()) == sorted(k for k, v in away.items() if 0.5 <= v <= 1)
    inner = joins.pip_join(points(spark, crowd).selectExpr("id", "x + 0.01 AS x", "y + 0.003 AS y"), shapes, 100.0)
    moved = {(z["polygon_id"], p[0]): abs(p[1] + 0.01 - z["x"]) + abs(p[2] + 0.003 - z["y"]) < z["r"] for z in zones.collect() for p in crowd}
    assert inner.rdd.getNumPartitions() >= 4
    assert sorted((r["polygon_id"], r["id"]) for r in inner.collect()) == sorted(k for k, v in moved.items() if v)


@pytest.mark.parametrize("groups", [25, 4])
def test_catchment_of_dense_places(spark, crowd, groups):
    rows = crowd + [(5, 29.0, 29.0, 5.0), (6, 1.0, 1.0, 6.0), (6, 1.0, 1.0, 6.0), (2000, None, 3.0, 1.0)]
    centres = [(i % groups, float(5 * i % 31), float(11 * i % 29)) for i in range(25)]
    got = aggregates.catchment(spark.createDataFrame(centres, "zone long, x double, y double"), points(spark, rows), ["zone"], "id", "w", 9.0)
    want = {}
    for z, x, y in centres:
        for i, px, py, w in rows:
            if px is not None and (px - x) ** 2 + (py - y) ** 2 <= 81:
                want.setdefault(z, set()).add((i, w))
    assert {r["zone"]: (r["features"], r["people"], r["unknown"]) for r in got.collect()} == {z: (len(v), sum(w or 0 for _, w in v), sum(w is None for _, w in v)) for z, v in want.items()}


def test_catchment_asks_edges_only(spark, crowd, monkeypatch):
    """Places in cells that a zone reaches wholly are not met one by one."""
    met = []
    plain = aggregates.cell_join
    monkeypatch.setattr(aggregates, "cell_join", lambda a, b: met.append(plain(a, b)) or met[-1])
    zones = spark.createDataFrame([(i, 15.0, 15.0) for i in range(10)], "zone long, x double, y double")
    got = aggregates.catchment(zones, points(spark, crowd), ["zone"], "id", "w", 14.0)
    places = points(spark, crowd).where("pow(x - 15, 2) + pow(y - 15, 2) <= 196").select("x", "y").distinct().count()
    assert got.count() == 10 and met[0].count() < 10 * places * 0.7


def test_rectangles_over_each_other(spark, crowd):
    """Of rectangles that hold a cell wholly one is met, whatever their number."""
    boxes, rows = rects(spark)
    near = {r["id"]: (r["rect"], r["distance"]) for r in spatial.nearest_footprint(points(spark, crowd), boxes, 20.0).collect()}
    cover = {r["id"]: (r["covered"], r["area"]) for r in spatial.footprint_cover(points(spark, crowd), boxes, 2.0, 20.0).collect()}
    grid = np.zeros((200, 200), bool)
    for _, x0, y0, x1, y1 in rows:
        grid[int(2 * x0) + 20 : int(2 * x1) + 20, int(2 * y0) + 20 : int(2 * y1) + 20] = True
    for i, x, y, _ in crowd:
        d = min((np.hypot(max(x0 - x, x - x1, 0), max(y0 - y, y - y1, 0)), k) for k, x0, y0, x1, y1 in rows)
        assert near[i] == (d[1], pytest.approx(d[0]))
        u, v = int(2 * x) + 20, int(2 * y) + 20
        assert cover[i] == (d[0] == 0, pytest.approx(grid[u - 4 : u + 4, v - 4 : v + 4].sum() / 4))
    parts, _ = joins.holding(points(spark, crowd), boxes, 20.0)
    assert parts.count() == sum(c for c, _ in cover.values())


def test_sources_are_counted_by_value(spark, crowd):
    boxes, rows = rects(spark)
    got = joins.pick_source(points(spark, crowd), boxes.selectExpr("rect AS tile_id", "xmin", "ymin", "xmax", "ymax", "CASE WHEN rect % 13 > 0 THEN rect % 5 END AS z"), 50.0, 1.0)
    found = {r["id"]: r.asDict() for r in got.collect()}
    for i, x, y, _ in crowd:
        at = sorted(((x - (x0 + x1) / 2) ** 2 + (y - (y0 + y1) / 2) ** 2, k) for k, x0, y0, x1, y1 in rows if x0 <= x <= x1 and y0 <= y <= y1)
        if at:
            z = lambda k: k % 5 if k % 13 else None
            best = z(at[0][1])
            assert (found[i]["tile_id"], found[i]["sources"]) == (at[0][1], len(at))
            assert found[i]["disagreeing"] == sum(best is not None and z(k) is not None and abs(z(k) - best) > 1 for _, k in at)
    assert "collect_list(z" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_starts_at_the_spacing(spark, crowd, monkeypatch):
    """A wide first radius over dense places would meet nearly all pairs."""
    radii = []
    plain = joins.within_distance
    monkeypatch.setattr(joins, "within_distance", lambda a, b, r: radii.append(r) or plain(a, b, r))
    zones = spark.createDataFrame([(i, 1.5 * i, 1.0 * i) for i in range(20)], "zone long, x double, y double")
    one = {r["zone"]: (r["id"], r["distance"]) for r in joins.nearest(zones, points(spark, crowd), "zone", "id", 25.0).collect()}
    few = {(r["zone"], r["rank"]): r["id"] for r in joins.k_nearest(zones, points(spark, crowd), "zone", "id", 3, 25.0).collect()}
    for i in range(20):
        order = sorted((np.sqrt((x - 1.5 * i) ** 2 + (y - 1.0 * i) ** 2), k) for k, x, y, _ in crowd)
        assert one[i][0] == order[0][1] and [few[i, j + 1] for j in range(3)] == [k for _, k in order[:3]]
    assert radii[0] < 2 and min(radii[1:]) < 3
