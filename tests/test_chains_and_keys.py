"""Chains, lattices with tiles, tiles paired by suffix, and operators whose keys may be hot, against plain loops."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from calado.operators import gates, graph, joins, selection


def test_chains_by_brute_force(spark):
    rng = random.Random(5)
    tables = []
    for k in range(3):
        legs = []
        for i in range(60):
            x, y = rng.randrange(5), rng.randrange(5)
            nodes = [(x, y)]
            for _ in range(rng.randrange(1, 4)):
                x, y = x + rng.choice((-1, 0, 1, 1, 2 if i % 9 == 0 else 1)), y + rng.choice((-1, 0, 1))
                nodes.append((x, y))
            legs.append((f"{k}.{i}", [f"{a},{b}" for a, b in nodes]))
        tables.append([*legs, (f"{k}.none", None), (f"{k}.empty", [])])
    place = lambda n: tuple(map(int, n.split(",")))
    step = lambda a, b: max(abs(p - q) for p, q in zip(place(a), place(b), strict=True)) == 1
    frames = [spark.createDataFrame(t, "leg string, nodes array<string>").withColumn("chain", F.lit("other")) for t in tables]
    for adjacent in (False, True):
        want = []
        for a, na in tables[0]:
            for b, nb in tables[1]:
                for c, nc in tables[2]:
                    if not (na and nb and nc) or na[-1] != nb[0] or nb[-1] != nc[0]:
                        continue
                    nodes = na + nb[1:] + nc[1:]
                    if len(set(nodes)) == len(nodes) and (not adjacent or all(map(step, nodes, nodes[1:]))) and "2,2" in nodes and any(place(n)[0] == 3 for n in nodes):
                        want.append((f"{a}/{b}/{c}", len(nodes), nodes))
        anchors = (lambda n: n == "2,2", lambda n: F.substring_index(n, ",", 1) == "3")
        got = graph.compose_chains(*frames, anchors=anchors, adjacent=adjacent).collect()
        assert sorted(map(tuple, got)) == sorted(want) and want
    alone = graph.compose_chains(frames[0]).count()
    assert alone == sum(1 for _, n in tables[0] if n and len(set(n)) == len(n))


def test_lattice_nodes_need_four_tiles(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (1, 0, 2.0), (1, 0, 3.0), (-1, 0, None)], "x int, y int, z double")
    tiles = [(tx, ty, f"{tx}/{ty}") for tx in range(-2, 4) for ty in (0, 1) if (tx, ty) != (1, 1)] + [(0, 0, "0/-"), (1, 1, None)]
    got = graph.lattice_nodes(cells, spark.createDataFrame(tiles, "tx int, ty int, tile_id string")).collect()
    assert sorted((r["x"], r["z"] or 0.0, r["tile_ids"]) for r in got) == [(-1, 0.0, ["-2/0", "-1/0", "-2/1", "-1/1"]), (1, 2.0, ["2/0", "3/0", "2/1", "3/1"]), (1, 3.0, ["2/0", "3/0", "2/1", "3/1"])]


def test_steps_of_short_and_road_lattices(spark):
    cells = spark.createDataFrame([(0, 0, 10.0, 100.0, 900.0), (1, 0, 30.0, 50.0, 9000.0), (0, 1, 5.0, 20.0, None), (1, 1, None, 1.0, 1.0)], "x int, y int, z double, relief double, road double")
    short = {(r["a"], r["b"]): r["cost"] for r in graph.lattice(cells, "short", graph.FOUR).collect()}
    road = {(r["a"], r["b"]): r["cost"] for r in graph.lattice(cells, "road", graph.FOUR).collect()}
    assert set(short) == set(road) == {("0,0", "1,0"), ("1,0", "0,0"), ("0,0", "0,1"), ("0,1", "0,0")}
    assert short["0,0", "1,0"] == pytest.approx(1 + 0.0007 * 50 + 0.0002 * 20)
    assert road["0,0", "1,0"] == pytest.approx(1 + 0.004 * 50 + 0.001 * 20 + 0.0004 * 4000)
    assert road["1,0", "0,0"] == pytest.approx(1 + 0.004 * 100 + 0.001 * 20 + 0.0004 * 900)
    assert road["0,0", "0,1"] == pytest.approx(1 + 0.004 * 20 + 0.001 * 5)


def test_tiles_pair_by_suffix(spark):
    schema = "name string, xmin double, ymin double, xmax double, ymax double, status string"
    a = [("A-1", 0.0, 40.0, 1.0, 41.0, "x"), ("A-1", 0.0, 40.0, 1.0, 41.0, "y"), ("A-2", 0.0, 60.0, 1.0, 60.0, None), ("A-3", 0.0, 1.0, 2.0, 3.0, None)]
    b = [("BB-1", 0.0, 40.0, 1.0, 41.0, "x"), ("BB-2", 0.001, 60.0, 1.0, 60.0, None), ("BB-4", 0.0, 1.0, 2.0, 3.0, None)]
    make = lambda rows: spark.createDataFrame(rows, schema)
    got = {r["suffix"]: (r["status"], r["metres"]) for r in joins.pair_by_suffix(make(a), make(b), "name", ("A-", "BB-")).collect()}
    assert got.pop("2") == ("moved", pytest.approx(0.001 * 111195 * math.cos(math.radians(60))))
    assert got == {"1": ("equal", 0.0), "3": ("only_a", None), "4": ("only_b", None)}
    assert {r["status"] for r in joins.pair_by_suffix(make(a), make(b), "name", ("A-", "BB-"), 0.01).where("suffix = '2'").collect()} == {"equal"}
    for bad, said in (([("B-1", 0.0, 0.0, 1.0, 1.0, "")], "no A-"), ([(None, 0.0, 0.0, 1.0, 1.0, "")], "no A-"), ([*a, ("A-3", 9.0, 1.0, 2.0, 3.0, "")], "two boxes")):
        with pytest.raises(Exception, match=said):
            joins.pair_by_suffix(make(bad), make(b), "name", ("A-", "BB-")).collect()


def test_front_that_hardly_shrinks(spark):
    """Nearly all rows of one part are on the front, many of them at one value of the first measure and within the tolerance."""
    rng = random.Random(3)
    rows = [(i, "hot", x := float(rng.randrange(40)) if i % 3 == 0 else rng.uniform(0, 40), 100 - x + rng.choice((0.0, 5e-4, 0.0, -0.5))) for i in range(1500)]
    rows += [(5000 + i, "b", float(i), float(i)) for i in range(5)] + [(6000, None, 1.0, 1.0), (6001, "hot", None, 1.0)]
    eps = 1e-3
    want = {
        k
        for k, p, x, y in rows
        if x is not None and not any(q == p and u is not None and u >= x - eps and v >= y - eps and (u > x + eps or v > y + eps) for _, q, u, v in rows)
    }
    df = spark.createDataFrame(rows, "k int, p string, u double, v double")
    got = selection.pareto(df, ["u", "v"], ["max", "max"], ["p"], "k", eps, 2, 50).collect()
    assert {r["k"] for r in got} == want and len(got) == len(want) > 700


def test_labels_repeated_many_times(spark):
    members = [("c0", "North  Station")] + [(f"c{i % 7}", "Hot label") for i in range(4000)] + [("d", "South hot"), (None, None)]
    wanted = ["hot label"] * 50 + ["north", "south hot", "hot", "nowhere", None]
    got = gates.resolve_label(spark.createDataFrame(members, "code string, label string"), spark.createDataFrame([(w,) for w in wanted], "wanted string")).collect()
    assert len(got) == len(wanted)
    assert {(r["wanted"], r["code"], r["status"]) for r in got} == {("hot label", None, "ambiguous"), ("north", "c0", "within"), ("south hot", "d", "exact"), ("hot", None, "ambiguous"), ("nowhere", None, "absent"), (None, None, "absent")}
    assert {r["status"] for r in gates.resolve_label(spark.createDataFrame([("d", "One")], "code string, label string"), spark.createDataFrame([("one",), ("one",)], "wanted string")).collect()} == {"exact"}


def test_nearest_samples_of_routes_by_stretches(spark):
    rng = random.Random(8)
    routes = []
    for r in range(4):
        x, y, s = rng.uniform(0, 500), rng.uniform(0, 500), 0.0
        for _ in range(300):
            routes.append((f"r{r}" if r else None, s, x, y, rng.uniform(0, 180)))
            dx, dy = rng.uniform(0, 6), rng.uniform(-4, 4)
            x, y, s = x + dx, y + dy, s + math.hypot(dx, dy)
    routes += [("r1", 1e6, None, 3.0, 1.0), ("empty", 0.0, None, None, 0.0)]
    sites = [(i, rng.uniform(0, 2000), rng.uniform(0, 800), rng.uniform(0, 180)) for i in range(40)]
    df = spark.createDataFrame(routes, "route string, s double, x double, y double, heading double")
    few = spark.createDataFrame(sites, "site int, x double, y double, heading double")
    for block in (None, 50.0, 1e9):
        got = {(r["site"], r["route"]): (r["offset"], r["s"]) for r in joins.site_route_context(few, df, 20.0, block=block).collect()}
        want = {}
        for site, sx, sy, _ in sites:
            for route in (None, "r1", "r2", "r3"):
                want[site, route] = min((math.hypot(x - sx, y - sy), s) for r, s, x, y, _ in routes if r == route and x is not None)
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k]) for k in want)
