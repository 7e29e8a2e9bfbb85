"""R03 by the parts of a lattice: no rounds of joins, the same paths as by rounds."""

from __future__ import annotations

import random

import pytest

from calado.operators import graph


def made(spark, islands, seed=5):
    rng = random.Random(seed)
    rows = [(30 * i + x, y, rng.random() * 3, rng.choice([0.0, 0.5, 2.0, 4.0])) for i in range(islands) for x in range(9) for y in range(7) if rng.random() < 0.93 or (x, y) in ((0, 0), (8, 6))]
    cells = spark.createDataFrame(rows, "x long, y long, z double, relief double")
    modes = {m: graph.checkpointed(graph.lattice(cells, m)) for m in ("distance", "relief", "balanced")}
    wanted = [(i, f"{30 * i},0", f"{30 * i + 8},6") for i in range(islands)] + [(99, "0,0", "38,6"), (98, "7,7", "7,7"), (97, "7,7", "0,0"), (96, None, "0,0")]
    return modes, spark.createDataFrame(wanted, "q int, start string, end string")


def rows_of(df):
    return {(r["q"], r["variant"]): (r["nodes"], round(r["cost"], 9), r["jaccard"], r["far_share"]) for r in df.collect()}


def test_alternatives_need_no_rounds(spark, monkeypatch):
    """Before, every attempt ran rounds of joins over all islands."""
    modes, queries = made(spark, 5)
    by_rounds = rows_of(graph.alternatives(modes, queries, attempts=6, most_nodes=0))

    def refused(*_, **__):
        raise AssertionError("rounds of joins")

    monkeypatch.setattr(graph, "shortest_paths", refused)
    found = graph.alternatives(modes, queries, attempts=6)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("q", "int"), ("variant", "int"), ("nodes", "array<string>"), ("cost", "double"), ("jaccard", "double"), ("far_share", "double")]
    got = rows_of(found)
    assert got == by_rounds and {q for q, _ in got} == {0, 1, 2, 3, 4, 98} and max(v for _, v in got) > 0
    assert got[98, 0] == (["7,7"], 0.0, 0.0, 1.0)


def test_large_parts_take_rounds_beside_small_ones(spark):
    rng = random.Random(1)
    cells = [(x, y, rng.random(), rng.choice([0.0, 2.0])) for x0, w in ((0, 4), (20, 2)) for x in range(x0, x0 + w) for y in range(3)]
    modes = {m: graph.checkpointed(graph.lattice(spark.createDataFrame(cells, "x long, y long, z double, relief double"), m)) for m in ("distance", "relief")}
    queries = spark.createDataFrame([("a", "0,0", "3,2"), ("b", "20,0", "21,2")], "q string, start string, end string")
    want = rows_of(graph.alternatives(modes, queries, attempts=2))
    assert rows_of(graph.alternatives(modes, queries, attempts=2, most_nodes=8)) == want and {q for q, _ in want} == {"a", "b"}


@pytest.mark.parametrize("tile", [2, 3, 256])
def test_parts_across_tiles(spark, tile):
    """Parts that wind through many squares are one part each."""
    n = 23
    spiral = [(f"{i},{(i * i) % 7}", f"{i + 1},{((i + 1) ** 2) % 7}") for i in range(n)]
    other = [(f"{-i - 2},50", f"{-i - 1},50") for i in range(9)]
    edges = spark.createDataFrame(spiral + other + [("5,5", "5,5")], "a string, b string")
    got = {r["node"]: r["part"] for r in graph.lattice_parts(edges, tile).collect()}
    for line in (spiral, other):
        nodes = {x for e in line for x in e}
        assert {got.pop(x) for x in nodes} == {min(nodes)}
    assert got == {"5,5": "5,5"}


def test_an_edge_without_a_cost_is_none(spark):
    """Before, an offer without a cost hid the others to the same node."""
    rows = [("0,0", "1,0", 1.0), ("0,0", "0,1", 1.0), ("1,0", "1,1", 1.0), ("0,1", "1,1", None), ("0,1", "1,1", float("nan"))]
    edges = {"distance": spark.createDataFrame(rows, "a string, b string, cost double")}
    queries = spark.createDataFrame([("q", "0,0", "1,1")], "q string, start string, end string")
    for most in (0, 100):
        assert [(r["nodes"], r["cost"]) for r in graph.alternatives(edges, queries, attempts=1, most_nodes=most).collect()] == [(["0,0", "1,0", "1,1"], 2.0)]
