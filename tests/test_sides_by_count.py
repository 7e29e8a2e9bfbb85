"""Sides of joins go through the driver by their count, not by an estimate of their bytes."""

from __future__ import annotations

import math

import pytest

from calado.operators import aggregates, graph, joins


@pytest.mark.parametrize("most", [200_000, 0])
def test_what_a_catchment_sends_through_the_driver(spark, tmp_path, monkeypatch, most):
    """Before, zones at each cell of their edge were sent, as compressed files of zones are small."""
    monkeypatch.setattr(joins.by_count, "__defaults__", (most,))
    spark.range(40).selectExpr("id AS zone", "CAST((id * 211) % 509 AS DOUBLE) AS x", "CAST((id * 307) % 501 AS DOUBLE) AS y").write.parquet(f"{tmp_path}/zones")
    spark.range(900).selectExpr("id", "CAST((id * 53) % 509 AS DOUBLE) AS x", "CAST((id * 97) % 503 AS DOUBLE) AS y", "CASE WHEN id % 7 > 0 THEN CAST(id % 11 AS DOUBLE) END AS w").write.parquet(f"{tmp_path}/points")
    zones, points = (spark.read.parquet(f"{tmp_path}/{t}") for t in ("zones", "points"))
    got = aggregates.catchment(zones, points, ["zone"], "id", "w", 60.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and plan.count("SortMergeJoin") == (2 if most else 5)
    want = {}
    places = points.collect()
    for z in zones.collect():
        near = [p["w"] for p in places if math.dist((p["x"], p["y"]), (z["x"], z["y"])) <= 60.0]
        if near:
            want[z["zone"]] = (len(near), sum(w for w in near if w is not None), near.count(None))
    assert {r["zone"]: (r["features"], r["people"], r["unknown"]) for r in got.collect()} == want


def test_a_lattice_sends_its_nodes_by_count(spark, tmp_path, monkeypatch):
    """Before, the nodes of any lattice in a small file were sent."""
    spark.range(90).selectExpr("id % 9 AS x", "id DIV 9 AS y", "CAST(id % 7 AS DOUBLE) AS z", "CAST(id % 5 AS DOUBLE) AS relief").write.parquet(f"{tmp_path}/cells")
    cells = spark.read.parquet(f"{tmp_path}/cells")
    few = graph.lattice(cells, "distance")
    monkeypatch.setattr(joins.by_count, "__defaults__", (50,))
    many = graph.lattice(cells, "distance")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (few, many)]
    assert "BuildRight" in plans[0] and "BuildLeft" not in plans[0] and "Broadcast" not in plans[1]
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
