"""What loops and groups leave on disk and in memory."""

from __future__ import annotations

from pathlib import Path

from __spark_entry__ import queries
from calado.operators import graph, spatial, storage
from calado.sources import payloads


def test_rounds_of_shortest_paths_do_not_add_up_on_disk(spark):
    n = 30
    edges = spark.createDataFrame([(f"{i},0", f"{i + 1},0", 1.0) for i in range(n)], "a string, b string, cost double")
    folder = Path(storage.shared_root(spark).removeprefix("file://"))
    held = lambda: {p for p in folder.rglob("*.parquet")} | {p for p in folder.rglob("rdd-*/part-*")}
    before = held()
    found = graph.shortest_paths(edges, spark.createDataFrame([("q", "0,0")], "q string, start string"))
    assert found.count() == n + 1 and {r["cost"] for r in found.collect()} == {float(i) for i in range(n + 1)}
    left = {next(d for d in (p, *p.parents) if d.parent == folder or d.parent.parent == folder) for p in held() - before}
    assert len(left) == 1


def test_members_are_spread_and_no_window_orders_them(spark):
    assert payloads._spread(spark.range(1000).coalesce(1), 25, pairs=1000).rdd.getNumPartitions() == 25
    rows = [("a/north.csv", "north counts"), ("a/north.csv", "north counts"), (None, "north"), ("b/1.csv", "")]
    members = spark.createDataFrame(rows, "path string, folded_text string").coalesce(1)
    profiles = spark.createDataFrame([("North", "north", ["nor"])], "profile string, literal string, tokens array<string>")
    found = payloads.map_members(members, profiles)
    assert "Window" not in found._jdf.queryExecution().analyzed().toString()
    assert [tuple(r) for r in found.collect()] == [("North", None, 6, "ambiguous")]
    one = payloads.map_members(members.where("path LIKE 'b/%' OR folded_text = 'north'"), profiles).collect()
    assert [tuple(r) for r in one] == [("North", None, 6, "unique")]


def test_pages_of_lines_are_shuffled_once(spark):
    df = queries()["S04_check_pages"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_a_long_line_is_spread_and_keeps_its_segments(spark, monkeypatch):
    points = [(g, i, float(i * 3 % 17), float(i * 5 % 13)) for g in (1, None) for i in range(400)]
    line = spark.createDataFrame(points, "line int, seq long, x double, y double").repartition(3)
    kept = []
    monkeypatch.setattr(spatial, "checkpointed", lambda df: kept.append(storage.checkpointed(df)) or kept[-1])
    made = spatial.segments(line, ["line"], "seq")
    held = kept[-1].where("line = 1").groupBy("_part").count().collect()
    assert len(held) > 1 and max(r["count"] for r in held) < 400
    want = []
    for g in (1, None):
        s0 = 0.0
        for i in range(399):
            a, b = points[i][2:], points[i + 1][2:]
            length = ((b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2) ** 0.5
            want.append((g or 0, round(s0, 6), *a, *b, round(length, 6)))
            s0 += length
    assert sorted((r["line"] or 0, round(r["s0"], 6), r["ax"], r["ay"], r["bx"], r["by"], round(r["length"], 6)) for r in made.collect()) == sorted(want)
