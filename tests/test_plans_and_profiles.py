"""Fitted profiles, request plans, greedy covers, forced requests and segments on grid cells against plain loops."""

from __future__ import annotations

import math
import random
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from calado.operators import aggregates, selection, spatial, windows


@pytest.mark.parametrize("tied", [False, True])
def test_fitted_profile_reaches_the_deviation(spark, tied):
    rng = random.Random(9)
    rows = [(g, i * rng.uniform(20, 30) + 25 * i, rng.uniform(0, 60) + 5 * math.sin(i / 3), i % 9 == 4) for g in range(6) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, s double, z double, station boolean").dropDuplicates(["g", "s"])
    anchor = F.when((F.col("s") == 0) & (F.col("g") < 4), F.col("z") + 2) if tied else None
    out = {}
    for r in windows.fitted_grade(df, ["g"], 0.05, 0.01, F.col("station"), anchor).collect():
        out.setdefault(r["g"], []).append(r)
    best = {r["g"]: r["deviation"] for r in windows.minimax_grade(df, ["g"], 0.05, 0.01, F.col("station"), anchor).collect()}
    for g, line in out.items():
        line.sort(key=lambda r: r["s"])
        free = [r for r in line if not (tied and g < 4 and r["s"] == 0)]
        assert max(abs(r["residual"]) for r in free) <= best[g] + 1e-9
        if not tied:
            assert max(abs(r["residual"]) for r in line) == pytest.approx(best[g])
        if tied and g < 4:
            assert line[0]["fit"] == pytest.approx(line[0]["z"] + 2)
        for a, b in zip(line, line[1:], strict=False):
            assert abs(b["fit"] - a["fit"]) <= (0.01 if b["station"] else 0.05) * (b["s"] - a["s"]) + 1e-9


def plain_plan(period, dims, prefer, max_cells, max_length, address):
    whole, out = {d: len(v) for d, v in dims.items()}, []

    def visit(p, part):
        named = {"Dim1": [p]} | {d: v for d, v in part.items() if len(v) < whole[d]}
        length = len(address) + sum(len(d) + 2 + len(quote_plus(",".join(v))) for d, v in named.items())
        cells = math.prod(map(len, part.values()))
        if cells <= max_cells and length <= max_length:
            out.append((p, *(tuple(v) for v in part.values()), cells, length))
            return
        several = [d for d, v in part.items() if len(v) > 1]
        if not several:
            raise ValueError("atomic")
        d = prefer if prefer in several else max(several, key=lambda k: len(part[k]))
        cut = (len(part[d]) + 1) // 2
        visit(p, part | {d: part[d][:cut]})
        visit(p, part | {d: part[d][cut:]})

    for p in period:
        visit(p, dims)
    return sorted(out)


def test_request_plans_keep_both_budgets(spark):
    codes = {"Dim2": [f"Ç {i}*~" for i in range(13)], "Dim3": [str(i) for i in range(40)], "Dim4": ["T"]}
    df = spark.createDataFrame([("r", ["2020", "2021/22"], *codes.values())], "request string, Dim1 array<string>, Dim2 array<string>, Dim3 array<string>, Dim4 array<string>")
    for cells, length, prefer in ((1000, 400, "Dim2"), (50, 90, "Dim3"), (1000, 60, "Dim4"), (1, 200, "Dim2")):
        got = selection.plan_requests(df, "Dim1", list(codes), prefer, cells, length, "https://h/q?").collect()
        assert sorted((r["Dim1"], *(tuple(r[d]) for d in codes), r["cells"], r["length"]) for r in got) == plain_plan(["2020", "2021/22"], codes, prefer, cells, length, "https://h/q?")
    with pytest.raises(Exception, match="over a budget"):
        selection.plan_requests(df, "Dim1", list(codes), "Dim2", 10, 30, "https://h/q?").collect()


def test_many_requests_are_planned_in_one_pass(spark):
    """Hundreds of requests of different sizes, some empty in a dimension, one with a null code, none with a round of its own."""
    rng = random.Random(12)
    asked = {k: (["a", "b&c"][: 1 + k % 2], [f"p {i}" for i in range(rng.randrange(1, 30))], [f"x{i * 7}" for i in range(0 if k % 90 == 5 else rng.randrange(1, 12))]) for k in range(700)}
    df = spark.createDataFrame([(k, *v) for k, v in asked.items()], "request int, Dim1 array<string>, Dim2 array<string>, Dim3 array<string>").coalesce(1)
    plan = selection.plan_requests(df, "Dim1", ["Dim2", "Dim3"], "Dim3", 12, 70, "https://h/q?")
    assert "MapInArrow" in plan._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in plan.collect():
        got.setdefault(r["request"], []).append((r["Dim1"], tuple(r["Dim2"]), tuple(r["Dim3"]), r["cells"], r["length"]))
    assert set(got) == set(asked)
    for k, (period, two, three) in asked.items():
        assert sorted(got[k]) == plain_plan(period, {"Dim2": two, "Dim3": three}, "Dim3", 12, 70, "https://h/q?"), k
    empty = spark.createDataFrame([(1, ["a"], ["p", None, "q"], ["x"])], df.schema)
    assert sorted(r["cells"] for r in selection.plan_requests(empty, "Dim1", ["Dim2", "Dim3"], "Dim2", 1, 70, "https://h/q?").collect()) == [1, 1, 1]


def test_lazy_cover_is_the_plain_one(spark):
    rng = random.Random(2)
    sets = {i: {rng.randrange(60) for _ in range(rng.randrange(1, 14))} for i in range(50)} | {90: set(range(9)), 91: set(range(9))}
    score = {i: i * 7 % 5 if i % 4 else None for i in sets}
    df = spark.createDataFrame([(i, u, score[i]) for i, units in sets.items() for u in units] * 2 + [(None, 3, 1)], "i int, u int, s int")
    seen, want, left = set(), [], set(sets)
    while left and len(want) < 12:
        best = min(left, key=lambda i: (-len(sets[i] - seen), score[i] is None, -(score[i] or 0), i))
        if not sets[best] - seen:
            break
        want.append((len(want) + 1, best, len(sets[best] - seen)))
        seen |= sets[best]
        left.remove(best)
    assert [tuple(r) for r in selection.greedy_cover(df, "i", "u", 12, "s", at_once=4).orderBy("step").collect()] == want


def test_partial_answers_are_asked_again(spark):
    plan = spark.createDataFrame([("a", "x", ["1", "2"], True, False), ("a", "y", ["p"], False, False), ("b", "x", ["1", "3"], True, False), ("c", "y", ["p", "q"], False, False)], "request string, dim string, codes array<string>, omitted boolean, explicit boolean")
    asked = []

    def respond(left):
        asked.append({(r["request"], r["explicit"]) for r in left.select("request", "explicit").distinct().collect()})
        whole = left.select("request", "dim", F.explode("codes").alias("code"), "explicit")
        return whole.where("explicit OR request <> 'b' OR code <> '3'").where("code <> 'q'").drop("explicit")

    found, rounds = aggregates.covered_by_requests(plan, respond)
    assert asked == [{("a", False), ("b", False), ("c", False)}, {("b", True)}] and rounds == 2
    assert {(r["dim"], r["requested"], r["missing_codes"], r["complete"]) for r in found.collect()} == {("x", 3, "", True), ("y", 2, "q", False)}


def test_segments_go_to_the_cells_they_cross(spark):
    rng = random.Random(8)
    segs = [(i, *(rng.uniform(-50, 50) for _ in range(4))) for i in range(40)] + [(90, 3.0, -20.0, 3.0, 40.0), (91, -7.0, 10.0, 25.0, 10.0), (92, 5.5, 5.5, 5.5, 5.5), (93, -30.0, -30.0, 30.0, 30.0)]
    got = {}
    for r in spatial.crossed_cells(spark.createDataFrame(segs, "i int, ax double, ay double, bx double, by double"), 10.0).collect():
        got.setdefault(r["i"], []).append((r["_cx"], r["_cy"]))
    for i, ax, ay, bx, by in segs:
        seen = {(math.floor((ax + t / 2000 * (bx - ax)) / 10), math.floor((ay + t / 2000 * (by - ay)) / 10)) for t in range(2001)}
        assert seen <= set(got[i]) and len(got[i]) == len(set(got[i])) <= 3 * len(seen) + 6, i
    far = spark.createDataFrame([(1, 0.0, 0.3, 30000.0, 29999.1)], "i int, ax double, ay double, bx double, by double")
    assert spatial.crossed_cells(far, 10.0).count() < 9500


def test_spans_inside_a_star(spark):
    """Shares of edges within a ring that is mostly concave, by sampling."""
    rng = random.Random(5)
    ring = [(20 * math.cos(i / 3) * (r := rng.uniform(0.3, 1)), 20 * math.sin(i / 3) * r) for i in range(18)]
    edges = [(i, *(rng.uniform(-25, 25) for _ in range(4))) for i in range(30)]
    polygons = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring])], "polygon_id int, ring array<struct<x:double,y:double>>")
    got = {r["edge_id"]: r["inside"] for r in spatial.edge_exposure(spark.createDataFrame(edges, "edge_id int, ax double, ay double, bx double, by double"), polygons, 7.0).collect()}

    def inside(x, y):
        return sum((a[1] > y) != (b[1] > y) and x < a[0] + (y - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) % 2

    for i, ax, ay, bx, by in edges:
        share = sum(inside(ax + (k + 0.5) / 4000 * (bx - ax), ay + (k + 0.5) / 4000 * (by - ay)) for k in range(4000)) / 4000
        assert got.get(i, 0.0) == pytest.approx(share * math.hypot(bx - ax, by - ay), abs=0.1), i
