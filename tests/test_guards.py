"""Arguments that make an operator fail closed, and columns that the given tables do not reach."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from calado.functions import text as X
from calado.operators import gates, joins, selection
from calado.sources import payloads


def test_unknown_codes_are_errors(spark):
    members = spark.createDataFrame([("a", "A 2020", "1"), ("b", "B", "2")], "code string, label string, level string")
    assert [r[0] for r in gates.select_members(members, codes=["a"]).collect()] == ["a"]
    with pytest.raises(Exception, match="unknown codes: c"):
        gates.select_members(members, codes=["a", "c"]).collect()


def test_top_level_kinds(spark):
    rows = spark.createDataFrame([('{"a":[1,2]}',)], "b string")
    assert payloads.json_path(rows, "b", "a", 2, top="object").first()["enough"]
    for top, body in (("object", "[1]"), ("array", '{"a":1}'), ("object", "no json"), ("array", "7"), ("object", None)):
        with pytest.raises(Exception, match="a body is no"):
            payloads.json_path(spark.createDataFrame([(body,)], "b string"), "b", "a", 1, top=top).collect()


def test_ignored_filters_are_errors(spark):
    df = spark.createDataFrame([("x", ["a", "b c"], "b"), ("a", ["a"], "q"), ("x", ["lisboa"], "área de lisboa")], "code string, allowed array<string>, part string")
    f = lambda strict: [r[0] for r in df.select(X.match_member(F.col("code"), F.col("allowed"), F.col("part"), strict)).collect()]
    assert f(False) == f(True) == ["b c", "a", "lisboa"]
    bad = spark.createDataFrame([("x", ["a", "ab"], "a")], "code string, allowed array<string>, part string")
    with pytest.raises(Exception, match="filter was ignored: x"):
        bad.select(X.match_member(F.col("code"), F.col("allowed"), F.col("part"), strict=True)).collect()


def test_unreviewed_overlap_is_an_error(spark):
    keys = lambda *k: spark.createDataFrame([(i,) for i in k], "k int")
    assert sorted(r[0] for r in joins.new_only(keys(1, 2, 3), keys(2), "k", keys(2)).collect()) == [1, 3]
    with pytest.raises(Exception, match="unreviewed overlap, as 2"):
        joins.new_only(keys(1, 2, 3), keys(2), "k", keys(3)).collect()


def test_exact_study_points(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 2, 1)], "k string, x int, y int")
    assert {(r["keys"], r["n"]) for r in selection.study_points(df, "k", "x", "y", 3).collect()} == {("a,b", 2), ("c", 1)}
    for bad, n in ((df, 4), (df.union(df.limit(1)), 4)):
        with pytest.raises(Exception, match="contract failed"):
            selection.study_points(bad, "k", "x", "y", n).collect()


def test_compact_values(spark):
    said = ['{"b":1,"a":[2]}', " [1, 2]", '"t"', "1.5", "true", "null", None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in said], "s string").select(X.compact(F.col("s"))).collect()]
    assert [g and g["type"] for g in got] == ["object", "array", "text", "number", "boolean", "null", None]
    assert got[0]["keys"] == "b|a" and got[1]["keys"] is None and got[0]["bytes"] == 15


def test_header_rows_as_context(spark):
    rows = [(1, i, s) for i, s in enumerate(["Estação", "Ano", "12", "text", "route 5"])] + [(2, 0, "only")]
    table = gates.header_context(spark.createDataFrame(rows, "t int, i int, s string"), ["t"], "i", "s")
    got = {r["s"]: (r["context"], r["tags"], r["status"]) for r in gates.admit_rows(table, "s", {"rail": ["estacao"], "road": ["route"]}, "context").collect()}
    assert got == {"12": ("Estação | Ano", "rail", "admitted"), "text": ("Estação | Ano", "rail", "candidate"), "route 5": ("Estação | Ano", "rail|road", "admitted")}
