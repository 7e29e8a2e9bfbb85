"""Queries of selections (T01 to T09) and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import aggregates as A
from calado.operators import selection as T
from calado.plans._query import query
from calado.plans.aggregate import _PAIRS, BASKETS
from calado.plans.sequence import OPTIONS, RECTS


@query(
    "T01_pareto",
    """SELECT option_id FROM options a WHERE NOT EXISTS (SELECT 1 FROM options b WHERE b.speed = a.speed AND b.minutes <= a.minutes + 1e-9 AND b.residents >= a.residents - 1e-9 AND b.length_km <= a.length_km + 1e-9
    AND (b.minutes < a.minutes - 1e-9 OR b.residents > a.residents + 1e-9 OR b.length_km < a.length_km - 1e-9))""",
    options=OPTIONS,
)
def _(t, options):
    return T.pareto(options, ["minutes", "residents", "length_km"], ["min", "max", "min"], ["speed"], "option_id").select("option_id")


@query("T02_best_by", "SELECT family, option_id, minutes FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY minutes, residents DESC, option_id) AS i FROM options) WHERE i = 1", options=OPTIONS)
def _(t, options):
    return T.best_by(options, ["family"], [F.col("minutes"), -F.col("residents"), F.col("option_id")], ["option_id", "minutes"])


@query("T03_top_n", "SELECT family, option_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY residents DESC, option_id) AS rank FROM options) WHERE rank <= 5", options=OPTIONS)
def _(t, options):
    return T.top_n(options, ["family"], [F.col("residents").desc(), F.col("option_id")], 5).select("family", "option_id", "rank")


@query("T04_greedy_disjoint")
def _(t):
    rows = t.sql(RECTS).select("scan", "tile_id", "xmin", F.array(F.floor(F.col("xmin") / 100), F.floor(F.col("ymin") / 100) + 100).alias("tiles"))
    return T.greedy_disjoint(rows, "scan", ["xmin", "tile_id"], "tiles").select("scan", "tile_id", "rank")


@query(
    "T05_greedy_cover",
    """WITH RECURSIVE picks AS (SELECT 0 AS step, CAST(NULL AS BIGINT) AS item, CAST(0 AS BIGINT) AS gain, CAST([] AS BIGINT[]) AS seen UNION ALL
    (SELECT p.step + 1, b.item, CAST(len(b.fresh) AS BIGINT), list_concat(p.seen, b.fresh) FROM picks p, LATERAL (SELECT s.item, list_filter(s.members, lambda m: NOT list_contains(p.seen, m)) AS fresh FROM
      (SELECT item, list(DISTINCT member) AS members FROM sets GROUP BY item) s ORDER BY len(list_filter(s.members, lambda m: NOT list_contains(p.seen, m))) DESC, s.item % 7 DESC, s.item LIMIT 1) b WHERE p.step < 5 AND len(b.fresh) > 0))
    SELECT CAST(step AS INTEGER) AS step, item, gain FROM picks WHERE step > 0""",
    sets="SELECT DISTINCT CAST(l_suppkey % 60 AS BIGINT) AS item, CAST(l_partkey * 31 + l_linenumber AS BIGINT) AS member FROM {lineitem} WHERE l_quantity < 9",
)
def _(t, sets):
    return T.greedy_cover(sets.withColumn("score", F.col("item") % 7), "item", "member", 5, "score", at_once=8)


@query(
    "T06_extremes",
    """WITH e AS (SELECT family, 'fastest' AS rule, first(option_id ORDER BY minutes, option_id) AS option_id FROM options GROUP BY family UNION ALL SELECT family, 'populated', first(option_id ORDER BY residents DESC, option_id) FROM options GROUP BY family
    UNION ALL SELECT family, 'shortest', first(option_id ORDER BY length_km, option_id) FROM options GROUP BY family) SELECT family, option_id, string_agg(rule, ',' ORDER BY rule) AS rules FROM e GROUP BY family, option_id""",
    options=OPTIONS,
)
def _(t, options):
    return T.extremes(options, ["family"], "option_id", {"fastest": F.col("minutes"), "populated": -F.col("residents"), "shortest": F.col("length_km")})


@query("T07_plan_chunks")
def _(t):
    members = t.sql("SELECT l_suppkey AS request, collect_set(l_partkey) AS dim_a, collect_set(l_linenumber) AS dim_b FROM {lineitem} GROUP BY l_suppkey")
    plan = T.plan_chunks(members.select("request", F.array_sort("dim_a").alias("dim_a"), F.array_sort("dim_b").alias("dim_b")), 100, "dim_a")
    return plan.select("request", F.size("dim_a").alias("n_a"), F.size("dim_b").alias("n_b"), F.element_at("dim_a", 1).alias("first_a"), F.element_at("dim_b", 1).alias("first_b"))


@query(
    "T07_plan_requests",
    """WITH RECURSIVE base AS (SELECT request, list_sort(list(DISTINCT flag)) AS flags, list_sort(list(DISTINCT part)) AS parts, list_sort(list(DISTINCT line)) AS lines FROM asked GROUP BY request),
    plan AS (SELECT request, unnest(flags) AS flag, parts, lines, len(parts) AS np, len(lines) AS nl FROM base UNION ALL
      SELECT request, flag, CASE WHEN len(lines) > 1 THEN parts WHEN half = 0 THEN parts[1:(len(parts) + 1) // 2] ELSE parts[(len(parts) + 1) // 2 + 1:] END,
        CASE WHEN len(lines) <= 1 THEN lines WHEN half = 0 THEN lines[1:(len(lines) + 1) // 2] ELSE lines[(len(lines) + 1) // 2 + 1:] END, np, nl FROM
      (SELECT *, unnest([0, 1]) AS half FROM plan WHERE len(parts) * len(lines) > 60 OR 20 + len(flag) + 6 + (CASE WHEN len(parts) = np THEN 0 ELSE 7 + CAST(list_sum(list_transform(parts, lambda c: len(replace(c, '#', '%23')))) AS BIGINT) + 3 * (len(parts) - 1) END) + (CASE WHEN len(lines) = nl THEN 0 ELSE 7 + CAST(list_sum(list_transform(lines, lambda c: len(c))) AS BIGINT) + 3 * (len(lines) - 1) END) > 300))
    SELECT * FROM (SELECT request, flag, len(parts) AS n_parts, len(lines) AS n_lines, parts[1] AS first_part, lines[1] AS first_line, len(parts) * len(lines) AS cells, 20 + len(flag) + 6 + (CASE WHEN len(parts) = np THEN 0 ELSE 7 + CAST(list_sum(list_transform(parts, lambda c: len(replace(c, '#', '%23')))) AS BIGINT) + 3 * (len(parts) - 1) END) + (CASE WHEN len(lines) = nl THEN 0 ELSE 7 + CAST(list_sum(list_transform(lines, lambda c: len(c))) AS BIGINT) + 3 * (len(lines) - 1) END) AS length FROM plan) WHERE cells <= 60 AND length <= 300""",
    asked="SELECT l_suppkey AS request, l_returnflag AS flag, concat('p#', CAST(l_partkey AS VARCHAR(9))) AS part, CAST(l_linenumber AS VARCHAR(9)) AS line FROM {lineitem}",
)
def _(t, asked):
    whole = asked.groupBy("request").agg(*[F.sort_array(F.collect_set(c)).alias(f"{c}s") for c in ("flag", "part", "line")]).withColumnRenamed("flags", "flag")
    plan = T.plan_requests(whole, "flag", ["parts", "lines"], "lines", 60, 300, "https://h.example/q?")
    return plan.select("request", "flag", F.size("parts").alias("n_parts"), F.size("lines").alias("n_lines"), F.element_at("parts", 1).alias("first_part"), F.element_at("lines", 1).alias("first_line"), "cells", "length")


@query(
    "T08_first_pass",
    """SELECT l_orderkey, min(CASE WHEN l_quantity > 25 THEN l_linenumber END) AS l_linenumber, count(*) AS attempts FROM lineitem GROUP BY l_orderkey""",
)
def _(t):
    return T.first_pass(t("lineitem"), ["l_orderkey"], ["l_linenumber"], F.col("l_quantity") > 25, ["l_linenumber"])


@query("T09_study_points", "SELECT x, y, string_agg(k, ',' ORDER BY k) AS keys, count(*) AS n FROM (SELECT DISTINCT c_custkey % 37 AS x, c_custkey % 29 AS y, CAST(c_custkey AS VARCHAR) AS k FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY x, y")
def _(t):
    rows = t("customer").where("c_mktsegment = 'BUILDING'").selectExpr("c_custkey", "c_custkey % 37 AS x", "c_custkey % 29 AS y")
    return T.study_points(rows, "c_custkey", "x", "y")


@query(
    "U01_union_first",
    """WITH u AS (SELECT tile_id, 0 AS scan, xmin FROM rects WHERE tile_id % 3 = 0 UNION ALL SELECT tile_id, 1, xmin + 1 FROM rects WHERE tile_id % 2 = 0 UNION ALL SELECT tile_id, 2, xmin + 2 FROM rects)
    SELECT tile_id, scan, xmin FROM (SELECT *, row_number() OVER (PARTITION BY tile_id ORDER BY scan, xmin) AS i FROM u) WHERE i = 1""",
    rects=RECTS,
)
def _(t, rects):
    r = rects.select("tile_id", "xmin")
    return T.union_first([r.where("tile_id % 3 = 0"), r.where("tile_id % 2 = 0").withColumn("xmin", F.col("xmin") + 1), r.withColumn("xmin", F.col("xmin") + 2)], "tile_id")


@query(
    "U02_set_audit",
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0), m AS (SELECT a.k AS ka, b.k AS kb FROM a FULL JOIN b ON a.k = b.k)
    SELECT count(*) FILTER (ka IS NOT NULL AND kb IS NOT NULL) AS both, count(*) FILTER (kb IS NULL) AS only_a, count(*) FILTER (ka IS NULL) AS only_b, count(*) FILTER (kb IS NULL) = 0 AS subset, count(*) FILTER (kb IS NULL) + count(*) FILTER (ka IS NULL) = 0 AS equal FROM m""",
)
def _(t):
    return T.set_audit(t("orders").select(F.col("o_custkey").alias("k")), t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("U03_assert_subset", "SELECT (SELECT count(*) FROM (SELECT o_orderkey, o_custkey FROM orders EXCEPT ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 9 <> 0)) AS lacking, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys, (SELECT count(*) FROM orders WHERE o_totalprice < 5000) AS null_geometry")
def _(t):
    orders = t("orders").withColumn("geom", F.when(F.col("o_totalprice") >= 5000, "POINT(1 1)"))
    return T.assert_subset(orders, t("orders").where("o_orderkey % 9 <> 0"), ["o_orderkey", "o_custkey"], "o_orderkey", "geom")


@query("U04_jaccard", _PAIRS.replace("common / (na.n", "common / (na.n"), sets="SELECT DISTINCT o_custkey % 40 AS item, o_orderkey % 500 AS member FROM {orders}")
def _(t, sets):
    return A.pair_overlap(sets, "item", "member")
