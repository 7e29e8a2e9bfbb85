"""Queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import aggregates as A
from calado.operators import joins as J
from calado.plans._query import query
from calado.plans.sequence import OPTIONS, PROFILE, RECTS

ASSETS = """SELECT l_orderkey AS source_set_id, concat('asset-', l_linenumber) AS name, concat('h', l_partkey, '-', l_suppkey) AS sha256, CAST(l_quantity AS BIGINT) AS bytes,
  CASE WHEN l_returnflag = 'R' THEN 'recomposed' ELSE 'native' END AS role FROM {lineitem}"""
# Customers as a raster: 50 columns, heights from balances; every 37th cell has no data.
CELLS = """SELECT CAST(floor(c_custkey / 50) AS BIGINT) AS row, c_custkey % 50 AS col, CASE WHEN c_custkey % 37 <> 0 THEN c_acctbal / 100 END AS z, c_nationkey AS zone FROM {customer}"""
POINTS = "SELECT c_custkey AS id, CAST((c_custkey * 53) % 1009 AS DOUBLE) AS x, CAST((c_custkey * 97) % 1013 AS DOUBLE) AS y, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS w FROM {customer}"
STEPS = """SELECT o_custkey AS route, o_orderkey AS seq, o_orderkey % 97 AS x, o_orderkey % 89 AS y FROM {orders}"""
GRID = "SELECT x, y, CASE WHEN (x + y) % 11 <> 0 THEN (x * 37 + y * 91) % 211 * 1.0E0 END AS z, (x * y) % 17 * 1.0E0 AS relief FROM (SELECT DISTINCT o_orderkey % 97 AS x, o_orderkey % 89 AS y FROM {orders})"


@query(
    "A01_fingerprint",
    """SELECT source_set_id, sha256('[' || coalesce(string_agg('{"name":"' || name || '","sha256":"' || sha256 || '","bytes":' || bytes || '}', ',' ORDER BY name, sha256, bytes) FILTER (role = 'native'), '') || ']') AS fingerprint,
    count(*) FILTER (role = 'native') AS n_assets FROM assets GROUP BY source_set_id""",
    assets=ASSETS,
)
def _(t, assets):
    return A.fingerprint(assets, ["source_set_id"])


INDEX = "SELECT c_custkey % 1000 AS source_set_id, CASE c_nationkey % 4 WHEN 0 THEN 'preserved' WHEN 1 THEN 'queued' WHEN 2 THEN 'blocked' ELSE 'odd' END AS state, CASE c_nationkey % 3 WHEN 0 THEN 'skip' WHEN 1 THEN 'acquire' ELSE 'never' END AS action FROM {customer}"
SPECS = "SELECT p_partkey AS source_set_id FROM {part}"
RECEIPTS = "SELECT DISTINCT o_custkey AS source_set_id FROM {orders}"
STATES = {"preserved": "skip", "queued": "acquire", "blocked": "never"}


@query(
    "A02_quality_report",
    """WITH v AS (SELECT 'duplicate_id' AS rule, count(*) AS violations FROM (SELECT source_set_id FROM idx GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'unknown_state', count(*) FROM idx WHERE state NOT IN ('preserved', 'queued', 'blocked') OR state IS NULL
    UNION ALL SELECT 'action_mismatch', count(*) FROM idx WHERE (state, action) IN (('preserved', 'acquire'), ('preserved', 'never'), ('queued', 'skip'), ('queued', 'never'), ('blocked', 'skip'), ('blocked', 'acquire'))
    UNION ALL SELECT 'spec_without_state', count(*) FROM specs WHERE source_set_id NOT IN (SELECT source_set_id FROM idx)
    UNION ALL SELECT 'state_without_receipt', count(*) FROM idx WHERE source_set_id NOT IN (SELECT source_set_id FROM receipts))
    SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM v""",
    idx=INDEX, specs=SPECS, receipts=RECEIPTS,
)
def _(t, index, specs, receipts):
    return A.quality_report(index, specs, receipts, STATES)


CIRCLE = "SELECT s_suppkey AS zone, CAST((s_suppkey * 211) % 1009 AS DOUBLE) AS x, CAST((s_suppkey * 307) % 1013 AS DOUBLE) AS y, 60.0E0 AS r FROM {supplier}"


@query(
    "A03_catchment",
    """SELECT zone, count(*) AS features, sum(w) AS people, count(*) FILTER (w IS NULL) AS unknown FROM zones z JOIN points p ON power(p.x - z.x, 2) + power(p.y - z.y, 2) <= 3600 GROUP BY zone""",
    zones=CIRCLE, points=POINTS,
)
def _(t, zones, points):
    return A.catchment(zones, points, ["zone"], "id", "w", 60.0)


def shapes(points, *corners):
    """One ring a feature, by corners relative to its point."""
    return points.withColumn("rings", F.array(F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in corners])))


@query(
    "A03_point_catchment",
    """SELECT zone AS polygon_id, count(*) AS features, sum(w) AS people, count(*) FILTER (w IS NULL) AS unknown FROM zones z JOIN points p ON abs(p.x + 1 - z.x) + abs(p.y + 6 - z.y) BETWEEN z.r / 2 AND z.r OR abs(p.x + 1 - z.x - 100) + abs(p.y + 6 - z.y) <= 5 GROUP BY zone""",
    zones=CIRCLE, points=POINTS,
)
def _(t, zones, points):
    from calado.plans.join import holed

    bent = shapes(points, (0, 0), (8, 0), (8, 2), (2, 2), (2, 10), (0, 10))
    return A.point_catchment(bent, holed(zones), "id", "w", 60.0)


@query(
    "A03_area_catchment",
    """WITH c AS (SELECT zone, w, 0.5 * greatest(0, least(p.x + p.y + 4, z.x + z.y + r) - greatest(p.x + p.y - 4, z.x + z.y - r)) * greatest(0, least(p.x - p.y + 4, z.x - z.y + r) - greatest(p.x - p.y - 4, z.x - z.y - r)) AS cut FROM zones z JOIN points p ON abs(p.x - z.x) <= r + 4 AND abs(p.y - z.y) <= r + 4)
    SELECT zone AS polygon_id, count(*) AS met, count(*) FILTER (cut > 1e-9) AS intersecting, 0 AS invalid, sum(w * cut / 32) FILTER (cut > 1e-9) AS people FROM c GROUP BY zone""",
    zones=CIRCLE, points=POINTS,
)
def _(t, zones, points):
    from calado.plans.join import diamonds

    features = shapes(points, (4, 0), (0, 4), (-4, 0), (0, -4))
    return A.area_catchment_of(features, diamonds(zones).withColumn("rings", F.array("ring")), "w", 60.0, 1e-9)


@query("A04_union_catchment", "SELECT zone % 10 AS grp, sum(w) AS people, count(*) AS features FROM (SELECT DISTINCT zone % 10 AS zone, id, w FROM zones z JOIN points p ON power(p.x - z.x, 2) + power(p.y - z.y, 2) <= 3600) GROUP BY zone", zones=CIRCLE, points=POINTS)
def _(t, zones, points):
    return A.catchment(zones.withColumn("grp", F.col("zone") % 10), points, ["grp"], "id", "w", 60.0).select("grp", "people", "features")


@query(
    "A05_sample_cells",
    """WITH c AS (SELECT CAST(floor(x / 50) AS BIGINT) AS cx, CAST(floor(y / 50) AS BIGINT) AS cy, sum(w) AS total, first(id ORDER BY w DESC NULLS LAST, id) AS representative FROM points WHERE w IS NOT NULL GROUP BY 1, 2)
    SELECT *, row_number() OVER (ORDER BY total DESC, cx, cy) <= 100 AS sampled FROM c""",
    points=POINTS,
)
def _(t, points):
    return A.sample_cells(points.where("w IS NOT NULL"), 50.0, 100)


@query(
    "A06_access_by_threshold",
    """SELECT family, sum(CASE WHEN m <= 15 THEN residents ELSE 0 END) AS within_15, sum(CASE WHEN m <= 30 THEN residents ELSE 0 END) AS within_30, sum(CASE WHEN m IS NULL THEN residents ELSE 0 END) AS unknown, sum(residents) AS total
    FROM (SELECT *, CASE WHEN speed % 7 <> 0 THEN speed END AS m FROM options) GROUP BY family""",
    options=OPTIONS,
)
def _(t, options):
    return A.access_by_threshold(options.withColumn("m", F.when(F.col("speed") % 7 != 0, F.col("speed"))), ["family"], "m", "residents", [15, 30])


@query("A07_city_summary", "SELECT family, min(minutes) AS min_minutes, max(minutes) AS max_minutes, count(*) FILTER (speed <= 3) AS within_3km, count(*) FILTER (speed <= 8) AS within_8km, count(*) FILTER (speed <= 20) AS within_20km, count(minutes) AS qualified FROM options GROUP BY family", options=OPTIONS)
def _(t, options):
    return A.city_summary(options, ["family"], "speed", "minutes")


@query(
    "A08_zonal_stats",
    """WITH q AS (SELECT zone, count(z) AS n, quantile_cont(z, 0.05) AS a, quantile_cont(z, 0.5) AS b, quantile_cont(z, 0.95) AS c FROM cells GROUP BY zone)
    SELECT zone, n, CASE WHEN n >= 50 THEN a END AS p05, CASE WHEN n >= 50 THEN b END AS p50, CASE WHEN n >= 50 THEN c END AS p95, CASE WHEN n >= 50 THEN c - a END AS relief FROM q""",
    cells=CELLS,
)
def _(t, cells):
    return A.zonal_stats(cells, [F.col("zone")], "z", 50)


@query(
    "A09_crossres",
    """WITH m AS (SELECT CAST(floor(row / 5) AS BIGINT) AS row, CAST(floor(col / 5) AS BIGINT) AS col, avg(z) AS m FROM cells GROUP BY 1, 2), r AS (SELECT c.z - m.m AS r FROM cells c JOIN m ON c.row = m.row AND c.col = m.col WHERE c.z IS NOT NULL AND m.m IS NOT NULL)
    SELECT count(*) AS n, avg(r) AS mean, median(r) AS median, avg(abs(r)) AS mae, sqrt(avg(r * r)) AS rms, quantile_cont(abs(r), 0.95) AS p95, quantile_cont(abs(r), 0.99) AS p99, avg(CASE WHEN abs(r) > 1 THEN 1.0 ELSE 0.0 END) AS share_over_1 FROM r""",
    cells=CELLS,
)
def _(t, cells):
    return A.crossres(cells, cells, 5)


@query("A10_raster_qa", "SELECT zone, count(z) AS valid, count(*) - count(z) AS nodata, min(z) AS zmin, max(z) AS zmax, avg(z) AS zmean, coalesce(min(z) >= -5 AND max(z) <= 95, false) AS plausible, count(*) = 60 AS closed FROM cells GROUP BY zone", cells=CELLS)
def _(t, cells):
    return A.raster_qa(cells, ["zone"], -5.0, 95.0, 60)


_D = "(coalesce(lead(z) OVER {w}, z) - coalesce(lag(z) OVER {w}, z)) / nullif((coalesce(lead({o}) OVER {w}, {o}) - coalesce(lag({o}) OVER {w}, {o})) * 2.0, 0)"


@query(
    "A11_slope_stats",
    f"""WITH g AS (SELECT {_D.format(w='wr', o='col')} AS gx, {_D.format(w='wc', o='row')} AS gy FROM cells WINDOW wr AS (PARTITION BY row ORDER BY col), wc AS (PARTITION BY col ORDER BY row)),
    s AS (SELECT sqrt(gx * gx + gy * gy) * 100 AS slope FROM g WHERE gx IS NOT NULL AND gy IS NOT NULL)
    SELECT count(*) AS n, median(slope) AS p50, quantile_cont(slope, 0.9) AS p90, max(slope) AS max_slope, avg(CASE WHEN slope < 5 THEN 1.0 ELSE 0.0 END) AS below_5, avg(CASE WHEN slope < 15 THEN 1.0 ELSE 0.0 END) AS below_15 FROM s""",
    cells=CELLS,
)
def _(t, cells):
    return A.slope_stats(cells, 2.0)


@query(
    "A12_pressure",
    "SELECT grp, sum(abs(d) * s) / sum(s) AS mean_abs, sum(CASE WHEN d < -25 THEN s ELSE 0 END) AS below_25, sum(CASE WHEN d < -50 THEN s ELSE 0 END) AS below_50, sum(CASE WHEN d > 25 THEN s ELSE 0 END) AS above_25 FROM (SELECT *, z - 40 AS d FROM profile) GROUP BY grp",
    profile=PROFILE,
)
def _(t, profile):
    return A.pressure(profile.withColumn("d", F.col("z") - 40), ["grp"], "d", "s")


@query("A13_class_shares", "SELECT zone, kind, area, area / 5000 AS share FROM (SELECT c_nationkey AS zone, c_mktsegment AS kind, sum(abs(c_acctbal)) AS area FROM customer GROUP BY 1, 2)")
def _(t):
    parts = t("customer").select(F.col("c_nationkey").alias("zone"), F.col("c_mktsegment").alias("kind"), F.abs("c_acctbal").alias("a"))
    return A.class_shares(parts, ["zone"], "kind", "a", F.lit(5000.0))


@query(
    "A14_rect_union",
    """WITH r AS (SELECT scan, tile_id % 40 AS win, xmin, ymin, xmax, ymax FROM rects), e AS (SELECT scan, win, x, lead(x) OVER (PARTITION BY scan, win ORDER BY x) AS x1 FROM (SELECT scan, win, xmin AS x FROM r UNION SELECT scan, win, xmax FROM r)),
    i AS (SELECT e.scan, e.win, e.x, e.x1, r.ymin, r.ymax, max(r.ymax) OVER (PARTITION BY e.scan, e.win, e.x ORDER BY r.ymin, r.ymax ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e JOIN r ON r.scan = e.scan AND r.win = e.win AND r.xmin <= e.x AND r.xmax >= e.x1 WHERE e.x1 IS NOT NULL)
    SELECT scan, win, sum(greatest(ymax - greatest(ymin, coalesce(top, ymin)), 0) * (x1 - x)) AS area FROM i GROUP BY scan, win""",
    rects=RECTS,
)
def _(t, rects):
    return A.rect_union(rects.withColumn("win", F.col("tile_id") % 40), ["scan", "win"])


@query(
    "A15_field_inventory",
    """WITH kv AS (SELECT 'event_type' AS key, event_type AS value FROM events UNION ALL SELECT 'k', json_extract_string(props, '$.k') FROM events UNION ALL SELECT 'other', json_extract_string(props, '$.other') FROM events),
    d AS (SELECT key, value, row_number() OVER (PARTITION BY key ORDER BY value) AS i FROM (SELECT DISTINCT key, value FROM kv WHERE value IS NOT NULL))
    SELECT kv.key, count(*) AS rows, count(value) AS filled, (SELECT coalesce(string_agg(d.value, '|' ORDER BY d.value), '') FROM d WHERE d.key = kv.key AND d.i <= 5) AS samples FROM kv GROUP BY kv.key""",
)
def _(t):
    rows = t("events").select(F.create_map(F.lit("event_type"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k"), F.lit("other"), F.get_json_object("props", "$.other")).alias("m"))
    return A.field_inventory(rows, "m")


@query("A15_schema_signatures", "SELECT signature, CAST(len(string_split(signature, '|')) AS INTEGER) AS keys, count(*) AS rows FROM (SELECT concat_ws('|', CASE WHEN o_custkey % 3 = 0 THEN 'clerk' END, 'key', CASE WHEN o_orderkey % 2 = 0 THEN 'status' END) AS signature FROM orders) GROUP BY 1")
def _(t):
    maybe = lambda ok, name: F.when(ok, F.array(F.struct(F.lit(name).alias("k"), F.lit("v").alias("v")))).otherwise(F.array().cast("array<struct<k:string,v:string>>"))
    fields = F.map_from_entries(F.concat(maybe(F.col("o_orderkey") % 2 == 0, "status"), maybe(F.lit(True), "key"), maybe(F.col("o_custkey") % 3 == 0, "clerk")))
    return A.schema_signatures(t("orders").select(fields.alias("m")), "m")


BASKETS = "SELECT DISTINCT l_suppkey % 60 AS item, l_partkey % 300 AS member FROM {lineitem}"
_PAIRS = """WITH n AS (SELECT item, count(*) AS n FROM sets GROUP BY item), c AS (SELECT a.item AS a, b.item AS b, count(*) AS common FROM sets a JOIN sets b ON a.member = b.member AND a.item < b.item GROUP BY 1, 2)
    SELECT a, b, common, na.n + nb.n - common AS total, common / (na.n + nb.n - common) AS jaccard FROM c JOIN n na ON na.item = a JOIN n nb ON nb.item = b"""


@query("A16_module_overlap", _PAIRS, sets=BASKETS)
def _(t, sets):
    return A.pair_overlap(sets, "item", "member")


@query(
    "A16_nearest_set",
    _PAIRS.replace("SELECT a, b, common", ", p AS (SELECT a, b, na.n AS n, common").replace("FROM c JOIN n na", "FROM c JOIN n na", 1)
    + """), d AS (SELECT a AS item, n, b AS other, common, jaccard FROM p UNION ALL SELECT b, m.n, a, common, jaccard FROM p JOIN n m ON m.item = b), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY jaccard DESC, other) AS i FROM d)
    SELECT n.item, n.n, other, common, jaccard FROM n LEFT JOIN r ON r.item = n.item AND r.i = 1""",
    sets=f"SELECT DISTINCT item, member FROM ({BASKETS}) AS b WHERE item % 3 > 0 UNION ALL SELECT DISTINCT item, -1 - item % 2 FROM ({BASKETS}) AS h WHERE item % 3 < 2",
)
def _(t, sets):
    return A.nearest_set(sets, "item", "member", hot=64)


@query("A17_cell_frequency", "SELECT x, y, count(DISTINCT route) AS variants, count(DISTINCT route) = (SELECT count(DISTINCT route) FROM steps) AS common FROM steps GROUP BY x, y ORDER BY variants DESC, x, y LIMIT 25", steps=STEPS)
def _(t, steps):
    return A.cell_frequency(steps, ["x", "y"], "route")


@query("A17_missing_ground", "SELECT s.x, s.y, count(DISTINCT route) AS variants, count(DISTINCT route) = (SELECT count(DISTINCT route) FROM steps) AS common FROM steps s LEFT JOIN grid g ON s.x = g.x AND s.y = g.y AND g.z IS NOT NULL WHERE g.x IS NULL GROUP BY s.x, s.y", steps=STEPS, grid=GRID)
def _(t, steps, grid):
    return A.missing_ground(steps, grid, ["x", "y"], "route", top=None)


@query("A18_topk_hits", "SELECT option_id, count(*) FILTER (rank <= 8) AS hits, count(*) AS rankings, min(rank) AS best FROM (SELECT l_partkey AS option_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice, l_orderkey, l_linenumber) AS rank FROM lineitem) GROUP BY option_id")
def _(t):
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_extendedprice", "l_orderkey", "l_linenumber"))
    return A.topk_hits(t("lineitem").select(F.col("l_partkey").alias("option_id"), rank.alias("rank")), "option_id", "rank", 8)


@query(
    "A19_hotspots",
    """WITH b AS (SELECT grp, CAST(floor(s / 500) AS BIGINT) AS block, quantile_cont(abs(z), 0.9) AS p90, avg(CASE WHEN abs(z) > 25 THEN 1.0 ELSE 0.0 END) AS over_25, avg(CASE WHEN abs(z) > 50 THEN 1.0 ELSE 0.0 END) AS over_50 FROM profile GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY p90 DESC, block) AS rank FROM b) WHERE rank <= 4""",
    profile=PROFILE,
)
def _(t, profile):
    return A.hotspots(profile, ["grp"], "s", "z", 500.0, 4)


@query("A20_reconcile", "SELECT l_suppkey, d AS difference, abs(d) <= 0.01 AS balanced FROM (SELECT l_suppkey, sum(CAST(l_quantity AS DECIMAL(18,2))) + sum(CAST(l_tax AS DECIMAL(18,2))) - sum(CAST(l_quantity AS DECIMAL(18,2))) AS d FROM lineitem GROUP BY 1)")
def _(t):
    return A.reconcile(t("lineitem").withColumn("whole", F.col("l_quantity")), ["l_suppkey"], ["l_quantity", "l_tax"], "whole")


@query(
    "A21_coverage",
    """WITH req AS (SELECT CAST(n_regionkey AS BIGINT) AS dim, n_name AS code FROM nation), obs AS (SELECT DISTINCT CAST(n_regionkey AS BIGINT) AS dim, n_name AS code FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 11 = 0)
    SELECT r.dim, count(*) AS requested, count(*) FILTER (o.code IS NULL) AS missing, coalesce(string_agg(r.code, ',' ORDER BY r.code) FILTER (o.code IS NULL), '') AS missing_codes, bool_and(o.code IS NOT NULL) AS complete FROM req r LEFT JOIN obs o ON r.dim = o.dim AND r.code = o.code GROUP BY r.dim""",
)
def _(t):
    nations = t("nation").select("n_nationkey", F.col("n_regionkey").cast("long").alias("dim"), F.col("n_name").alias("code"))
    seen = t("customer").where("c_custkey % 11 = 0").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return A.coverage(nations, seen, "dim", "code")


@query(
    "A21_forced_requests",
    """WITH c AS (SELECT o_custkey % 50 AS request, o_orderpriority AS code, o_orderstatus AS state, o_orderkey % 5 > 0 OR o_custkey % 50 > 24 AS plain, o_orderkey % 11 > 0 AS named FROM orders),
    a AS (SELECT request, count(DISTINCT code) AS whole, count(DISTINCT code) FILTER (plain AND state = 'F') AS seen FROM c GROUP BY request),
    k AS (SELECT DISTINCT c.request, code, CASE WHEN whole <> seen THEN named ELSE plain AND state = 'F' END AS kept FROM c JOIN a USING (request)), q AS (SELECT DISTINCT code FROM c), s AS (SELECT DISTINCT code FROM k WHERE kept)
    SELECT 'priority' AS dim, count(*) AS requested, count(*) FILTER (s.code IS NULL) AS missing, coalesce(string_agg(q.code, ',' ORDER BY q.code) FILTER (s.code IS NULL), '') AS missing_codes, bool_and(s.code IS NOT NULL) AS complete, (SELECT count(*) FILTER (whole <> seen) FROM a) AS asked_again FROM q LEFT JOIN s USING (code)""",
)
def _(t):
    rows = t("orders").select((F.col("o_custkey") % 50).alias("request"), F.col("o_orderpriority").alias("code"), (F.col("o_orderkey") % 5 > 0).alias("_a"), (F.col("o_custkey") % 50 > 24).alias("_b"), (F.col("o_orderkey") % 11 > 0).alias("_n"), (F.col("o_orderstatus") == "F").alias("_f"))
    plan = rows.groupBy("request").agg(F.collect_set("code").alias("codes")).select("request", F.lit("priority").alias("dim"), "codes", F.lit(True).alias("omitted"), F.lit(False).alias("explicit"))

    def respond(asked):
        met = rows.join(asked.select("request", "explicit"), "request")
        return met.where(F.when(F.col("explicit"), F.col("_n")).otherwise((F.col("_a") | F.col("_b")) & F.col("_f"))).select("request", F.lit("priority").alias("dim"), "code")

    found, _ = A.covered_by_requests(plan, respond)
    again = A.forced_requests(plan, respond(plan)).agg(F.count(F.lit(1)).alias("asked_again"))
    return found.join(F.broadcast(again))


@query("A22_dedupe_strict", "SELECT l_partkey, l_suppkey, count(*) AS copies, count(DISTINCT l_returnflag) > 1 AS conflict FROM lineitem GROUP BY 1, 2")
def _(t):
    return A.dedupe_strict(t("lineitem"), ["l_partkey", "l_suppkey"], ["l_returnflag"])


STRIPS = "SELECT user_id AS site, row_number() OVER (PARTITION BY user_id ORDER BY event_id) * 1.0E0 AS along, CASE WHEN event_id % 61 <> 0 THEN CAST(value AS DOUBLE) END AS z FROM {events}"


@query(
    "A23_plane_fit",
    """WITH f AS (SELECT site, greatest(-0.015, least(0.015, regr_slope(z, along))) AS grade, count(z) / count(*) AS valid_share FROM strips GROUP BY site),
    b AS (SELECT s.site, f.grade, f.valid_share, z - f.grade * along AS b FROM strips s JOIN f ON s.site = f.site), i AS (SELECT site, median(b) AS intercept FROM b GROUP BY site),
    r AS (SELECT b.site, grade, valid_share, intercept, b - intercept AS r FROM b JOIN i ON b.site = i.site)
    SELECT site, valid_share, CASE WHEN valid_share >= 0.98 THEN min(grade) END AS grade, CASE WHEN valid_share >= 0.98 THEN min(intercept) END AS intercept, CASE WHEN valid_share >= 0.98 THEN quantile_cont(abs(r), 0.9) END AS p90,
      CASE WHEN valid_share >= 0.98 THEN sum(CASE WHEN r IS NULL THEN 0 ELSE greatest(r, 0) * 4 END) END AS cut, CASE WHEN valid_share >= 0.98 THEN sum(CASE WHEN r IS NULL THEN 0 ELSE greatest(-r, 0) * 4 END) END AS fill FROM r GROUP BY site, valid_share""",
    strips=STRIPS,
)
def _(t, strips):
    return A.plane_fit(strips, ["site"], 0.015, 4.0)


MARKS = "SELECT s_suppkey AS mark, CAST((s_suppkey * 7) % 20 AS BIGINT) AS row, CAST((s_suppkey * 13) % 50 AS BIGINT) AS col, s_acctbal / 100 AS height FROM {supplier}"


@query(
    "A24_mark_residuals",
    """SELECT m.mark, m.height - max(CASE WHEN c.row = m.row AND c.col = m.col THEN c.z END) AS centre, m.height - median(c.z) AS around, count(c.z) AS n FROM marks m LEFT JOIN cells c ON abs(c.row - m.row) <= 1 AND abs(c.col - m.col) <= 1 GROUP BY m.mark, m.height""",
    marks=MARKS, cells=CELLS,
)
def _(t, marks, cells):
    return J.mark_residuals(marks, cells.select("row", "col", "z"))


@query(
    "A24_residual_summary",
    """WITH r AS (SELECT m.mark, m.height - max(CASE WHEN c.row = m.row AND c.col = m.col THEN c.z END) AS centre FROM marks m LEFT JOIN cells c ON c.row = m.row AND c.col = m.col GROUP BY m.mark, m.height)
    SELECT mark % 3 AS part, count(centre) AS n, avg(centre) AS mean, median(centre) AS median, min(centre) AS least, max(centre) AS greatest, max(abs(centre)) AS max_abs FROM r GROUP BY 1""",
    marks=MARKS, cells=CELLS,
)
def _(t, marks, cells):
    return J.residual_summary(J.mark_residuals(marks, cells.select("row", "col", "z")).withColumn("part", F.col("mark") % 3), ["part"])


@query("A25_strict_mean", "SELECT zone, CASE WHEN count(z) = count(*) THEN avg(z) END AS strict_mean FROM cells GROUP BY zone", cells=CELLS)
def _(t, cells):
    return cells.groupBy("zone").agg(A.strict_mean("z").alias("strict_mean"))


@query("A26_overlap_matrix", "SELECT a.item AS a, b.item AS b, count(*) AS common FROM sets a JOIN sets b ON a.member = b.member AND a.item < b.item GROUP BY 1, 2", sets="SELECT DISTINCT scan AS item, tile_id % 700 AS member FROM (SELECT c_mktsegment AS scan, c_custkey AS tile_id FROM {customer})")
def _(t, sets):
    return A.pair_overlap(sets, "item", "member").select("a", "b", "common")


@query("A27_scan_summary", "SELECT scan, bool_and(xmax - xmin < 29) AS complete, count(DISTINCT tile_id) AS tiles, count(DISTINCT CAST(ymin AS BIGINT)) AS windows FROM rects GROUP BY scan", rects=RECTS)
def _(t, rects):
    rows = rects.withColumn("complete", F.col("xmax") - F.col("xmin") < 29).withColumn("win", F.col("ymin").cast("long"))
    return A.scan_summary(rows, ["scan"], "win", "tile_id")


@query(
    "A27_paired_products",
    """WITH p AS (SELECT scan, tile_id % 200 AS tile, ymin, CAST(xmin AS BIGINT) % 3 AS product FROM rects), n AS (SELECT scan, count(DISTINCT product) AS products FROM p GROUP BY scan), m AS (SELECT scan, tile, count(DISTINCT product) AS k FROM p GROUP BY 1, 2)
    SELECT p.scan, bool_and(p.tile < 195) AS complete, count(DISTINCT p.tile) AS tiles, count(DISTINCT CAST(ymin AS BIGINT)) AS windows, CAST(any_value(n.products) AS INTEGER) AS products, any_value((SELECT count(*) FROM m WHERE m.scan = n.scan AND m.k = n.products)) AS paired FROM p JOIN n ON n.scan = p.scan GROUP BY p.scan""",
    rects=RECTS,
)
def _(t, rects):
    rows = rects.select("scan", (F.col("tile_id") % 200).alias("tile"), F.col("ymin").cast("long").alias("win"), (F.col("xmin").cast("long") % 3).alias("product"))
    return A.scan_summary(rows.withColumn("complete", F.col("tile") < 195), ["scan"], "win", "tile", "product")


@query(
    "A28_measure_routes",
    """WITH r AS (SELECT s.route, s.seq, s.x, s.y, g.z, g.relief FROM steps s LEFT JOIN grid g ON s.x = g.x AND s.y = g.y), d AS (SELECT *, sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)) AS d, abs(z - lag(z) OVER w) AS s FROM r WINDOW w AS (PARTITION BY route ORDER BY seq))
    SELECT route, count(*) AS cells, coalesce(sum(d), 0) AS length, max(z) - min(z) AS range, median(relief) AS relief, max(s) AS max_step, count(z) / count(*) AS ground_share FROM d GROUP BY route""",
    steps=STEPS, grid=GRID,
)
def _(t, steps, grid):
    return A.measure_routes(steps, grid, "route", "seq", ["x", "y"])


@query("A29_separation", "SELECT a.grp AS a, b.grp AS b, max(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))) AS separation, count(*) AS chainages FROM p a JOIN p b ON a.s = b.s AND a.grp < b.grp GROUP BY 1, 2", p=PROFILE)
def _(t, p):
    return A.separation(p, "grp", "s")
