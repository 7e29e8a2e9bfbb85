"""Queries of the joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.functions import geometry as G
from calado.operators import joins as J
from calado.operators import spatial as S
from calado.plans._query import query
from calado.plans.aggregate import CELLS, CIRCLE, POINTS
from calado.plans.sequence import OPTIONS, PROFILE, RECTS


@query("J01_join_exact", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def _(t):
    orders = t("orders")
    return J.join_exact(orders.select("o_orderkey", "o_custkey", "o_totalprice"), orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey", "o_custkey"])


@query("J02_bbox_join", "SELECT a.tile_id AS tile_a, b.tile_id AS tile_b FROM rects a JOIN rects b ON a.scan = 'BUILDING' AND b.scan = 'MACHINERY' AND a.xmin <= b.xmax AND a.xmax >= b.xmin AND a.ymin <= b.ymax AND a.ymax >= b.ymin", rects=RECTS)
def _(t, rects):
    met = J.bbox_join(rects.where("scan = 'BUILDING'"), rects.where("scan = 'MACHINERY'"), 50.0)
    return met.select(F.col("tile_id_a").alias("tile_a"), F.col("tile_id_b").alias("tile_b"))


ZONES = "SELECT zone, x, y, 10.0E0 + zone % 40 AS r FROM (SELECT s_suppkey AS zone, CAST((s_suppkey * 211) % 1009 AS DOUBLE) AS x, CAST((s_suppkey * 307) % 1013 AS DOUBLE) AS y FROM {supplier})"


def diamonds(zones):
    """Polygons with four corners around points."""
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    r = F.col("r")
    return zones.select(F.col("zone").alias("polygon_id"), F.array(corner(r, 0 * r), corner(0 * r, r), corner(-r, 0 * r), corner(0 * r, -r)).alias("ring"))


@query("J03_pip_join", "SELECT id, zone AS polygon_id FROM points p JOIN zones z ON abs(p.x - z.x) + abs(p.y - z.y) < z.r - 1e-9", points=POINTS.replace("AS DOUBLE) AS x", "AS DOUBLE) + 0.25E0 AS x").replace("AS DOUBLE) AS y", "AS DOUBLE) + 0.125E0 AS y"), zones=ZONES)
def _(t, points, zones):
    return J.pip_join(points, diamonds(zones), 60.0).select("id", "polygon_id")


def holed(zones):
    """Diamonds around points with a hole of half their size, and a small diamond 100 to the east as a second part."""
    ring = lambda x, y, r: F.array(*[F.struct((F.col("x") + x + dx * r).alias("x"), (F.col("y") + y + dy * r).alias("y")) for dx, dy in ((1, 0), (0, 1), (-1, 0), (0, -1))])
    r = F.col("r")
    return zones.select(F.col("zone").alias("polygon_id"), F.array(ring(0, 0, r), ring(0, 0, r / 2), ring(100, 0, F.lit(5.0))).alias("rings"))


@query("J03_covers_join", "SELECT id, zone AS polygon_id FROM points p JOIN zones z ON abs(p.x - z.x) + abs(p.y - z.y) BETWEEN z.r / 2 AND z.r OR abs(p.x - z.x - 100) + abs(p.y - z.y) <= 5", points=POINTS, zones=ZONES)
def _(t, points, zones):
    return J.covers_join(points, holed(zones), 60.0).select("id", "polygon_id")


@query("J04_within_distance", "SELECT zone, id, sqrt(power(p.x - z.x, 2) + power(p.y - z.y, 2)) AS distance FROM zones z JOIN points p ON power(p.x - z.x, 2) + power(p.y - z.y, 2) <= 900", zones=CIRCLE, points=POINTS)
def _(t, zones, points):
    return J.within_distance(zones.select("zone", "x", "y"), points.select("id", "x", "y"), 30.0).select("zone", "id", "distance")


@query("J05_nearest", "SELECT zone, id, distance FROM (SELECT zone, id, sqrt(power(p.x - z.x, 2) + power(p.y - z.y, 2)) AS distance, row_number() OVER (PARTITION BY zone ORDER BY power(p.x - z.x, 2) + power(p.y - z.y, 2), id) AS i FROM zones z, points p) WHERE i = 1", zones=CIRCLE, points=POINTS)
def _(t, zones, points):
    return J.nearest(zones, points, "zone", "id", 25.0).select("zone", "id", "distance")


@query("J05_k_nearest", "SELECT zone, id, distance, rank FROM (SELECT zone, id, sqrt(power(p.x - z.x, 2) + power(p.y - z.y, 2)) AS distance, CAST(row_number() OVER (PARTITION BY zone ORDER BY power(p.x - z.x, 2) + power(p.y - z.y, 2), id) AS INTEGER) AS rank FROM zones z, points p) WHERE rank <= 7", zones=CIRCLE, points=POINTS)
def _(t, zones, points):
    return J.k_nearest(zones, points, "zone", "id", 7, 25.0)


@query("J06_sample_raster", "SELECT id, c.z, CASE WHEN c.row IS NULL THEN 'no_cell' WHEN c.z IS NULL THEN 'no_data' ELSE 'value' END AS status FROM points p LEFT JOIN cells c ON c.row = CAST(floor(p.y / 20) AS BIGINT) AND c.col = CAST(floor(p.x / 20) AS BIGINT)", points=POINTS, cells=CELLS)
def _(t, points, cells):
    return J.sample_raster(points, cells, 20.0).select("id", "z", "status")


TILES = "SELECT DISTINCT l_partkey % 61 AS tx, l_suppkey % 53 AS ty FROM {lineitem} WHERE l_orderkey % 7 <> 0"


@query(
    "J07_complete_cells",
    "SELECT CAST(floor(tx / 2) AS BIGINT) AS cx, CAST(floor(ty / 2) AS BIGINT) AS cy FROM tiles GROUP BY 1, 2 HAVING count(*) = 4",
    tiles=TILES,
)
def _(t, tiles):
    cells = tiles.select(F.floor(F.col("tx") / 2).alias("cx"), F.floor(F.col("ty") / 2).alias("cy")).distinct()
    return J.complete_cells(cells, tiles)


@query(
    "J08_tile_gaps",
    "WITH need AS (SELECT DISTINCT l_shipdate IS NOT NULL AND l_returnflag = 'A' AS f, l_suppkey AS grp, l_partkey AS tile FROM lineitem), have AS (SELECT DISTINCT l_partkey AS tile FROM lineitem WHERE l_quantity > 40) SELECT grp, count(*) AS required, count(*) FILTER (h.tile IS NULL) AS missing, count(h.tile) / count(*) AS share FROM (SELECT DISTINCT grp, tile FROM need) n LEFT JOIN have h ON n.tile = h.tile GROUP BY grp",
)
def _(t):
    items = t("lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("tile"), "l_quantity")
    return J.tile_gaps(items, items.where("l_quantity > 40"), "grp", "tile")


@query(
    "J09_pair_products",
    """WITH a AS (SELECT * FROM rects WHERE tile_id % 5 <> 0), b AS (SELECT tile_id, CASE WHEN tile_id % 9 = 0 THEN xmin + 2 ELSE xmin END AS xmin, ymin, xmax, ymax FROM rects WHERE tile_id % 7 <> 0)
    SELECT coalesce(a.tile_id, b.tile_id) AS tile_id, CASE WHEN a.xmin IS NULL THEN 'only_b' WHEN b.xmin IS NULL THEN 'only_a' WHEN abs(a.xmin - b.xmin) <= 1e-9 THEN 'equal' ELSE 'moved' END AS status, abs(a.xmin - b.xmin) AS displacement FROM a FULL JOIN b ON a.tile_id = b.tile_id""",
    rects=RECTS,
)
def _(t, rects):
    other = rects.where("tile_id % 7 <> 0").withColumn("xmin", F.when(F.col("tile_id") % 9 == 0, F.col("xmin") + 2).otherwise(F.col("xmin")))
    return J.pair_products(rects.where("tile_id % 5 <> 0"), other, "tile_id")


#: Both products as tiles in degrees, with names of prefix and number; the finer one has some of its boxes moved.
_TILES = "SELECT concat('{p}-', tile_id) AS name, xmin / 200 - 10{move} AS xmin, ymin / 200 + 37 AS ymin, xmax / 200 - 10 AS xmax, ymax / 200 + 37{up} AS ymax FROM ({rects}) r WHERE tile_id % {gone} <> 0"
COARSE = _TILES.format(p="coarse", move="", up="", gone=5, rects=RECTS)
FINE = _TILES.format(p="fine", move=" + CASE WHEN tile_id % 9 = 0 THEN 1.0E-4 ELSE 0 END", up=" + CASE WHEN tile_id % 11 = 0 THEN 2.0E-4 ELSE 0 END", gone=7, rects=RECTS)


@query(
    "J09_pair_by_suffix",
    """WITH a AS (SELECT *, substr(name, 8) AS suffix FROM coarse), b AS (SELECT *, substr(name, 6) AS suffix FROM fine),
    m AS (SELECT coalesce(a.suffix, b.suffix) AS suffix, a.name AS an, b.name AS bn, abs(a.xmin - b.xmin) AS w, abs(a.ymin - b.ymin) AS s, abs(a.xmax - b.xmax) AS e, abs(a.ymax - b.ymax) AS n, (a.ymin + a.ymax + b.ymin + b.ymax) / 4 AS lat FROM a FULL JOIN b ON a.suffix = b.suffix)
    SELECT suffix, CASE WHEN an IS NULL THEN 'only_b' WHEN bn IS NULL THEN 'only_a' WHEN greatest(w, s, e, n) = 0 THEN 'equal' ELSE 'moved' END AS status, CASE WHEN an IS NOT NULL AND bn IS NOT NULL THEN greatest(w * cos(radians(lat)), s, e * cos(radians(lat)), n) * 111195 END AS metres FROM m""",
    coarse=COARSE,
    fine=FINE,
)
def _(t, coarse, fine):
    return J.pair_by_suffix(coarse, fine, "name", ("coarse-", "fine-"))


@query(
    "J10_seam_stats",
    """WITH c AS (SELECT CAST(floor(col / 10) AS BIGINT) AS tile, row, col, z FROM cells)
    SELECT a.tile, count(b.z - a.z) AS pairs, median(abs(b.z - a.z)) AS median_abs, max(abs(b.z - a.z)) AS max_abs, avg(b.z - a.z) AS mean_step FROM c a JOIN c b ON a.col % 10 = 9 AND b.col = a.col + 1 AND a.row = b.row GROUP BY a.tile""",
    cells=CELLS,
)
def _(t, cells):
    tiled = cells.withColumn("tile", F.floor(F.col("col") / 10))
    return J.seam_stats(tiled, "tile", F.col("tile") + 1, F.col("col") % 10 == 9, F.col("col") % 10 == 0, "row")


@query(
    "J11_compare_grids",
    """WITH b AS (SELECT row, col, CASE WHEN col % 13 <> 0 THEN z + CASE WHEN row % 17 = 0 THEN 1 ELSE 0 END END AS z FROM cells WHERE row > 0)
    SELECT count(*) FILTER (a.row IS NOT NULL AND b.row IS NOT NULL AND a.z IS NOT DISTINCT FROM b.z) AS equal, count(*) FILTER (a.row IS NOT NULL AND b.row IS NOT NULL AND (a.z IS NULL) <> (b.z IS NULL)) AS mask_differs,
    count(*) FILTER (a.row IS NULL OR b.row IS NULL) AS one_side, max(abs(a.z - b.z)) AS max_difference FROM cells a FULL JOIN b ON a.row = b.row AND a.col = b.col""",
    cells=CELLS,
)
def _(t, cells):
    other = cells.where("row > 0").withColumn("z", F.when(F.col("col") % 13 != 0, F.col("z") + F.when(F.col("row") % 17 == 0, 1).otherwise(0)))
    return J.compare_grids(cells, other, ["row", "col"])


@query("J12_expand", "SELECT option_id, shift, heading FROM options, (VALUES (-50), (0), (50)) s(shift), (VALUES (-5), (0), (5)) h(heading)", options=OPTIONS)
def _(t, options):
    return J.expand(options.select("option_id"), shift=[-50, 0, 50], heading=[-5, 0, 5])


@query("J13_delta_vs_baseline", "SELECT l_orderkey, l_linenumber, l_extendedprice - max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) OVER (PARTITION BY l_orderkey) AS delta_l_extendedprice FROM lineitem")
def _(t):
    return J.delta_vs_baseline(t("lineitem"), ["l_orderkey"], F.col("l_linenumber") == 1, ["l_extendedprice"]).select("l_orderkey", "l_linenumber", "delta_l_extendedprice")


@query(
    "J13_delta_pairs",
    "WITH k AS (SELECT o_orderkey AS variant, o_orderkey - o_orderkey % 7 AS base FROM orders WHERE o_orderkey % 7 > 0) SELECT variant, base, v.o_totalprice - b.o_totalprice AS delta_o_totalprice FROM k LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 5 > 0) v ON v.o_orderkey = variant LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 5 > 0) b ON b.o_orderkey = base",
)
def _(t):
    pairs = t("orders").where("o_orderkey % 7 > 0").selectExpr("o_orderkey AS variant", "o_orderkey - o_orderkey % 7 AS base")
    return J.delta_pairs(t("orders").where("o_orderkey % 5 > 0"), "o_orderkey", pairs, ["o_totalprice"])


@query("J14_new_only", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(t):
    return J.new_only(t("customer").select("c_custkey", "c_name"), t("orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", t("customer").select("c_custkey"))


@query("J15_latest", "SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS i FROM orders) WHERE i = 1")
def _(t):
    return J.latest(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"])


@query(
    "J16_pick_source",
    """SELECT id, first(tile_id ORDER BY power(x - (xmin + xmax) / 2, 2) + power(y - (ymin + ymax) / 2, 2), tile_id) AS tile_id, count(*) AS sources, max(z) - min(z) AS spread, CAST(len(list_filter(list(z), lambda v: abs(v - first(z ORDER BY power(x - (xmin + xmax) / 2, 2) + power(y - (ymin + ymax) / 2, 2), tile_id)) > 5)) AS INTEGER) AS disagreeing FROM points p JOIN (SELECT *, tile_id % 31 AS z FROM rects) r ON p.x BETWEEN xmin AND xmax AND p.y BETWEEN ymin AND ymax GROUP BY id""",
    points=POINTS, rects=RECTS,
)
def _(t, points, rects):
    return J.pick_source(points, rects.withColumn("z", F.col("tile_id") % 31), 50.0, 5.0)


@query("J17_attach_meta", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    meta = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return J.attach_meta(t("customer"), meta, "c_nationkey").select("c_custkey", "n_name")


def within_diamonds(edges: str) -> str:
    """SQL of ``exposure`` (edge_id, inside): the length of edges in the union of the diamonds of ``zones``, by the half-planes of their sides."""
    return f"""sides AS (SELECT edge_id, zone, sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) AS len, nx * (bx - ax) + ny * (by_ - ay) AS den, r + nx * (z.x - ax) + ny * (z.y - ay) AS num FROM {edges} e JOIN zones z ON least(ax, bx) <= z.x + r AND greatest(ax, bx) >= z.x - r AND least(ay, by_) <= z.y + r AND greatest(ay, by_) >= z.y - r,
      (VALUES (1, 1), (1, -1), (-1, 1), (-1, -1)) AS n(nx, ny)),
    spans AS (SELECT edge_id, zone, any_value(len) AS len, greatest(0, max(CASE WHEN den < 0 THEN num / den END)) AS lo, least(1, min(CASE WHEN den > 0 THEN num / den END)) AS hi FROM sides GROUP BY edge_id, zone HAVING bool_and(den <> 0 OR num >= 0)),
    parts AS (SELECT edge_id, len * greatest(0, hi - greatest(lo, coalesce(max(hi) OVER (PARTITION BY edge_id ORDER BY lo, hi, zone ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS part FROM spans WHERE lo < hi),
    exposure AS (SELECT edge_id, sum(part) AS inside FROM parts GROUP BY edge_id)"""


@query(
    "J18_edge_exposure",
    "WITH " + within_diamonds("(SELECT grp || '-' || seq AS edge_id, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM profile WINDOW w AS (PARTITION BY grp ORDER BY seq))") + " SELECT edge_id, inside FROM exposure WHERE inside > 1e-9",
    profile=PROFILE, zones=ZONES,
)
def _(t, profile, zones):
    """Length of each profile step inside polygons."""
    from pyspark.sql import Window

    w = Window.partitionBy("grp").orderBy("seq")
    steps = profile.select("grp", "seq", F.col("x").alias("ax"), F.col("y").alias("ay"))
    edges = steps.withColumns({"bx": F.lead("ax").over(w), "by": F.lead("ay").over(w)}).where("bx IS NOT NULL")
    edges = edges.select(F.concat_ws("-", "grp", "seq").alias("edge_id"), "ax", "ay", "bx", "by")
    return S.edge_exposure(edges, diamonds(zones), 50.0).where("inside > 1e-9")


SITES = "SELECT s_suppkey AS site, CAST((s_suppkey * 211) % 977 AS DOUBLE) AS x, CAST(s_suppkey % 90 AS DOUBLE) AS y, CAST((s_suppkey * 17) % 180 AS DOUBLE) AS heading FROM {supplier}"


@query(
    "J19_site_route_context",
    """WITH d AS (SELECT site, grp AS route, sqrt(power(p.x - a.x, 2) + power(p.y - a.y, 2)) AS off, s, abs(((s % 180) - heading + 90) - 180 * floor(((s % 180) - heading + 90) / 180) - 90) AS mismatch FROM profile p, sites a)
    SELECT site, route, off AS "offset", s, mismatch, off <= 30 AS near FROM (SELECT *, row_number() OVER (PARTITION BY site, route ORDER BY off, s, mismatch) AS i FROM d) WHERE i = 1""",
    profile=PROFILE, sites=SITES,
)
def _(t, profile, sites):
    return J.site_route_context(sites, profile.select(F.col("grp").alias("route"), "s", "x", "y", (F.col("s") % 180).alias("heading")), 30.0)


@query(
    "J20_assets_for_tiles",
    """WITH a AS (SELECT regexp_extract(p_name || '-' || p_size || '-' || p_partkey, '-([0-9]+)-', 1) AS tile, p_name || '-' || p_size || '-' || p_partkey AS name FROM part WHERE p_name LIKE 'small%' OR p_name LIKE 'red%')
    SELECT t.tile, min(a.name) AS name FROM (SELECT DISTINCT CAST(p_size AS VARCHAR) AS tile FROM part) t LEFT JOIN a ON a.tile = t.tile GROUP BY t.tile""",
)
def _(t):
    parts = t("part")
    assets = parts.select(F.concat_ws("-", "p_name", F.col("p_size").cast("string"), F.col("p_partkey").cast("string")).alias("name"))
    return J.assets_for_tiles(assets, parts.select(F.col("p_size").cast("string").alias("tile")), r"-([0-9]+)-", ["small", "red"], missing="null")
