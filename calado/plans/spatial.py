"""Queries of the spatial operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import spatial as S
from calado.plans._query import query
from calado.plans.aggregate import CELLS, CIRCLE, POINTS
from calado.plans.join import SITES, ZONES, diamonds, within_diamonds
from calado.plans.sequence import PROFILE, RECTS

# Orders of a customer as a line: points in order of key.
LINES = "SELECT o_custkey % 20 AS line, o_orderkey AS seq, CAST((o_orderkey * 13) % 500 AS DOUBLE) AS x, CAST((o_orderkey * 29) % 400 AS DOUBLE) AS y FROM {orders}"
# The same along x, so that lines get longer, not denser, as orders grow; and customers as points along them.
LONG = "SELECT o_custkey % 20 AS line, o_orderkey AS seq, CAST(o_orderkey * 5 + (o_orderkey * 13) % 50 AS DOUBLE) AS x, CAST((o_orderkey * 29) % 400 AS DOUBLE) AS y FROM {orders}"
ALONG = "SELECT c_custkey AS id, CAST(c_custkey * 50 + (c_custkey * 7) % 50 AS DOUBLE) AS x, CAST((c_custkey * 61) % 400 AS DOUBLE) AS y FROM {customer}"
_SEG = "seg AS (SELECT line, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM lines WINDOW w AS (PARTITION BY line ORDER BY seq)), segs AS (SELECT *, sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) AS length, coalesce(sum(sqrt(power(bx - ax, 2) + power(by_ - ay, 2))) OVER (PARTITION BY line ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0 FROM seg WHERE bx IS NOT NULL)"


@query(
    "G01_locate",
    f"""WITH {_SEG}, d AS (SELECT id, line, s0, length, x, y, ax, ay, bx, by_, CASE WHEN length > 0 THEN least(1.0, greatest(0.0, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)))) ELSE 0 END AS t FROM points, segs),
    e AS (SELECT *, sqrt(power(x - ax - t * (bx - ax), 2) + power(y - ay - t * (by_ - ay), 2)) AS off FROM d)
    SELECT id, line, off AS "offset" FROM (SELECT *, row_number() OVER (PARTITION BY id, line ORDER BY off) AS i FROM e WHERE off <= 20) WHERE i = 1""",
    lines=LONG, points=ALONG,
)
def _(t, lines, points):
    return S.locate(points, S.segments(lines, ["line"], "seq"), "id", "line", 20.0).select("id", "line", "offset")


@query(
    "G02_at_chainage",
    f"""WITH {_SEG}, w AS (SELECT DISTINCT line, (line * 7 + k) * 100.0 AS s FROM lines, (VALUES (1), (2), (3)) v(k))
    SELECT w.line, w.s, ax + (s - s0) / length * (bx - ax) AS x, ay + (s - s0) / length * (by_ - ay) AS y FROM w LEFT JOIN segs g ON g.line = w.line AND w.s >= s0 AND w.s < s0 + length""",
    lines=LONG,
)
def _(t, lines):
    wanted = lines.select("line").distinct().withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).select("line", ((F.col("line") * 7 + F.col("k")) * 100.0).alias("s"))
    return S.at_chainage(wanted, S.segments(lines, ["line"], "seq"), "line")


@query("G03_strip_grid", "SELECT site, a AS along, c AS across, x + a * sin(radians(heading)) + c * cos(radians(heading)) AS px, y + a * cos(radians(heading)) - c * sin(radians(heading)) AS py FROM sites, (VALUES (-100.0), (0.0), (100.0)) l(a), (VALUES (-25.0), (25.0)) r(c)", sites=SITES)
def _(t, sites):
    return S.strip_grid(sites, [-100.0, 0.0, 100.0], [-25.0, 25.0]).select("site", "along", "across", "px", "py")


# Squared distances from a box's corner to a segment, and from a segment's end to a box; whether a segment enters the box.
_CORNER = "(SELECT min(power({x} - ax - u * (bx - ax), 2) + power({y} - ay - u * (by_ - ay), 2)) FROM (SELECT greatest(0, least(1, (({x} - ax) * (bx - ax) + ({y} - ay) * (by_ - ay)) / nullif(length * length, 0))) AS u))"
_END = "power(greatest(x0 - {x}, {x} - x0 - 50, 0), 2) + power(greatest(y0 - {y}, {y} - y0 - 50, 0), 2)"


@query(
    "G04_band_tiles",
    "WITH " + _SEG + f""", near AS (SELECT s.*, tx, ty, tx * 50.0 AS x0, ty * 50.0 AS y0 FROM segs s, LATERAL (SELECT unnest(range(CAST(floor((least(ax, bx) - 15) / 50) AS BIGINT) - 1, CAST(floor((greatest(ax, bx) + 15) / 50) AS BIGINT) + 1)) AS tx), range(-2, 10) AS r(ty)),
    d AS (SELECT line, tx, ty, least({_END.format(x="ax", y="ay")}, {_END.format(x="bx", y="by_")}) AS e, least({", ".join(_CORNER.format(x=x, y=y) for x in ("x0", "x0 + 50") for y in ("y0", "y0 + 50"))}) AS c,
      greatest(0, CASE WHEN bx <> ax THEN least((x0 - ax) / (bx - ax), (x0 + 50 - ax) / (bx - ax)) WHEN ax BETWEEN x0 AND x0 + 50 THEN 0 ELSE 2 END, CASE WHEN by_ <> ay THEN least((y0 - ay) / (by_ - ay), (y0 + 50 - ay) / (by_ - ay)) WHEN ay BETWEEN y0 AND y0 + 50 THEN 0 ELSE 2 END) AS t0,
      least(1, CASE WHEN bx <> ax THEN greatest((x0 - ax) / (bx - ax), (x0 + 50 - ax) / (bx - ax)) END, CASE WHEN by_ <> ay THEN greatest((y0 - ay) / (by_ - ay), (y0 + 50 - ay) / (by_ - ay)) END) AS t1 FROM near)
    SELECT DISTINCT line, tx, ty FROM d WHERE t0 <= t1 OR sqrt(least(e, c)) <= 15""",
    lines=LONG,
)
def _(t, lines):
    return S.band_tiles(S.segments(lines, ["line"], "seq"), "line", 15.0, 50.0)


# Area of a diamond of radius R where x is at least a, above its middle.
_HALF = "(CASE WHEN {R} <= 0 OR {a} >= {R} THEN 0 WHEN {a} >= 0 THEN power({R} - {a}, 2) / 2 WHEN {a} >= -({R}) THEN power({R}, 2) - power({R} + {a}, 2) / 2 ELSE power({R}, 2) END)"


@query(
    "G05_clip_area",
    f"""WITH c AS (SELECT zone, r, greatest(200 - x, x - 800) AS a, greatest(200 - y, y - 800) AS b FROM zones)
    SELECT zone AS polygon_id, v AS area, v / (2 * r * r) AS share FROM (SELECT zone, r, CASE WHEN b >= 0 THEN {_HALF.format(R="r - b", a="a")} ELSE 2 * {_HALF.format(R="r", a="a")} - {_HALF.format(R="r + b", a="a")} END AS v FROM c)""",
    zones=ZONES,
)
def _(t, zones):
    rings = diamonds(zones).withColumn("k", F.lit(1))
    square = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((200.0, 200.0), (800.0, 200.0), (800.0, 800.0), (200.0, 800.0))])
    return S.clip_area(rings.select("polygon_id", "ring", square.alias("zone")), ["polygon_id"])


@query(
    "G06_overlap_length",
    "WITH " + _SEG + ", " + within_diamonds("(SELECT concat_ws('-', line, seq) AS edge_id, ax, ay, bx, by_ FROM segs)") + " SELECT CAST(split_part(edge_id, '-', 1) AS BIGINT) AS line, sum(inside) AS inside FROM exposure GROUP BY 1",
    lines=LONG, zones=ZONES,
)
def _(t, lines, zones):
    segs = S.segments(lines, ["line"], "seq").select(F.col("line"), F.concat_ws("-", F.col("line"), F.round("s0", 3)).alias("edge_id"), "ax", "ay", "bx", "by")
    inside = S.edge_exposure(segs.drop("line"), diamonds(zones), 50.0)
    return inside.join(segs.select("edge_id", "line"), "edge_id").groupBy("line").agg(F.sum("inside").alias("inside"))


@query("G07_mosaic", "SELECT row, col, z FROM cells", cells=CELLS)
def _(t, cells):
    tiles = cells.select(F.floor(F.col("row") / 10).alias("tile_row"), F.floor(F.col("col") / 10).alias("tile_col"), (F.col("row") % 10).alias("row"), (F.col("col") % 10).alias("col"), "z")
    return S.mosaic(tiles, 10)


@query(
    "G08_cross_section",
    """WITH p AS (SELECT site, a, c, CAST(floor((y + a * cos(radians(heading)) - c * sin(radians(heading))) / 20) AS BIGINT) AS row, CAST(floor((x + a * sin(radians(heading)) + c * cos(radians(heading))) / 20) AS BIGINT) AS col FROM sites, (VALUES (-100.0), (-40.0), (0.0), (40.0), (100.0)) l(a), (VALUES (-125.0), (0.0), (125.0)) r(c)),
    v AS (SELECT site, a, max(CASE WHEN c = 0 THEN z END) AS m, max(CASE WHEN c < 0 THEN z END) AS l, max(CASE WHEN c > 0 THEN z END) AS r FROM p LEFT JOIN cells USING (row, col) GROUP BY site, a)
    SELECT site, max(CASE WHEN l IS NULL AND r IS NULL THEN NULL ELSE greatest(abs(l - m), abs(r - m)) END) AS max_lateral, max(CASE WHEN a = 100 THEN m END) - max(CASE WHEN a = -100 THEN m END) AS end_change, quantile_cont(m, 0.9) - quantile_cont(m, 0.1) AS spread, count(m) AS samples FROM v GROUP BY site""",
    sites=SITES, cells=CELLS,
)
def _(t, sites, cells):
    return S.cross_section(sites, cells, [-100.0, -40.0, 0.0, 40.0, 100.0], 125.0, 20.0)


REACH = "SELECT s AS site, level, cell FROM (SELECT l_suppkey % 20 AS s, CAST(l_linenumber AS BIGINT) AS level, l_partkey % 200 AS cell FROM {lineitem})"


@query(
    "G09_check_nesting",
    """WITH z AS (SELECT DISTINCT * FROM zones), n AS (SELECT site, level, lead(level) OVER (PARTITION BY site ORDER BY level) AS nxt FROM (SELECT DISTINCT site, level FROM z)),
    m AS (SELECT a.site, a.level, b.cell IS NULL AS miss FROM z a JOIN n ON n.site = a.site AND n.level = a.level LEFT JOIN z b ON b.site = a.site AND b.level = n.nxt AND b.cell = a.cell WHERE n.nxt IS NOT NULL)
    SELECT site, level, count(*) AS cells, count(*) FILTER (miss) AS outside, count(*) FILTER (miss) / count(*) AS share, count(*) FILTER (miss) / count(*) <= 0.015 AS nested FROM m GROUP BY site, level""",
    zones=REACH,
)
def _(t, zones):
    return S.check_nesting(zones, "site", "level", ["cell"])


@query(
    "G09_contour_nesting",
    """WITH c AS (SELECT zone, unnest([15, 30, 45]) AS level, x, y FROM zones), l AS (SELECT *, CASE WHEN level = 30 THEN zone % 9 * 3 ELSE 0 END AS dx, CASE WHEN level = 45 THEN zone % 4 * 4 ELSE 0 END AS dy FROM c),
    n AS (SELECT *, lead(level) OVER w AS r2, lead(dx) OVER w - dx AS mx, lead(dy) OVER w - dy AS my FROM l WINDOW w AS (PARTITION BY zone ORDER BY level)),
    o AS (SELECT zone, level, 2.0 * level * level AS area, 0.5 * greatest(0, least(level, mx + my + r2) - greatest(-level, mx + my - r2)) * greatest(0, least(level, mx - my + r2) - greatest(-level, mx - my - r2)) AS held FROM n WHERE r2 IS NOT NULL)
    SELECT zone, level, area, greatest(1 - held / area, 0) AS outside, greatest(1 - held / area, 0) <= 0.015 AS nested FROM o""",
    zones=CIRCLE,
)
def _(t, zones):
    rows = zones.withColumn("level", F.explode(F.array(*[F.lit(n) for n in (15, 30, 45)])))
    x, y = F.col("x") + F.when(F.col("level") == 30, F.col("zone") % 9 * 3).otherwise(0), F.col("y") + F.when(F.col("level") == 45, F.col("zone") % 4 * 4).otherwise(0)
    ring = F.array(*[F.struct((x + dx * F.col("level")).alias("x"), (y + dy * F.col("level")).alias("y")) for dx, dy in ((1, 0), (0, 1), (-1, 0), (0, -1))])
    return S.contour_nesting(rows.withColumn("rings", F.array(ring)), "zone", "level")


@query("G10_footprint_cover", "SELECT id, coalesce(bool_or(x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax), false) AS covered FROM points LEFT JOIN rects ON x - 25 <= xmax AND x + 25 >= xmin AND y - 25 <= ymax AND y + 25 >= ymin GROUP BY id", points=POINTS, rects=RECTS)
def _(t, points, rects):
    return S.footprint_cover(points, rects, 25.0, 50.0).select("id", "covered")


@query(
    "G10_nearest_footprint",
    """SELECT id, min(sqrt(power(greatest(xmin - x, x - xmax, 0), 2) + power(greatest(ymin - y, y - ymax, 0), 2))) AS distance FROM points, rects GROUP BY id""",
    points=POINTS, rects=RECTS,
)
def _(t, points, rects):
    return S.nearest_footprint(points, rects.withColumnRenamed("tile_id", "rect"), 50.0).select("id", "distance")


@query("G11_share_samples", "SELECT id, min(id) OVER (PARTITION BY floor(x / 12), floor(y / 12)) AS sample FROM points", points=POINTS)
def _(t, points):
    return S.share_samples(points, "id", 12.0)


@query(
    "G02_sub_lines",
    f"""WITH {_SEG}, w AS (SELECT DISTINCT line, line * 300.0 + 50 AS lo, line * 300.0 + 2050 AS hi FROM lines), p AS (SELECT line, least(hi, s0 + length) - greatest(lo, s0) AS part FROM segs JOIN w USING (line) WHERE length > 0 AND s0 < hi AND s0 + length > lo)
    SELECT line, count(*) AS parts, sum(part) AS length FROM p GROUP BY line""",
    lines=LONG,
)
def _(t, lines):
    wanted = lines.select("line", (F.col("line") * 300.0 + 50).alias("lo"), (F.col("line") * 300.0 + 2050).alias("hi")).distinct()
    parts = S.sub_lines(wanted, S.segments(lines, ["line"], "seq"), "line")
    return parts.groupBy("line").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("length"))


@query("G12_uncertain_tiles", "SELECT tx, ty, abs((tx + 0.5) * 10 - 5000) < 1500 AS uncertain FROM (SELECT DISTINCT CAST(floor(x / 10) AS BIGINT) AS tx, CAST(floor(y / 10) AS BIGINT) AS ty FROM points)", points=ALONG)
def _(t, points):
    """Tiles of points along a corridor that two countries share at x = 5,000; their other borders are far away."""
    tiles = points.select(F.floor(F.col("x") / 10).alias("tx"), F.floor(F.col("y") / 10).alias("ty")).distinct()
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    sides = [("west", -1e4, 5e3), ("east", 5e3, 1e9)]
    made = F.explode(F.array(*[F.struct(F.lit(n).alias("country"), F.array(corner(a, -1e4), corner(b, -1e4), corner(b, 1e4), corner(a, 1e4)).alias("ring")) for n, a, b in sides]))
    return S.uncertain_tiles(tiles, t("region").limit(1).select(made.alias("c")).select("c.*"), 10.0, 1500.0)


@query(
    "G12_country_split",
    """WITH s AS (SELECT grp, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM profile WINDOW w AS (PARTITION BY grp ORDER BY seq)), l AS (SELECT grp, sqrt(power(bx - ax, 2) + power(by_ - ay, 2)) AS len, CASE WHEN ax = bx THEN CASE WHEN ax < 500 THEN 1.0 ELSE 0.0 END ELSE least(1.0, greatest(0.0, (500 - least(ax, bx)) / abs(bx - ax))) END AS west FROM s WHERE bx IS NOT NULL)
    SELECT grp, 'west' AS country, sum(len * west) AS length_in FROM l WHERE west > 0 GROUP BY grp UNION ALL SELECT grp, 'east', sum(len * (1 - west)) FROM l WHERE west < 1 GROUP BY grp""",
    profile=PROFILE,
)
def _(t, profile):
    segs = S.segments(profile.select("grp", "seq", "x", "y"), ["grp"], "seq")
    edges = segs.select("grp", F.concat_ws("-", F.col("grp"), F.round("s0", 3)).alias("edge_id"), "ax", "ay", "bx", "by")
    corner = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    sides = [("west", -1000.0, 500.0), ("east", 500.0, 2000.0)]
    made = F.explode(F.array(*[F.struct(F.lit(n).alias("country"), F.lit(i).alias("polygon_id"), F.array(corner(a, -1e5), corner(b, -1e5), corner(b, 1e5), corner(a, 1e5)).alias("ring")) for i, (n, a, b) in enumerate(sides)]))
    countries = edges.limit(1).select(made.alias("c")).select("c.*")
    return S.country_split(edges, "grp", countries, 2e5)
