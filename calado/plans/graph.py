"""Queries of the graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import graph as R
from calado.plans._query import query
from calado.plans.aggregate import STEPS

_GROUND = "CASE WHEN p_partkey % 17 <> 5 THEN CAST((p_partkey * 37) % 101 AS DOUBLE) / 20 END AS z, CAST(p_size AS DOUBLE) / 25 AS relief FROM {part}"
# All parts on one lattice as wide as it is high, without ground at some.
LATTICE = "SELECT p_partkey % w AS x, CAST(floor(p_partkey / w) AS BIGINT) AS y, " + _GROUND + " CROSS JOIN (SELECT CAST(ceil(sqrt(count(*))) AS BIGINT) AS w FROM {part}) g"
# All parts on islands of 10 x 10 cells, apart by 10 cells.
ISLANDS = "SELECT CAST(floor(p_partkey / 100) AS BIGINT) * 20 + p_partkey % 10 AS x, CAST(floor(p_partkey / 10) AS BIGINT) % 10 AS y, " + _GROUND


@query(
    "R01_lattice",
    """SELECT CAST(a.x AS VARCHAR) || ',' || CAST(a.y AS VARCHAR) AS a, CAST(b.x AS VARCHAR) || ',' || CAST(b.y AS VARCHAR) AS b, sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) + abs(a.z - b.z) AS cost
    FROM cells a JOIN cells b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) WHERE a.z IS NOT NULL AND b.z IS NOT NULL""",
    cells=LATTICE,
)
def _(t, cells):
    return R.lattice(cells, "terrain")


_FOUR = "(SELECT 0 AS i UNION ALL SELECT 1) i CROSS JOIN (SELECT 0 AS j UNION ALL SELECT 1) j"
# Four tiles a cell, some of which are not there.
TILES = f"SELECT 2 * x + i AS tx, 2 * y + j AS ty, concat('t', 2 * x + i, '-', 2 * y + j) AS tile_id FROM ({LATTICE}) c CROSS JOIN {_FOUR} WHERE (7 * x + 3 * y + 2 * i + j) % 23 <> 0"
ROADS = f"SELECT *, CASE WHEN (x + 2 * y) % 5 <> 0 THEN (x * 613 + y * 331) % 7919 END AS road FROM ({LATTICE}) c"


@query(
    "R01_lattice_nodes",
    """SELECT c.x, c.y, string_agg(tile_id, ' ' ORDER BY ty, tx) AS tile_ids FROM cells c JOIN tiles t ON t.tx // 2 = c.x AND t.ty // 2 = c.y GROUP BY c.x, c.y HAVING count(*) = 4""",
    cells=LATTICE,
    tiles=TILES,
)
def _(t, cells, tiles):
    return R.lattice_nodes(cells, tiles).select("x", "y", F.array_join("tile_ids", " ").alias("tile_ids"))


_ENTRY = """SELECT CAST(a.x AS VARCHAR) || ',' || CAST(a.y AS VARCHAR) AS a, CAST(b.x AS VARCHAR) || ',' || CAST(b.y AS VARCHAR) AS b, 1 + {relief} * b.relief + {rise} * abs(a.z - b.z){road} AS cost
  FROM cells a JOIN cells b ON abs(a.x - b.x) + abs(a.y - b.y) = 1 WHERE a.z IS NOT NULL AND b.z IS NOT NULL"""


@query("R01_lattice_short", _ENTRY.format(relief=0.0007, rise=0.0002, road=""), cells=LATTICE)
def _(t, cells):
    return R.lattice(cells, "short", R.FOUR)


@query("R01_lattice_road", _ENTRY.format(relief=0.004, rise=0.001, road=" + coalesce(0.0004 * CASE WHEN b.road > 4000 THEN 4000 ELSE b.road END, 0)"), cells=ROADS)
def _(t, cells):
    return R.lattice(cells, "road", R.FOUR)


def _queries(cells):
    """On each island from its first cell with ground to its last one."""
    ground = cells.where("z IS NOT NULL").withColumn("q", F.floor(F.col("x") / 20))
    name = lambda m: F.concat_ws(",", m["x"].cast("string"), m["y"].cast("string"))
    found = ground.groupBy("q").agg(F.min(F.struct("y", "x")).alias("a"), F.max(F.struct("y", "x")).alias("b"))
    return found.select(F.concat(F.lit("q"), "q").alias("q"), name(F.col("a")).alias("start"), name(F.col("b")).alias("end"))


@query(
    "R02_shortest_paths",
    """WITH RECURSIVE e AS (SELECT a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM cells a JOIN cells b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) WHERE a.z IS NOT NULL AND b.z IS NOT NULL),
    r AS (SELECT first(x ORDER BY y, x) AS x, min(y) AS y, 0 AS hops FROM cells WHERE z IS NOT NULL GROUP BY x // 20 UNION SELECT e.bx, e.by_, r.hops + 1 FROM r JOIN e ON e.ax = r.x AND e.ay = r.y WHERE r.hops < 40)
    SELECT CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) AS node, min(hops) AS hops FROM r GROUP BY x, y""",
    cells=ISLANDS,
)
def _(t, cells):
    """Hops from the first cell of every island: all costs 1, until none falls. The SQL's recursion stops at 40, beyond all of 100 cells."""
    edges = R.lattice(cells, "distance").withColumn("cost", F.lit(1.0))
    return R.shortest_paths(R.checkpointed(edges), _queries(cells)).select("node", F.col("cost").cast("int").alias("hops"))


@query(
    "R02_cheapest_paths",
    """WITH RECURSIVE e AS (SELECT a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_, sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) + abs(a.z - b.z) AS c FROM cells a JOIN cells b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) WHERE a.z IS NOT NULL AND b.z IS NOT NULL),
    r(x, y, cost) USING KEY (x, y) AS (SELECT first(x ORDER BY y, x), min(y), CAST(0 AS DOUBLE) FROM cells WHERE z IS NOT NULL GROUP BY x // 20
      UNION SELECT e.bx, e.by_, min(r.cost + e.c) FROM r JOIN e ON e.ax = r.x AND e.ay = r.y LEFT JOIN recurring.r o ON o.x = e.bx AND o.y = e.by_ WHERE o.cost IS NULL OR r.cost + e.c < o.cost - 1e-12 GROUP BY e.bx, e.by_)
    SELECT CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) AS node, round(cost, 6) AS cost, round(cost, 6) AS along FROM r""",
    cells=ISLANDS,
)
def _(t, cells):
    """By length and height step from the first cell of every island; ``along`` sums the edges of the path that each row holds."""
    edges = R.checkpointed(R.lattice(cells, "terrain"))
    found = R.shortest_paths(edges, _queries(cells)).select("node", "cost", F.posexplode("path").alias("i", "a"), F.get("path", F.col("i") + 1).alias("b"))
    priced = found.join(edges.select("a", "b", F.col("cost").alias("_c")), ["a", "b"], "left")
    return priced.groupBy("node", "cost").agg(F.round(F.coalesce(F.sum("_c"), F.lit(0.0)), 6).alias("along")).select("node", F.round("cost", 6).alias("cost"), "along")


@query("R03_alternatives")
def _(t):
    cells = t.sql(ISLANDS)
    modes = {m: R.lattice(cells, m) for m in ("distance", "relief", "balanced")}
    return R.alternatives(modes, _queries(cells)).select("q", "variant", F.array_join("nodes", " ").alias("nodes"), "cost", "jaccard", "far_share")


LEGS = "SELECT DISTINCT concat('o', l_orderkey) AS s, concat('p', l_partkey) AS p, l_linenumber % 3 AS k FROM {lineitem}"
# Every line is a leg of a lattice: from the cell of its order and number to one up to two cells away.
CELL_LEGS = """SELECT DISTINCT l_partkey % 3 AS k, l_orderkey AS x, l_linenumber AS y, l_orderkey + l_suppkey % 5 - 2 AS tx, l_linenumber + CAST(l_quantity AS BIGINT) % 3 - 1 AS ty FROM {lineitem}"""


@query(
    "R04_compose_chains",
    """SELECT a.s || '-' || a.p || '/' || b.p || '-' || b.s || '/' || c.s || '-' || c.p AS chain, 4 AS n_cells
    FROM legs a JOIN legs b ON a.p = b.p JOIN legs c ON b.s = c.s WHERE a.k = 1 AND b.k = 2 AND c.k = 0 AND a.s <> b.s AND b.p <> c.p AND a.p <> c.p""",
    legs=LEGS,
)
def _(t, legs):
    def leg(k, a, b):
        return legs.where(F.col("k") == k).select(F.concat_ws("-", a, b).alias("leg"), F.array(a, b).alias("nodes"))

    return R.compose_chains(leg(1, "s", "p"), leg(2, "p", "s"), leg(0, "s", "p")).select("chain", "n_cells")


@query(
    "R04_lattice_chains",
    """WITH e AS (SELECT *, x || ',' || y AS a, tx || ',' || ty AS b FROM legs WHERE greatest(abs(x - tx), abs(y - ty)) = 1),
    c AS (SELECT e.a AS n1, f.a AS n2, g.a AS n3, g.b AS n4, (e.x % 4 = 0 OR f.x % 4 = 0 OR g.x % 4 = 0 OR g.tx % 4 = 0) AS west FROM e JOIN e f ON e.b = f.a JOIN e g ON f.b = g.a WHERE e.k = 0 AND f.k = 1 AND g.k = 2)
    SELECT n1 || '>' || n2 || '/' || n2 || '>' || n3 || '/' || n3 || '>' || n4 AS chain, n1 || ' ' || n2 || ' ' || n3 || ' ' || n4 AS cells FROM c WHERE west AND n1 <> n3 AND n1 <> n4 AND n2 <> n4""",
    legs=CELL_LEGS,
)
def _(t, legs):
    a, b = R.node_id(F.col("x"), F.col("y")), R.node_id(F.col("tx"), F.col("ty"))
    named = legs.select("k", F.concat_ws(">", a, b).alias("leg"), F.array(a, b).alias("nodes"))
    west = lambda n: F.substring_index(n, ",", 1).cast("long") % 4 == 0
    chains = R.compose_chains(*[named.where(F.col("k") == k).drop("k") for k in range(3)], anchors=(west,), adjacent=True)
    return chains.select("chain", F.array_join("nodes", " ").alias("cells"))


@query(
    "R05_split_modules",
    """WITH n AS (SELECT route, seq, 'c' || x || '.' || y AS node, x % 10 = 0 AS anchor FROM steps), m AS (SELECT route, node, lead(node) OVER w AS nxt, sum(CASE WHEN anchor THEN 1 ELSE 0 END) OVER w AS module FROM n WINDOW w AS (PARTITION BY route ORDER BY seq))
    SELECT route, module, count(*) AS edges, sha256(string_agg(least(node, nxt) || '~' || greatest(node, nxt), '|' ORDER BY least(node, nxt) || '~' || greatest(node, nxt))) AS digest FROM m WHERE nxt IS NOT NULL GROUP BY route, module""",
    steps=STEPS,
)
def _(t, steps):
    rows = steps.withColumn("node", F.concat(F.lit("c"), F.col("x"), F.lit("."), F.col("y")))
    return R.split_modules(rows, "route", "seq", "node", F.col("x") % 10 == 0)
