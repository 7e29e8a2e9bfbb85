"""Queries of the scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from calado.functions import geometry as G
from calado.functions import text as X
from calado.plans._query import query
from calado.plans.gate import _FOLD
from calado.plans.sequence import OPTIONS, PROFILE

_SPELLED = "replace(replace(text, 'ß', 'ss'), 'ﬁ', 'fi')"


@query(
    "F01_fold",
    f"SELECT doc_id, strip_accents(lower({_SPELLED})) AS folded, trim(regexp_replace(strip_accents(lower({_SPELLED})), '[-–—_\\s]+', ' ', 'g')) AS label FROM marked",
    marked="SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' – ﬁn_de' ELSE ' Straße—x' END AS text FROM {documents}",
)
def _(t, marked):
    return marked.select("doc_id", X.fold(F.col("text")).alias("folded"), X.norm_label(F.col("text")).alias("label"))


RAW = """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN '-' WHEN 1 THEN concat(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(9)), ',5') WHEN 2 THEN concat(CAST(l_linenumber AS VARCHAR(9)), '.', lpad(CAST(l_suppkey % 1000 AS VARCHAR(9)), 3, '0'))
  WHEN 3 THEN concat(CAST(l_linenumber AS VARCHAR(9)), '.', lpad(CAST(l_suppkey % 1000 AS VARCHAR(9)), 3, '0'), ',25') WHEN 4 THEN 'n/a' WHEN 5 THEN concat(CAST(l_linenumber AS VARCHAR(9)), ',', lpad(CAST(l_suppkey % 1000 AS VARCHAR(9)), 3, '0'), '.75') ELSE CAST(l_partkey AS VARCHAR(9)) END AS raw, l_quantity, l_suppkey, l_partkey FROM {lineitem}"""


@query(
    "F02_parse_num",
    """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN NULL WHEN 1 THEN l_quantity + 0.5 WHEN 2 THEN l_linenumber + (l_suppkey % 1000) / 1000 WHEN 3 THEN l_linenumber * 1000 + l_suppkey % 1000 + 0.25 WHEN 4 THEN NULL WHEN 5 THEN l_linenumber * 1000 + l_suppkey % 1000 + 0.75 ELSE CAST(l_partkey AS DOUBLE) END AS value FROM raw_values""",
    raw_values=RAW,
)
def _(t, raw):
    return raw.select("l_orderkey", "l_linenumber", X.parse_num(F.col("raw")).alias("value"))


@query("F03_num_tokens", r"SELECT doc_id, array_to_string(regexp_extract_all(text, '([+-]?[0-9]+(?:[.,][0-9]+)*)', 1), '|') AS numbers, array_to_string(regexp_extract_all(lower(text), '[0-9]\s?(%|€|eur|km|kg|mw|min|m|t)(?:[^a-z]|$)', 1), '|') AS units FROM documents")
def _(t):
    return t("documents").select("doc_id", F.array_join(X.num_tokens(F.col("text")), "|").alias("numbers"), F.array_join(X.unit_tokens(F.col("text")), "|").alias("units"))


@query(
    "F04_parse_period",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 3) THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q' || quarter(o_orderdate) WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m') ELSE CAST(year(o_orderdate) AS VARCHAR) END AS period,
    CASE WHEN o_orderkey % 3 = 0 THEN 'Q' || quarter(o_orderdate) WHEN o_orderkey % 6 = 5 THEN 'UNRESOLVED' ELSE 'ANNUAL' END AS scope FROM orders""",
)
def _(t):
    o = F.col("o_orderdate")
    k, year = F.col("o_orderkey"), F.date_format(o, "yyyy")
    label = F.when(k % 6 == 0, F.concat(year, F.lit(" T"), F.quarter(o))).when(k % 6 == 3, F.concat(F.quarter(o), F.lit("º Trimestre de "), year))
    label = label.when(k % 6 == 2, F.concat(F.lit("Port "), F.quarter(o), F.lit(" "), year)).when(k % 6 == 5, F.concat(F.lit("trimestre "), year))
    label = label.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("file-"), F.date_format(o, "yyyy-MM"), F.lit(".csv"))).otherwise(F.concat(F.lit("year "), F.date_format(o, "yyyy")))
    return t("orders").select("o_orderkey", X.parse_period(label).alias("period"), X.edition_scope(label).alias("scope"))


@query("F05_names", "SELECT p_partkey, p_size % 2 = 0 AS road, replace(p_name, ' ', '_') || '_' || p_partkey AS safe, '/' || replace(replace(p_brand || '/~x', '~', '~0'), '/', '~1') || '/' || p_partkey AS pointer FROM part")
def _(t):
    code = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("a "), F.col("p_size"))).otherwise(F.concat(F.lit("x"), F.col("p_size")))
    return t("part").select(
        "p_partkey", X.is_road_code(code).alias("road"), X.safe_name(F.concat(F.lit("."), F.col("p_name"), F.lit(" / "), F.col("p_partkey"), F.lit("__"))).alias("safe"),
        X.json_pointer(F.concat(F.col("p_brand"), F.lit("/~x")), F.col("p_partkey").cast("string")).alias("pointer"),
    )


@query("F06_scalarish", "SELECT event_id, json_extract_string(props, '$.k') AS k, 'object' AS type, length(props) AS bytes, sha256(props) AS digest, array_to_string(json_keys(props), '|') AS keys FROM events")
def _(t):
    v = F.parse_json("props")
    rows = t("events").select("event_id", X.scalarish(F.variant_get(v, "$.k", "int")).alias("k"), X.compact(F.col("props")).alias("c"))
    return rows.select("event_id", "k", "c.type", "c.bytes", F.col("c.sha256").alias("digest"), "c.keys")


@query(
    "F07_typed_cell",
    """SELECT l_orderkey, l_linenumber, CASE c WHEN 0 THEN 'blank' WHEN 1 THEN 'text' WHEN 2 THEN 'number' WHEN 3 THEN 'date' WHEN 4 THEN 'boolean' ELSE 'error' END AS type, CASE c WHEN 0 THEN NULL WHEN 3 THEN strftime(DATE '1899-12-30' + CAST(r AS INTEGER), '%Y-%m-%d') WHEN 4 THEN CASE WHEN r = '1' THEN 'true' ELSE 'false' END ELSE r END AS value
    FROM (SELECT *, l_linenumber % 6 AS c, CASE WHEN l_linenumber % 6 = 4 THEN CAST(l_partkey % 2 AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) END AS r FROM lineitem)""",
)
def _(t):
    code = F.col("l_linenumber") % 6
    raw = F.when(code == 4, F.col("l_partkey") % 2).otherwise(F.col("l_partkey")).cast("string")
    return t("lineitem").select("l_orderkey", "l_linenumber", X.typed_cell(raw, code).alias("c")).select("l_orderkey", "l_linenumber", "c.type", "c.value")


@query(
    "F08_match_member",
    """WITH a AS (SELECT n_regionkey AS r, list(n_name ORDER BY n_name) AS allowed FROM nation GROUP BY 1) SELECT c_custkey, CASE WHEN list_contains(allowed, n_name) THEN n_name WHEN len(list_filter(allowed, lambda x: contains(x, '_1'))) = 1 THEN list_filter(allowed, lambda x: contains(x, '_1'))[1] ELSE 'filter_ignored' END AS member FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN a ON a.r = c_custkey % 5""",
)
def _(t):
    """A returned code that is allowed, else the only allowed label that overlaps, else the filter was ignored."""
    allowed = t("nation").groupBy(F.col("n_regionkey").alias("r")).agg(F.array_sort(F.collect_list("n_name")).alias("allowed"))
    rows = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(allowed, F.col("r") == F.col("c_custkey") % 5)
    return rows.select("c_custkey", X.match_member(F.col("n_name"), F.col("allowed"), F.lit("_1")).alias("member"))


@query("F09_axis_diff", "SELECT option_id, abs((d + 90) - 180 * floor((d + 90) / 180) - 90) AS diff FROM (SELECT option_id, residents - length_km AS d FROM options)", options=OPTIONS)
def _(t, options):
    return options.select("option_id", G.axis_diff(F.col("residents"), F.col("length_km")).alias("diff"))


@query("F10_bearing", "SELECT option_id, d - 360 * floor(d / 360) AS bearing FROM (SELECT option_id, degrees(atan2(residents - 500, length_km - 200)) AS d FROM options)", options=OPTIONS)
def _(t, options):
    return options.select("option_id", G.bearing(F.col("residents") - 500, F.col("length_km") - 200).alias("bearing"))


@query(
    "F10_chord_bearing",
    """SELECT grp, seq, CASE WHEN dx <> 0 OR dy <> 0 THEN d - 360 * floor(d / 360) END AS bearing FROM (SELECT *, degrees(atan2(dx, dy)) AS d FROM (SELECT grp, seq, last_value(x) OVER w - first_value(x) OVER w AS dx, last_value(y) OVER w - first_value(y) OVER w AS dy FROM profile
    WINDOW w AS (PARTITION BY grp ORDER BY s RANGE BETWEEN 75 PRECEDING AND 75 FOLLOWING)))""",
    profile=PROFILE,
)
def _(t, profile):
    return profile.select("grp", "seq", G.chord_bearing(F.col("s"), F.col("x"), F.col("y"), ["grp"], 75.0).alias("bearing"))


@query("F11_stop_penalty", "SELECT option_id, (speed * 2.0) / 1.0 + (speed * 2.0) / 1.0 + 120 AS seconds FROM options", options=OPTIONS)
def _(t, options):
    return options.select("option_id", G.stop_penalty(F.col("speed") * 2.0).alias("seconds"))


@query("F12_grade_force", "SELECT option_id, residents * 9.80665 * 12.5 / 1000 AS force_kn, residents * 9.80665 * 12.5 / 1000 * speed AS power_kw FROM options", options=OPTIONS)
def _(t, options):
    force, power = G.grade_force(F.col("residents"), F.lit(12.5), F.col("speed"))
    return options.select("option_id", force.alias("force_kn"), power.alias("power_kw"))


@query("F13_tangent_fit", "SELECT option_id, r * d AS arc_m, r * tan(d / 2) AS tangent_m, 2 * (r * tan(d / 2)) - r * d AS dogleg_m, r * tan(d / 2) <= minutes AND r * tan(d / 2) <= residents * 10 AS fits FROM (SELECT *, 500.0 + length_km AS r, radians(speed) AS d FROM options)", options=OPTIONS)
def _(t, options):
    fit = G.tangent_fit(500.0 + F.col("length_km"), F.radians("speed"), F.col("minutes"), F.col("residents") * 10)
    return options.select("option_id", *[c.alias(n) for n, c in fit.items()])


@query("F14_quadrant", "SELECT option_id, sqrt(dx * dx + dy * dy) AS km, CASE WHEN dy >= 0 THEN 'N' ELSE 'S' END || CASE WHEN dx >= 0 THEN 'E' ELSE 'W' END AS quadrant FROM (SELECT option_id, (residents / 500 - 1) * cos(radians(41.0)) * 111.32 AS dx, (length_km / 200 - 1) * 110.574 AS dy FROM options)", options=OPTIONS)
def _(t, options):
    km, name = G.quadrant(F.col("residents") / 500 - 8.0, F.col("length_km") / 200 + 40.0, F.lit(-7.0), F.lit(41.0))
    return options.select("option_id", km.alias("km"), name.alias("quadrant"))


@query("F15_snap", "SELECT option_id, floor(minutes / 50) * 50 + 25 AS snapped, CAST(CAST(floor(minutes / 1000) + 200 AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(residents * 9 / 1000) + 301 AS BIGINT) AS VARCHAR) AS tile, floor(minutes / 1000) * 1000.0 AS xmin FROM options", options=OPTIONS)
def _(t, options):
    tile = G.tile_of(F.col("minutes"), F.col("residents") * 9)
    return options.select("option_id", G.snap(F.col("minutes"), 50.0).alias("snapped"), tile.alias("tile"), G.tile_bounds(tile)[0].alias("xmin"))


@query("F16_length", "SELECT option_id, sqrt(minutes * minutes + residents * residents) AS length FROM options", options=OPTIONS)
def _(t, options):
    """Connectors whose tangents lie along the chord are straight."""
    zero, end = (F.lit(0.0), F.lit(0.0)), (F.col("minutes"), F.col("residents"))
    # Much work a row: small files are spread first.
    spread = options.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.select("option_id", G.quintic_length(zero, end, end, end).alias("length"))


@query("F16_quintic")
def _(t):
    x, y, k = G.quintic((F.lit(0.0), F.lit(0.0)), (F.col("minutes"), F.col("residents")), (F.lit(300.0), F.lit(0.0)), (F.lit(0.0), F.lit(300.0)), F.col("t"))
    return t.sql(OPTIONS).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(10)))).withColumn("t", F.col("i") / 10).select("option_id", "i", x.alias("x"), y.alias("y"), k.alias("curvature"))


def _tm_sql(code: int) -> str:
    a, f = G.ELLIPSOID
    k0, lon0, lat0, x0, _ = G.SYSTEMS[code]
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    al = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    east = "eta + " + " + ".join(f"{al[j]!r} * cos({2 * (j + 1)} * xi) * sinh({2 * (j + 1)} * eta)" for j in range(3))
    return f"""WITH p AS (SELECT option_id, sin(radians(lat)) AS s, radians(lon - ({lon0!r})) AS d FROM (SELECT option_id, residents / 1009 * 3 - 9 AS lon, 37 + length_km / 457 * 5 AS lat FROM options)),
    q AS (SELECT option_id, d, sinh(atanh(s) - {e!r} * atanh({e!r} * s)) AS t FROM p), r AS (SELECT option_id, atan2(t, cos(d)) AS xi, atanh(sin(d) / sqrt(1 + t * t)) AS eta FROM q)
    SELECT option_id, {x0!r} + {k0!r} * {radius!r} * ({east}) AS x FROM r"""


@query("F17_to_tm", _tm_sql(3763), options=OPTIONS)
def _(t, options):
    x, _ = G.to_tm(F.col("residents") / 1009 * 3 - 9, 37 + F.col("length_km") / 457 * 5, 3763)
    return options.select("option_id", x.alias("x"))


@query("F17_from_tm", "SELECT option_id, residents / 1009 * 3 - 9 AS lon, 37 + length_km / 457 * 5 AS lat FROM options", options=OPTIONS)
def _(t, options):
    """There and back."""
    x, y = G.to_tm(F.col("residents") / 1009 * 3 - 9, 37 + F.col("length_km") / 457 * 5, 25830)
    lon, lat = G.from_tm(F.col("_x"), F.col("_y"), 25830)
    return options.withColumns({"_x": x, "_y": y}).select("option_id", lon.alias("lon"), lat.alias("lat"))


@query("F18_canon_hash", "SELECT o_orderkey, sha256(o_orderkey || chr(31) || o_orderstatus || chr(31) || o_orderpriority) AS digest FROM orders")
def _(t):
    return t("orders").select("o_orderkey", X.canon_hash(F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")).alias("digest"))


@query("F19_first_label", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_brand ELSE '(unknown)' END AS label FROM part")
def _(t):
    size = F.col("p_size") % 3
    m = F.create_map(F.lit("name"), F.when(size == 0, F.col("p_name")).otherwise(" "), F.lit("code"), F.when(size < 2, F.col("p_brand")), F.lit("other"), F.col("p_type"))
    return t("part").select("p_partkey", X.first_label(m, ["designation", "name"], ["code"]).alias("label"))
