"""Queries of the window operators (W01 to W15), over events as profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import windows as W
from calado.plans._query import query

# A user's events in order are a profile: every event is 25 m on, and its value the height.
PROFILE = """SELECT user_id AS grp, event_id AS seq, row_number() OVER (PARTITION BY user_id ORDER BY event_id) * 25.0E0 AS s,
  CAST(event_id % 977 AS DOUBLE) AS x, CAST(value AS DOUBLE) AS y, CAST(value AS DOUBLE) AS z, event_type AS kind FROM {events}"""
OPTIONS = """SELECT p_partkey AS option_id, p_brand AS family, p_size AS speed, CAST(p_retailprice AS DOUBLE) AS minutes,
  CAST((p_partkey * 7919) % 1009 AS DOUBLE) AS residents, CAST((p_partkey * 31) % 457 AS DOUBLE) AS length_km FROM {part}"""


@query("W01_chainage", "SELECT grp, seq, sum(step) OVER (PARTITION BY grp ORDER BY seq) AS s FROM (SELECT grp, seq, coalesce(sqrt(power(x - lag(x) OVER w, 2) + power(y - lag(y) OVER w, 2)), 0) AS step FROM profile WINDOW w AS (PARTITION BY grp ORDER BY seq))", profile=PROFILE)
def _(t, profile):
    return W.chainage(profile.drop("s"), ["grp"], "seq").select("grp", "seq", "s")


@query(
    "W02_resample",
    """WITH seg AS (SELECT grp, s, z, lead(s) OVER w AS s1, lead(z) OVER w AS z1 FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)),
    pts AS (SELECT *, unnest(range(CAST(ceil(s / 10) AS BIGINT), CAST(ceil(s1 / 10) AS BIGINT))) * 10.0 AS p FROM seg WHERE s1 IS NOT NULL)
    SELECT grp, CAST(p AS DOUBLE) AS s, z + (p - s) / (s1 - s) * (z1 - z) AS z FROM pts UNION ALL SELECT grp, s, z FROM seg WHERE s1 IS NULL""",
    profile=PROFILE,
)
def _(t, profile):
    return W.resample(profile, ["grp"], 10.0)


_ENV = """SELECT *, greatest(max(z + g * s) OVER f - g * s, max(z - g * s) OVER b + g * s) AS lower,
  least(min(z - g * s) OVER f + g * s, min(z + g * s) OVER b - g * s) AS upper FROM (SELECT *, 0.5E0 AS g FROM profile)
  WINDOW f AS (PARTITION BY grp ORDER BY s ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY grp ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


@query("W03_grade_envelope", f"SELECT grp, seq, lower, upper, (lower + upper) / 2 AS fit FROM ({_ENV})", profile=PROFILE)
def _(t, profile):
    return W.grade_envelope(profile, ["grp"], 0.5).select("grp", "seq", "lower", "upper", "fit")


@query("W03_curved_grade")
def _(t):
    """Radius 100 m: the grade changes by at most 0.25 from one segment of 25 m to the next."""
    profile = t.sql(PROFILE)
    fitted = W.curved_grade(profile, ["grp"], 0.5, 100.0, 0.1, F.col("kind") == "error", F.when(F.col("s") == 250, F.col("z") + 1))
    return fitted.select("grp", (F.col("s") / 25).cast("long").alias("nth"), "fit", "residual", "deviation")


@query(
    "W04_minimax_grade",
    """WITH d AS (SELECT *, coalesce((CASE WHEN kind = 'error' THEN 0.1 ELSE 0.5 END) * (s - lag(s) OVER w), 0) AS dc, CASE WHEN seq % 500 = 0 THEN z + 1 END AS a FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)),
    c AS (SELECT *, sum(dc) OVER (PARTITION BY grp ORDER BY s) AS c FROM d),
    e AS (SELECT grp, z, greatest(max(z + c) OVER f - c, max(z - c) OVER b + c) AS lo, least(min(z - c) OVER f + c, min(z + c) OVER b - c) AS hi,
      greatest(max(a + c) OVER f - c, max(a - c) OVER b + c) AS alo, least(min(a - c) OVER f + c, min(a + c) OVER b - c) AS ahi FROM c
      WINDOW f AS (PARTITION BY grp ORDER BY s ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY grp ORDER BY s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT grp, coalesce(max(alo - ahi), 0) <= 1e-9 AS feasible, CASE WHEN coalesce(max(alo - ahi), 0) <= 1e-9 THEN greatest(max((lo - hi) / 2), coalesce(max(greatest(alo - z, z - ahi)), 0), 0) END AS deviation FROM e GROUP BY grp""",
    profile=PROFILE,
)
def _(t, profile):
    return W.minimax_grade(profile, ["grp"], 0.5, 0.1, F.col("kind") == "error", F.when(F.col("seq") % 500 == 0, F.col("z") + 1))


@query(
    "W04_fitted_grade",
    """WITH d AS (SELECT *, coalesce((CASE WHEN kind = 'error' THEN 0.1 ELSE 0.5 END) * (s - lag(s) OVER w), 0) AS dc, CASE WHEN seq % 500 = 0 THEN z + 1 END AS a FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)),
    c AS (SELECT *, sum(dc) OVER (PARTITION BY grp ORDER BY s) AS c FROM d), p AS (SELECT a.grp, a.seq, a.z, max((a.z - b.z - abs(a.c - b.c)) / 2) AS gap, max(CASE WHEN b.a IS NOT NULL THEN abs(a.z - b.a) - abs(a.c - b.c) END) AS tie, max(CASE WHEN a.a IS NOT NULL AND b.a IS NOT NULL THEN abs(a.a - b.a) - abs(a.c - b.c) END) AS clash FROM c a JOIN c b USING (grp) GROUP BY 1, 2, 3),
    g AS (SELECT grp, CASE WHEN coalesce(max(clash), 0) <= 1e-9 THEN greatest(max(gap), coalesce(max(tie), 0), 0) END AS dev FROM p GROUP BY grp)
    SELECT a.grp, a.seq, round(dev, 6) AS deviation, CASE WHEN dev IS NOT NULL THEN round((max(coalesce(b.a, b.z - dev) - abs(a.c - b.c)) + min(coalesce(b.a, b.z + dev) + abs(a.c - b.c))) / 2, 6) END AS fit FROM c a JOIN c b ON b.grp = a.grp JOIN g ON g.grp = a.grp GROUP BY a.grp, a.seq, dev""",
    profile=PROFILE,
)
def _(t, profile):
    fitted = W.fitted_grade(profile, ["grp"], 0.5, 0.1, F.col("kind") == "error", F.when(F.col("seq") % 500 == 0, F.col("z") + 1))
    return fitted.select("grp", "seq", F.round("deviation", 6).alias("deviation"), F.round("fit", 6).alias("fit"))


@query("W05_step_grade", "SELECT grp, seq, (z - lag(z) OVER w) / (s - lag(s) OVER w) * 1000 AS grade_pm FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)", profile=PROFILE)
def _(t, profile):
    return W.step_grade(profile, ["grp"]).select("grp", "seq", "grade_pm")


@query(
    "W06_runs",
    """SELECT grp, ok, min(seq) AS run_start, max(seq) AS run_end, count(*) AS run_length FROM (SELECT grp, seq, z > 20 AS ok,
    row_number() OVER (PARTITION BY grp ORDER BY seq) - row_number() OVER (PARTITION BY grp, z > 20 ORDER BY seq) AS i FROM profile) GROUP BY grp, ok, i""",
    profile=PROFILE,
)
def _(t, profile):
    return W.runs(profile.withColumn("ok", F.col("z") > 20), ["grp"], "seq", "ok")


_W7 = " + ".join(f"exp(-0.5 * power({i} / 1.0, 2)) * coalesce({'lag' if i < 0 else 'lead'}(z, {abs(i)}) OVER w, {'first' if i < 0 else 'last'}_value(z) OVER a)" for i in range(-3, 4))
_W7_SUM = " + ".join(f"exp(-0.5 * power({i} / 1.0, 2))" for i in range(-3, 4))


@query(
    "W07_smooth",
    f"""WITH raw AS (SELECT grp, s, seq, z, ({_W7}) / ({_W7_SUM}) AS r FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s), a AS (PARTITION BY grp ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    p AS (SELECT *, count(*) OVER (PARTITION BY grp) AS n, row_number() OVER (PARTITION BY grp ORDER BY s) - 1 AS i, first_value(z) OVER a - first_value(r) OVER a AS f0, last_value(z) OVER a - last_value(r) OVER a AS f1
      FROM raw WINDOW a AS (PARTITION BY grp ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
    SELECT grp, seq, r + CASE WHEN n > 1 THEN f0 * (1 - i / (n - 1)) + f1 * i / (n - 1) ELSE f0 END AS smooth FROM p""",
    profile=PROFILE,
)
def _(t, profile):
    return W.smooth(profile, ["grp"], "s", "z", 1.0).select("grp", "seq", "smooth")


_G = "(a * a * lead({v}) OVER w + (b * b - a * a) * {v} - b * b * lag({v}) OVER w) / (a * b * (a + b))"


_CURVATURE = f"""WITH d AS (SELECT *, s - lag(s) OVER w AS a, lead(s) OVER w - s AS b FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)),
    g AS (SELECT *, {_G.format(v='x')} AS dx, {_G.format(v='y')} AS dy FROM d WINDOW w AS (PARTITION BY grp ORDER BY s)),
    h AS (SELECT *, {_G.format(v='dx')} AS ddx, {_G.format(v='dy')} AS ddy, row_number() OVER w AS i, count(*) OVER (PARTITION BY grp) AS n FROM g WINDOW w AS (PARTITION BY grp ORDER BY s)),
    k AS (SELECT *, abs(dx * ddy - dy * ddx) / power(power(dx, 2) + power(dy, 2), 1.5) AS bend FROM h)
    SELECT grp, seq, CASE WHEN i > 2 AND i <= n - 2 AND bend > 0 THEN 1 / bend END AS radius FROM k"""


@query(
    "W08_curvature",
    _CURVATURE,
    profile=PROFILE,
)
def _(t, profile):
    return W.curvature(profile, ["grp"], trim=2).select("grp", "seq", "radius")


@query("W08_least_radius", f"SELECT grp, min(radius) AS least, quantile_cont(radius, 0.05) AS p05, count(radius) AS bends FROM ({_CURVATURE}) GROUP BY grp", profile=PROFILE)
def _(t, profile):
    return W.least_radius(profile, ["grp"], trim=2)


@query(
    "W09_lateral_shift",
    """WITH d AS (SELECT grp, seq, x, y, coalesce(lead(x) OVER w, x) - coalesce(lag(x) OVER w, x) AS tx, coalesce(lead(y) OVER w, y) - coalesce(lag(y) OVER w, y) AS ty, row_number() OVER w AS i, count(*) OVER (PARTITION BY grp) AS n
      FROM profile WINDOW w AS (PARTITION BY grp ORDER BY s)),
    m AS (SELECT *, CASE WHEN n > 1 AND sqrt(tx * tx + ty * ty) > 0 THEN 120 * power(sin(pi() * (i - 1) / (n - 1)), 2) / sqrt(tx * tx + ty * ty) ELSE 0 END AS m FROM d)
    SELECT grp, seq, x - ty * m AS shift_x, y + tx * m AS shift_y FROM m""",
    profile=PROFILE,
)
def _(t, profile):
    return W.lateral_shift(profile, ["grp"], "s", 120.0).select("grp", "seq", "shift_x", "shift_y")


_N = "CASE WHEN max({c}) OVER p = min({c}) OVER p THEN 0.5 ELSE {e} / (max({c}) OVER p - min({c}) OVER p) END"


@query("W10_minmax", f"SELECT option_id, speed, {_N.format(c='minutes', e='(max(minutes) OVER p - minutes)')} AS quick FROM options WINDOW p AS (PARTITION BY speed)", options=OPTIONS)
def _(t, options):
    return W.minmax(options, ["speed"], "minutes", True, "quick").select("option_id", "speed", "quick")


#: Weight sets over three measures; each sums to 1.
PROFILES = {"even": {"quick": 0.4, "people": 0.3, "short": 0.3}, "access": {"quick": 0.2, "people": 0.6, "short": 0.2}}


@query(
    "W11_score",
    f"""WITH n AS (SELECT option_id, speed, {_N.format(c='minutes', e='(max(minutes) OVER p - minutes)')} AS quick, {_N.format(c='residents', e='(residents - min(residents) OVER p)')} AS people,
      {_N.format(c='length_km', e='(max(length_km) OVER p - length_km)')} AS short FROM options WINDOW p AS (PARTITION BY speed)),
    s AS (SELECT option_id, speed, 'even' AS profile, quick * 0.4 + people * 0.3 + short * 0.3 AS score FROM n UNION ALL SELECT option_id, speed, 'access', quick * 0.2 + people * 0.6 + short * 0.2 FROM n)
    SELECT option_id, speed, profile, score, row_number() OVER (PARTITION BY profile, speed ORDER BY score DESC NULLS LAST, option_id) AS rank FROM s""",
    options=OPTIONS,
)
def scored(t, options):
    for column, minimise, name in (("minutes", True, "quick"), ("residents", False, "people"), ("length_km", True, "short")):
        options = W.minmax(options, ["speed"], column, minimise, name)
    return W.score(options, ["speed"], "option_id", PROFILES).select("option_id", "speed", "profile", "score", "rank")


RECTS = """SELECT c_custkey AS tile_id, c_mktsegment AS scan, CAST((c_custkey * 53) % 1000 AS DOUBLE) AS xmin, CAST((c_custkey * 71) % 1000 AS DOUBLE) AS ymin,
  CAST((c_custkey * 53) % 1000 + 5 + c_nationkey AS DOUBLE) AS xmax, CAST((c_custkey * 71) % 1000 + 10 AS DOUBLE) AS ymax FROM {customer}"""


@query("W12_next_gap", "SELECT tile_id, scan, greatest(lead(xmin) OVER (PARTITION BY scan ORDER BY xmin, xmax, tile_id) - xmax, 0) AS gap FROM rects", rects=RECTS)
def _(t, rects):
    return W.next_gap(rects, ["scan"], "xmin", "xmax", "tile_id").select("tile_id", "scan", "gap")


LINES = "SELECT conv_id, turn, role, text FROM {conversations}"


@query("W13_with_context", "SELECT conv_id, turn, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '') AS context FROM lines WHERE trim(text) <> ''", lines=LINES)
def _(t, lines):
    return W.with_context(lines, ["conv_id"], "turn").select("conv_id", "turn", "context")


@query(
    "W14_carry_headers",
    """SELECT conv_id, turn, header FROM (SELECT *, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS header FROM lines) WHERE role <> 'user'""",
    lines=LINES,
)
def _(t, lines):
    return W.carry_headers(lines, ["conv_id"], "turn", F.col("role") == "user", "text").select("conv_id", "turn", "header")


@query(
    "W15_check_monotone",
    "SELECT grp, bool_and(ok) AS monotone, count(*) FILTER (NOT ok) AS breaks FROM (SELECT grp, coalesce(z >= lag(z) OVER (PARTITION BY grp ORDER BY seq) - 1e-9, true) AS ok FROM profile) GROUP BY grp",
    profile=PROFILE,
)
def _(t, profile):
    return W.check_monotone(profile, ["grp"], "seq", "z")
