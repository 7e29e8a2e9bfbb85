"""Operators on ordered rows: chainage, envelopes, grades, runs, smoothing, scores. Each works within a group by an order."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def chainage(df: DataFrame, group: list[str], order: str, x: str = "x", y: str = "y") -> DataFrame:
    """Add ``s``, the distance along the points so far."""
    w = Window.partitionBy(*group).orderBy(order)
    step = F.coalesce(F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)), F.lit(0.0))
    return df.withColumn("_step", step).withColumn("s", F.sum("_step").over(w)).drop("_step")


def resample(df: DataFrame, group: list[str], step: float, s: str = "s", values: tuple[str, ...] = ("z",)) -> DataFrame:
    """Rows at every ``step`` of ``s``, linear between neighbours; the last point is kept.

    Each segment makes its own points, so no join is needed. Points at one s: the last wins.
    """
    w = Window.partitionBy(*group).orderBy(s)
    rows = df.withColumn("_s1", F.lead(s).over(w))
    for v in values:
        rows = rows.withColumn(f"_{v}1", F.lead(v).over(w))
    first, end = F.ceil(F.col(s) / step), F.ceil(F.col("_s1") / step) - 1
    inner = F.when(F.col("_s1").isNull(), F.array(F.col(s))).when(end >= first, F.transform(F.sequence(first, F.greatest(first, end)), lambda i: i * F.lit(float(step)))).otherwise(F.array().cast("array<double>"))
    made = rows.withColumn("_at", F.explode(inner))
    t = (F.col("_at") - F.col(s)) / (F.col("_s1") - F.col(s))
    lerp = [F.when(F.col("_s1").isNull(), F.col(v)).otherwise(F.col(v) + t * (F.col(f"_{v}1") - F.col(v))).alias(v) for v in values]
    return made.select(*group, F.col("_at").alias(s), *lerp)


def grade_envelope(df: DataFrame, group: list[str], cap: float, s: str = "s", z: str = "z") -> DataFrame:
    """Add ``lower``, ``upper`` and ``fit``, the closest profile in the largest deviation whose grade is at most ``cap``."""
    fore = Window.partitionBy(*group).orderBy(s).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*group).orderBy(s).rowsBetween(0, Window.unboundedFollowing)
    up, down = F.col(z) + cap * F.col(s), F.col(z) - cap * F.col(s)
    lower = F.greatest(F.max(up).over(fore) - cap * F.col(s), F.max(down).over(back) + cap * F.col(s))
    upper = F.least(F.min(down).over(fore) + cap * F.col(s), F.min(up).over(back) - cap * F.col(s))
    return df.withColumns({"lower": lower, "upper": upper, "fit": (lower + upper) / 2})


def minimax_grade(df: DataFrame, group: list[str], cap: float, station_cap: float, at_station: Column, anchor: Column | None = None, s: str = "s", z: str = "z") -> DataFrame:
    """Per group ``deviation``, the least largest deviation of a profile under the caps, and ``feasible``.

    The distance is the cost: caps times lengths, with ``station_cap`` on segments that end at a station. Rows with a value
    in ``anchor`` are tied to it: the deviation is at least what their cones ask, and anchors too far apart are infeasible.
    """
    w = Window.partitionBy(*group).orderBy(s)
    cost = F.when(at_station, station_cap).otherwise(cap) * (F.col(s) - F.lag(s).over(w))
    rows = df.withColumn("_dc", F.coalesce(cost, F.lit(0.0))).withColumn("_c", F.sum("_dc").over(w))
    rows = rows.withColumn("_a", (anchor if anchor is not None else F.lit(None)).cast("double"))
    fore, back = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)

    def cones(v: str) -> tuple[Column, Column]:
        low = F.greatest(F.max(F.col(v) + F.col("_c")).over(fore) - F.col("_c"), F.max(F.col(v) - F.col("_c")).over(back) + F.col("_c"))
        high = F.least(F.min(F.col(v) - F.col("_c")).over(fore) + F.col("_c"), F.min(F.col(v) + F.col("_c")).over(back) - F.col("_c"))
        return low, high

    low, high = cones(z)
    a_low, a_high = cones("_a")
    rows = rows.withColumns({"_gap": (low - high) / 2, "_tie": F.greatest(a_low - F.col(z), F.col(z) - a_high), "_clash": a_low - a_high})
    deviation = F.greatest(F.max("_gap"), F.coalesce(F.max("_tie"), F.lit(0.0)), F.lit(0.0))
    feasible = F.coalesce(F.max("_clash"), F.lit(0.0)) <= 1e-9
    return rows.groupBy(*group).agg(F.when(feasible, deviation).alias("deviation"), feasible.alias("feasible"))


def fitted_grade(df: DataFrame, group: list[str], cap: float, station_cap: float, at_station: Column, anchor: Column | None = None, s: str = "s", z: str = "z") -> DataFrame:
    """The rows with ``fit``, a profile whose largest deviation is the least possible and whose grades obey the caps, ``residual`` (z less fit)
    and ``deviation`` (the group's); null where anchors make it infeasible.

    Every row allows heights within the deviation of its own, an anchor only its value. Cones under the caps from all rows bound the profile from
    below and above; both bounds, and so the middle between them, obey the caps. Of all best profiles that is the one in the middle.
    """
    best = minimax_grade(df, group, cap, station_cap, at_station, anchor, s, z)
    w = Window.partitionBy(*group).orderBy(s)
    cost = F.when(at_station, station_cap).otherwise(cap) * (F.col(s) - F.lag(s).over(w))
    rows = df.withColumn("_dc", F.coalesce(cost, F.lit(0.0))).withColumn("_c", F.sum("_dc").over(w))
    rows = rows.withColumn("_a", (anchor if anchor is not None else F.lit(None)).cast("double")).join(best.select(*group, "deviation"), group)
    rows = rows.withColumns({"_lo": F.coalesce("_a", F.col(z) - F.col("deviation")), "_hi": F.coalesce("_a", F.col(z) + F.col("deviation"))})
    fore, back = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    low = F.greatest(F.max(F.col("_lo") + F.col("_c")).over(fore) - F.col("_c"), F.max(F.col("_lo") - F.col("_c")).over(back) + F.col("_c"))
    high = F.least(F.min(F.col("_hi") - F.col("_c")).over(fore) + F.col("_c"), F.min(F.col("_hi") + F.col("_c")).over(back) - F.col("_c"))
    fit = F.when(F.col("deviation").isNotNull(), (low + high) / 2)
    return rows.withColumn("fit", fit).withColumn("residual", F.col(z) - F.col("fit")).drop("_dc", "_c", "_a", "_lo", "_hi")


def _hull(points: list[tuple[float, float]], lift: float) -> list[tuple[float, float]]:
    """The convex hull of ``points`` (height, grade), in turn, its upper side raised and its lower side lowered by ``lift``."""
    points = sorted(points)
    sides = []
    for sign in (1.0, -1.0):
        side: list[tuple[float, float]] = []
        for p in points:
            while len(side) > 1 and sign * ((side[-1][0] - side[-2][0]) * (p[1] - side[-2][1]) - (side[-1][1] - side[-2][1]) * (p[0] - side[-2][0])) <= 0:
                side.pop()
            side.append(p)
        sides.append([(x, y - sign * lift) for x, y in side])
    return sides[0] + sides[1][::-1]


def _clip(points: list[tuple[float, float]], axis: int, low: float, high: float) -> list[tuple[float, float]]:
    """What of a convex polygon lies between ``low`` and ``high`` on an axis."""
    for bound, sign in ((low, 1.0), (high, -1.0)):
        kept = []
        for p, q in zip(points, points[1:] + points[:1], strict=True):
            dp, dq = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if dp >= 0:
                kept.append(p)
            if (dp < 0) != (dq < 0):
                t = dp / (dp - dq)
                x = [p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])]
                x[axis] = bound
                kept.append((x[0], x[1]))
        points = kept
    return points


def _curved_line(s: np.ndarray, low: np.ndarray, high: np.ndarray, caps: np.ndarray, radius: float, keep: list | None = None) -> bool:
    """Whether a profile between ``low`` and ``high`` keeps the caps and the radius; ``keep`` gets what can be reached at each row.

    What can be reached at a row is a convex polygon of heights and grades of the segment before. A step lets the grade change by the bound,
    cuts it to the cap, moves each height on by its grade, and cuts heights to the row's.
    """
    here = [(low[0], -caps[0]), (high[0], -caps[0]), (high[0], caps[0]), (low[0], caps[0])]
    for i in range(1, len(s)):
        h = s[i] - s[i - 1]
        if i > 1:
            here = _clip(_hull(here, (s[i] - s[i - 2]) / 2 / radius), 1, -caps[i - 1], caps[i - 1])
        here = _clip([(z + h * g, g) for z, g in here], 0, low[i], high[i])
        if not here:
            return False
        if keep is not None:
            keep.append(here)
    return True


def _strip(x: np.ndarray, y: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What of convex polygons (a column each, corners in turn, some repeated) has ``x`` between ``low`` and ``high``, and the number of corners left.
    Each side gives where it enters and, unless it ends inside, where it leaves."""
    x1, y1 = np.concatenate([x[1:], x[:1]]), np.concatenate([y[1:], y[:1]])
    under, over, under1, over1 = x < low, x > high, x1 < low, x1 > high
    with np.errstate(all="ignore"):
        slope = (y1 - y) / (x1 - x)
        enter_x, leave_x = np.where(under, low, np.where(over, high, x)), np.where(under1, low, high)
        enter_y, leave_y = np.where(under | over, y + (enter_x - x) * slope, y), y + (leave_x - x) * slope
    met = ~(under & under1) & ~(over & over1)
    fresh = (x != x1) | (y != y1)
    fresh[0] = True
    n, lanes = x.shape
    kept = np.empty((2 * n, lanes), bool)
    kept[0::2] = met & fresh & ~((under | over) & (enter_x == x1))
    kept[1::2] = met & (under1 | over1)
    at = np.cumsum(kept, axis=0) - 1
    left = at[-1] + 1
    row, lane = np.nonzero(kept)
    place, corners = at[row, lane], []
    for enter, leave in ((enter_x, leave_x), (enter_y, leave_y)):
        both = np.empty((2 * n, lanes))
        both[0::2], both[1::2] = enter, leave
        values, first = both[row, lane], np.zeros(lanes)
        first[lane[place == 0]] = values[place == 0]
        made = np.repeat(first[None], max(1, int(left.max(initial=0))), axis=0)
        made[place, lane] = values
        corners.append(made)
    return corners[0], corners[1], left


def _lift(x: np.ndarray, y: np.ndarray, lift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Convex polygons, against the clock, with their upper sides raised and their lower sides lowered by ``lift``."""
    n, lanes = x.shape
    column = np.arange(lanes)
    first = np.where(x == x.min(axis=0), y, np.inf).argmin(axis=0)
    turned = (np.arange(n)[:, None] + first) % n
    x, y = x[turned, column], y[turned, column]
    last = np.where(x == x.max(axis=0), y, -np.inf).argmax(axis=0)
    place = np.arange(n + 2)[:, None]
    lower = place <= last
    source = np.where(lower, place, (place - 1) % n)
    return x[source, column], y[source, column] + np.where(lower, -lift, lift)


def _curved_lines(s: np.ndarray, z: np.ndarray, tied: np.ndarray, caps: np.ndarray, start: np.ndarray, n: np.ndarray, t: np.ndarray, radius: float) -> np.ndarray:
    """``_curved_line`` for many lines at once, each ``n`` rows from ``start`` with a deviation ``t``: what each can reach is a column of corners.
    ``caps`` are those of the segment that ends at a row."""
    holds, on = np.zeros(len(t), bool), np.arange(len(t))
    x = y = np.empty((0, 0))
    for i in range(int(n.max(initial=0))):
        at = start[on] + i
        tie, here = tied[at], z[at]
        low, high = np.where(np.isnan(tie), here - t[on], tie), np.where(np.isnan(tie), here + t[on], tie)
        if i == 0:
            cap = caps[at + 1]
            x, y = np.stack([low, high, high, low]), np.stack([-cap, -cap, cap, cap])
            continue
        left = np.ones(len(on), bool)
        if i > 1:
            x, y = _lift(x, y, (s[at] - s[at - 2]) / 2 / radius)
            y, x, corners = _strip(y, x, -caps[at], caps[at])
            left = corners > 0
        x, y, corners = _strip(x + (s[at] - s[at - 1]) * y, y, low, high)
        left &= corners > 0
        ends = left & (n[on] == i + 1)
        holds[on[ends]] = True
        left &= ~ends
        if not left.all():
            x, y, on = x[:, left], y[:, left], on[left]
            if not len(on):
                break
    return holds


def _curved_deviations(s: np.ndarray, z: np.ndarray, tied: np.ndarray, caps: np.ndarray, start: np.ndarray, n: np.ndarray, radius: float, tolerance: float, lanes: int = 256) -> np.ndarray:
    """The least deviations of lines of two rows or more, to ``tolerance``; not a number where ties make one infeasible.

    Few lines try several deviations in a pass, many one.
    """
    low, high = np.empty(len(n)), np.empty(len(n))
    for k, (a, m) in enumerate(zip(start, n, strict=True)):
        part = slice(a, a + m)
        free, height = np.isnan(tied[part]), z[part]
        # Ties count as deviations, as in the grade envelope without a radius; that one's deviation is the least there can be.
        heights, cost = np.where(free, height, tied[part]), np.concatenate([[0.0], np.cumsum(caps[part][1:] * np.diff(s[part]))])
        off = np.nanmax(np.abs(np.where(free, 0.0, tied[part] - height)))
        lower, upper = np.maximum.accumulate(height + cost) - cost, np.minimum.accumulate(height - cost) + cost
        low[k] = max(np.max(lower - height) / 2, np.max(height - upper) / 2, off)
        high[k] = heights.max() - heights.min() + 2 * cost[-1] + off + 1
    holds = lambda k, t: _curved_lines(s, z, tied, caps, start[k], n[k], t, radius)
    best = np.full(len(n), np.nan)
    every = np.arange(len(n))
    at_least = holds(every, low)
    best[at_least] = low[at_least]
    open_ = every[~at_least]
    open_ = open_[holds(open_, high[open_])]
    while len(open_):
        parts = 2
        while parts * len(open_) < lanes:
            parts *= 2
        share = np.arange(1, parts) / parts
        tries = low[open_] + share[:, None] * (high[open_] - low[open_])
        good = holds(np.tile(open_, parts - 1), tries.ravel()).reshape(tries.shape)
        bounds = np.concatenate([low[open_][None], tries, high[open_][None]])
        first = np.where(good.any(axis=0), good.argmax(axis=0), parts - 1)
        column = np.arange(len(open_))
        low[open_], high[open_] = bounds[first, column], bounds[first + 1, column]
        near = high[open_] - low[open_] <= tolerance
        best[open_[near]] = high[open_[near]]
        open_ = open_[~near]
    return best


def _curved_fit(s: np.ndarray, z: np.ndarray, tied: np.ndarray, caps: np.ndarray, radius: float, best: float, tolerance: float) -> np.ndarray:
    """The fit of one line with its least deviation ``best``."""
    free = np.isnan(tied)
    if math.isnan(best):
        return np.full(len(s), np.nan)
    # At the least deviation what can be reached is a point at some rows, which rounding may miss: the fit may differ by the tolerance more.
    for up in (tolerance, 8 * tolerance, 64 * tolerance):
        reached: list = []
        if _curved_line(s, np.where(free, z - best - up, tied), np.where(free, z + best + up, tied), caps, radius, reached):
            break
    fit, grade = np.empty(len(s)), math.nan
    fit[-1] = (min(p[0] for p in reached[-1]) + max(p[0] for p in reached[-1])) / 2
    for i in range(len(s) - 1, 0, -1):
        # Grades of the segment before that reach this height, as near the grade after as the radius asks; the middle of them. A height that rounding
        # puts beside what can be reached is taken at its edge.
        heights = [p[0] for p in reached[i - 1]]
        v = min(max(fit[i], min(heights)), max(heights))
        at = [g for _, g in _clip(reached[i - 1], 0, v - tolerance / 8, v + tolerance / 8)]
        a, b = min(at), max(at)
        if i < len(s) - 1:
            bend = (s[i + 1] - s[i - 1]) / 2 / radius
            a, b = max(a, grade - bend), min(b, grade + bend)
        grade = (a + b) / 2
        fit[i - 1] = fit[i] - grade * (s[i] - s[i - 1])
    return fit


def curved_grade(
    df: DataFrame, group: list[str], cap: float, radius: float, station_cap: float | None = None, at_station: Column | None = None, anchor: Column | None = None,
    s: str = "s", z: str = "z", tolerance: float = 1e-8, most: int = 200_000, block: int = 65_536,
) -> DataFrame:
    """(group, s, z, fit, residual, deviation): the profile with the least largest deviation whose grades are at most ``cap``, or
    ``station_cap`` on segments that end at a station, and change between segments by at most their mean length over ``radius``.

    On even steps that is the bound h^2 / radius on second differences. Rows with a value in ``anchor`` are tied to it, and their own distance
    counts in ``deviation``; where ties cannot be met, fit and deviation are null. The deviation is found by halving to ``tolerance``; where the
    radius does not bind, it is that of the envelope. Of all best profiles the one is taken that halves, from the last row back, what the rows before leave open.
    A line of one row is its own fit. Rows without ``s`` or ``z``, infinite ones, and two rows at one ``s`` are errors, as no ground may be made up.
    Lines are solved in groups of some ``block`` rows, whose profiles step on together in arrays; a line is not parted: lines over ``most``
    rows (5,000 km at 25 m) are an error, counted before any is gathered.
    """
    tied = (anchor if anchor is not None else F.lit(None)).cast("double")
    caps = F.when(at_station, station_cap).otherwise(cap) if at_station is not None else F.lit(float(cap))
    rows = df.select(*group, F.col(s).cast("double").alias(s), F.col(z).cast("double").alias(z), tied.alias("_tied"), caps.cast("double").alias("_cap"))
    # Little data and much work a row: a fixed number of partitions is not put together for being small. The window and the groups keep it.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, *group).withColumn("_line", F.min(F.monotonically_increasing_id()).over(Window.partitionBy(*group)))
    blocks = max(tasks, -(-df.count() // block))
    w = Window.partitionBy(*group).orderBy(s)
    sound = lambda c: F.col(c).isNotNull() & ~F.col(c).isin(math.nan, math.inf, -math.inf)
    rows = rows.withColumn("_n", F.row_number().over(w)).withColumn("_same", F.coalesce(F.col(s) == F.lag(s).over(w), F.lit(False)))
    rows = rows.withColumn(
        s,
        F.when(~sound(s) | ~sound(z), F.raise_error(F.lit("a row without ground")).cast("double"))
        .when(F.col("_same"), F.raise_error(F.lit("two rows at one distance")).cast("double"))
        .when(F.col("_n") > most, F.raise_error(F.lit(f"a line of more than {most} rows")).cast("double"))
        .otherwise(F.col(s)),
    ).drop("_same", "_n")

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_line", s], ignore_index=True)
        x, y, ties, steps = (part[c].to_numpy(float) for c in (s, z, "_tied", "_cap"))
        start = np.flatnonzero(np.diff(part["_line"].to_numpy(), prepend=-1))
        n = np.diff(start, append=len(part))
        fit, best = np.where(np.isnan(ties), y, ties), np.empty(len(n))
        best[n == 1] = np.abs(fit - y)[start[n == 1]]
        best[n > 1] = _curved_deviations(x, y, ties, steps, start[n > 1], n[n > 1], radius, tolerance)
        for a, m, d in zip(start[n > 1], n[n > 1], best[n > 1], strict=True):
            line = slice(a, a + m)
            fit[line] = _curved_fit(x[line], y[line], ties[line], steps[line][1:], radius, d, tolerance)
        return part[[*group, s, z]].assign(fit=fit, residual=y - fit, deviation=np.repeat(best, n))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*group, s, z).schema)
    # The blocks are dealt as evenly as lines are; AQE must not put these small rows together.
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*group), F.lit(blocks))).repartition(blocks, "_block")
    solved = dealt.groupBy("_block").applyInPandas(solve, f"{kinds}, fit double, residual double, deviation double")
    return solved.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in ("fit", "residual", "deviation")})


def step_grade(df: DataFrame, group: list[str], order: str = "s", z: str = "z") -> DataFrame:
    """Add ``grade_pm``, per mille from the sample before; null across a missing sample."""
    w = Window.partitionBy(*group).orderBy(order)
    ds = F.col(order) - F.lag(order).over(w)
    return df.withColumn("grade_pm", F.when(ds > 0, (F.col(z) - F.lag(z).over(w)) / ds * 1000))


def runs(df: DataFrame, group: list[str], order: str, flag: str) -> DataFrame:
    """One row for each run of equal flags: (flag, start, end, length)."""
    w = Window.partitionBy(*group).orderBy(order)
    by = Window.partitionBy(*group, flag).orderBy(order)
    marked = df.withColumn("_island", F.row_number().over(w) - F.row_number().over(by))
    return marked.groupBy(*group, flag, "_island").agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count(F.lit(1)).alias("run_length")).drop("_island")


def smooth(df: DataFrame, group: list[str], order: str, value: str, sigma: float) -> DataFrame:
    """Add ``smooth``: Gaussian weights over three sigma of rows, ends padded with the nearest row, both ends pinned."""
    k = int(math.ceil(3 * sigma))
    weights = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-k, k + 1)]
    w = Window.partitionBy(*group).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first(value).over(whole), F.last(value).over(whole)
    shifted = [F.coalesce(F.lag(value, -i).over(w), first if i < 0 else last) * c for i, c in zip(range(-k, k + 1), weights, strict=True)]
    total = shifted[0]
    for x in shifted[1:]:
        total = total + x
    rows = df.withColumn("_raw", total / sum(weights))
    n, i = F.count(F.lit(1)).over(whole), F.row_number().over(w) - 1
    t = F.when(n > 1, i / (n - 1)).otherwise(F.lit(0.0))
    fix = (first - F.first("_raw").over(whole)) * (1 - t) + (last - F.last("_raw").over(whole)) * t
    return rows.withColumn("smooth", F.col("_raw") + fix).drop("_raw")


def curvature(df: DataFrame, group: list[str], order: str = "s", x: str = "x", y: str = "y", trim: int = 0) -> DataFrame:
    """Add ``radius`` from second-order gradients on uneven steps; null at ``trim`` + 1 rows from either end and on straights."""
    w = Window.partitionBy(*group).orderBy(order)

    def gradient(v: str) -> Column:
        a, b = F.col(order) - F.lag(order).over(w), F.lead(order).over(w) - F.col(order)
        return (a * a * F.lead(v).over(w) + (b * b - a * a) * F.col(v) - b * b * F.lag(v).over(w)) / (a * b * (a + b))

    rows = df.withColumns({"_dx": gradient(x), "_dy": gradient(y)})
    rows = rows.withColumns({"_ddx": gradient("_dx"), "_ddy": gradient("_dy")})
    bend = F.abs(F.col("_dx") * F.col("_ddy") - F.col("_dy") * F.col("_ddx")) / F.pow(F.col("_dx") ** 2 + F.col("_dy") ** 2, 1.5)
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    i = F.row_number().over(w)
    return rows.withColumn("radius", F.when((i > trim) & (i <= n - trim) & (bend > 0), 1 / bend)).drop("_dx", "_dy", "_ddx", "_ddy")


def least_radius(df: DataFrame, group: list[str], order: str = "s", x: str = "x", y: str = "y", trim: int = 10) -> DataFrame:
    """Per group the least radius of its bends and the 5th percentile, edges trimmed; null where all rows are straight."""
    rows = curvature(df, group, order, x, y, trim)
    return rows.groupBy(*group).agg(F.min("radius").alias("least"), F.percentile("radius", F.lit(0.05)).alias("p05"), F.count("radius").alias("bends"))


def lateral_shift(df: DataFrame, group: list[str], order: str, offset: float, x: str = "x", y: str = "y") -> DataFrame:
    """Move points along the normal by offset * sin^2(pi t), t the share of the leg's rows."""
    w = Window.partitionBy(*group).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tx = F.coalesce(F.lead(x).over(w), F.col(x)) - F.coalesce(F.lag(x).over(w), F.col(x))
    ty = F.coalesce(F.lead(y).over(w), F.col(y)) - F.coalesce(F.lag(y).over(w), F.col(y))
    size = F.hypot(tx, ty)
    n = F.count(F.lit(1)).over(whole)
    move = F.when((n > 1) & (size > 0), offset * F.pow(F.sin(math.pi * (F.row_number().over(w) - 1) / (n - 1)), 2) / size).otherwise(F.lit(0.0))
    return df.withColumns({"shift_x": F.col(x) - ty * move, "shift_y": F.col(y) + tx * move})


def minmax(df: DataFrame, part: list[str], column: str, minimise: bool, name: str) -> DataFrame:
    """Add ``name`` from 0 (worst) to 1 (best) within ``part``; a constant gives 0.5, null stays null."""
    w = Window.partitionBy(*part)
    lo, hi, v = F.min(column).over(w), F.max(column).over(w), F.col(column)
    share = (hi - v) / (hi - lo) if minimise else (v - lo) / (hi - lo)
    return df.withColumn(name, F.when(v.isNull(), None).when(hi == lo, 0.5).otherwise(share))


def score(df: DataFrame, part: list[str], key: str, profiles: dict[str, dict[str, float]]) -> DataFrame:
    """One row for each profile with the weighted ``score`` of normalised columns and its ``rank`` within ``part``.

    Weights of a profile must name the same columns and sum to 1. A null measure gives a null score, ranked last; ties by ``key``.
    """
    names = {frozenset(p) for p in profiles.values()}
    if len(names) != 1 or any(abs(sum(p.values()) - 1) > 1e-9 for p in profiles.values()):
        raise ValueError("each profile needs the same measures, with weights that sum to 1")
    sums = []
    for name, weights in profiles.items():
        total = None
        for c, v in weights.items():
            total = F.col(c) * v if total is None else total + F.col(c) * v
        sums.append(F.struct(F.lit(name).alias("profile"), total.alias("score")))
    rows = df.withColumn("_p", F.explode(F.array(*sums))).select(*df.columns, "_p.profile", "_p.score")
    w = Window.partitionBy("profile", *part).orderBy(F.col("score").desc_nulls_last(), key)
    return rows.withColumn("rank", F.row_number().over(w))


def next_gap(df: DataFrame, part: list[str], low: str, high: str, key: str) -> DataFrame:
    """Add ``gap`` to the next window in order (ties by ``key``), at least 0; null for the last."""
    w = Window.partitionBy(*part).orderBy(low, high, key)
    return df.withColumn("gap", F.greatest(F.lead(low).over(w) - F.col(high), F.lit(0)))


def with_context(lines: DataFrame, group: list[str], order: str, text: str = "text", n: int = 3) -> DataFrame:
    """Non-empty lines with ``context``, the ``n`` such lines before, joined by a line break."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(-n, -1)
    return lines.where(F.trim(text) != "").withColumn("context", F.array_join(F.collect_list(text).over(w), "\n"))


def carry_headers(df: DataFrame, group: list[str], order: str, is_header: Column, label: str, name: str = "header") -> DataFrame:
    """Rows that are no header, with the label of the last header before."""
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_is", is_header).withColumn(name, F.last(F.when(F.col("_is"), F.col(label)), ignorenulls=True).over(w))
    return rows.where(~F.col("_is")).drop("_is")


def check_monotone(df: DataFrame, group: list[str], order: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """Per group whether ``value`` never falls as ``order`` rises."""
    w = Window.partitionBy(*group).orderBy(order)
    rows = df.withColumn("_ok", F.coalesce(F.col(value) >= F.lag(value).over(w) - tolerance, F.lit(True)))
    return rows.groupBy(*group).agg(F.bool_and("_ok").alias("monotone"), F.count_if(~F.col("_ok")).alias("breaks"))
