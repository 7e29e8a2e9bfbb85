"""Column functions on polygons of several rings: ``rings`` is array<array<struct<x, y>>>, holes and further parts told apart by parity alone.

A ring need not repeat its first corner, and may run either way round.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(rings: Column) -> Column:
    """All sides of all rings as structs (ax, ay, bx, by)."""
    side = lambda p, q: F.struct(p["x"].cast("double").alias("ax"), p["y"].cast("double").alias("ay"), q["x"].cast("double").alias("bx"), q["y"].cast("double").alias("by"))
    return F.flatten(F.transform(rings, lambda r: F.zip_with(r, F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1)), side)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def area(sides: Column) -> Column:
    """Area within ``edges`` whose holes run the other way round than the rings around them; for one ring always."""
    return F.abs(_sum(F.transform(sides, lambda e: e["ax"] * e["by"] - e["bx"] * e["ay"]))) / 2


def covers(sides: Column, x: Column, y: Column) -> Column:
    """Whether a point lies inside by parity over all rings, or on a side."""
    on = lambda e: ((e["bx"] - e["ax"]) * (y - e["ay"]) == (e["by"] - e["ay"]) * (x - e["ax"])) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    crosses = lambda e: ((e["ay"] > y) != (e["by"] > y)) & (x < e["ax"] + (y - e["ay"]) / (e["by"] - e["ay"]) * (e["bx"] - e["ax"]))
    return F.exists(sides, on) | (F.size(F.filter(sides, crosses)) % 2 == 1)


def _spans(cuts: Column) -> Column:
    """Sorted places in pairs (lo, hi)."""
    return F.transform(F.filter(cuts, lambda _, i: i % 2 == 0), lambda lo, i: F.struct(lo.alias("lo"), F.get(cuts, 2 * i + 1).alias("hi")))


def inner_point(sides: Column) -> Column:
    """A point inside, struct (x, y): the middle of the widest span of a horizontal line half way between the corners next to the middle height;
    of equal spans the leftmost. Null without any height."""
    ys = F.array_distinct(F.transform(sides, lambda e: e["ay"]))
    middle = (F.array_min(ys) + F.array_max(ys)) / 2
    level = (F.array_max(F.filter(ys, lambda y: y <= middle)) + F.array_min(F.filter(ys, lambda y: y > middle))) / 2

    def widest(y: Column) -> Column:
        crossing = F.filter(sides, lambda e: (e["ay"] > y) != (e["by"] > y))
        cuts = F.array_sort(F.transform(crossing, lambda e: e["ax"] + (y - e["ay"]) / (e["by"] - e["ay"]) * (e["bx"] - e["ax"])))
        best = F.array_max(F.transform(_spans(cuts), lambda s: F.struct((s["hi"] - s["lo"]).alias("w"), (-(s["lo"] + s["hi"]) / 2).alias("x"))))
        return F.struct((-best["x"]).alias("x"), y.alias("y"))

    # The only member of an array is worked out once.
    return F.get(F.transform(F.filter(F.array(level), lambda y: y.isNotNull()), widest), F.lit(0))


def overlap_area(a: Column, b: Column) -> Column:
    """Area common to two polygons given by their ``edges``, convex or not, with holes or parts.

    Between the abscissas of all corners and crossings no side ends or meets another, so in such a slab the common length along a
    vertical line changes evenly and its middle stands for the slab.
    """

    def meet(e: Column, f: Column) -> Column:
        """Abscissa where two sides cross, or null."""
        ex, ey, fx, fy = e["bx"] - e["ax"], e["by"] - e["ay"], f["bx"] - f["ax"], f["by"] - f["ay"]
        d, ux, uy = ex * fy - ey * fx, f["ax"] - e["ax"], f["ay"] - e["ay"]
        t, u = (ux * fy - uy * fx) / d, (ux * ey - uy * ex) / d
        return F.when(d != 0, F.when(t.between(0, 1) & u.between(0, 1), e["ax"] + t * ex))

    corners = lambda sides: F.transform(sides, lambda e: e["ax"])
    crossings = F.flatten(F.transform(a, lambda e: F.array_compact(F.transform(b, lambda f: meet(e, f)))))
    lo, hi = F.greatest(F.array_min(corners(a)), F.array_min(corners(b))), F.least(F.array_max(corners(a)), F.array_max(corners(b)))
    places = F.array_sort(F.array_distinct(F.filter(F.concat(corners(a), corners(b), crossings), lambda x: (x >= lo) & (x <= hi))))

    def spans(sides: Column, x: Column) -> Column:
        crossing = F.filter(sides, lambda e: (e["ax"] > x) != (e["bx"] > x))
        return _spans(F.array_sort(F.transform(crossing, lambda e: e["ay"] + (x - e["ax"]) / (e["bx"] - e["ax"]) * (e["by"] - e["ay"]))))

    def common(x: Column) -> Column:
        both = lambda s, t: F.greatest(F.least(s["hi"], t["hi"]) - F.greatest(s["lo"], t["lo"]), F.lit(0.0))
        return _sum(F.transform(spans(a, x), lambda s: _sum(F.transform(spans(b, x), lambda t: both(s, t)))))

    slabs = lambda xs: F.zip_with(F.slice(xs, 1, F.greatest(F.size(xs) - 1, F.lit(0))), F.slice(xs, 2, F.greatest(F.size(xs) - 1, F.lit(1))), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    total = lambda xs: _sum(F.transform(F.filter(slabs(xs), lambda s: s["q"].isNotNull()), lambda s: (s["q"] - s["p"]) * common((s["p"] + s["q"]) / 2)))
    return F.get(F.transform(F.array(places), total), F.lit(0))
