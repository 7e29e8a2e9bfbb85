"""Column functions on planar coordinates, angles, speeds and tiles."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def axis_diff(a: Column, b: Column) -> Column:
    """Difference of two undirected axes, 0 to 90 degrees."""
    return F.abs(F.pmod(a - b + 90, F.lit(180.0)) - 90)


def bearing(dx: Column, dy: Column) -> Column:
    """Degrees clockwise from north, 0 to 360."""
    return F.pmod(F.degrees(F.atan2(dx, dy)), F.lit(360.0))


def chord_bearing(s: Column, x: Column, y: Column, group: list[str], half: float) -> Column:
    """Bearing of the chord from the first to the last sample within ``half`` of a row along its line, by chainage ``s`` to a thousandth; null where the window has no
    length (F10)."""
    reach = round(half * 1000)
    w = Window.partitionBy(*group).orderBy(F.round(s * 1000).cast("long")).rangeBetween(-reach, reach)
    dx, dy = F.last(x).over(w) - F.first(x).over(w), F.last(y).over(w) - F.first(y).over(w)
    return F.when((dx != 0) | (dy != 0), bearing(dx, dy))


def rotate(x: Column, y: Column, degrees: Column) -> tuple[Column, Column]:
    """(along, across) to (x, y) for a heading clockwise from north."""
    a = F.radians(degrees)
    return x * F.sin(a) + y * F.cos(a), x * F.cos(a) - y * F.sin(a)


def stop_penalty(v: Column, accelerate: float = 0.5, brake: float = 0.5, dwell: float = 120.0) -> Column:
    """Seconds that a stop costs at speed v in m/s: v / 2a + v / 2b + dwell."""
    return v / (2 * accelerate) + v / (2 * brake) + dwell


def grade_force(mass: Column, per_mille: Column, v: Column) -> tuple[Column, Column]:
    """Force in kN of a mass in t on a grade, and its power in kW at v m/s."""
    force = mass * 9.80665 * per_mille / 1000
    return force, force * v


def tangent_fit(radius: Column, delta: Column, before: Column, after: Column) -> dict[str, Column]:
    """Arc, tangent, detour of the corner, and whether both chords are long enough for the tangent (F13). delta in radians."""
    tangent = radius * F.tan(delta / 2)
    return {"arc_m": radius * delta, "tangent_m": tangent, "dogleg_m": 2 * tangent - radius * delta, "fits": (tangent <= before) & (tangent <= after)}


def quadrant(lon: Column, lat: Column, lon0: Column, lat0: Column) -> tuple[Column, Column]:
    """(distance in km on an equirectangular plane, compass quadrant) from a reference point."""
    dx = (lon - lon0) * F.cos(F.radians(lat0)) * 111.32
    dy = (lat - lat0) * 110.574
    name = F.concat(F.when(dy >= 0, "N").otherwise("S"), F.when(dx >= 0, "E").otherwise("W"))
    return F.hypot(dx, dy), name


def snap(v: Column, width: float) -> Column:
    """Centre of the grid cell that holds v."""
    return F.floor(v / width) * width + width / 2


def tile_of(x: Column, y: Column, width: float = 1000.0, col0: int = 200, row0: int = 301) -> Column:
    """'col-row' of the tile that holds a point."""
    return F.concat_ws("-", (F.floor(x / width) + col0).cast("string"), (F.floor(y / width) + row0).cast("string"))


def tile_bounds(tile: Column, width: float = 1000.0, col0: int = 200, row0: int = 301) -> tuple[Column, Column, Column, Column]:
    """(xmin, ymin, xmax, ymax) of a tile's id."""
    x = (F.split(tile, "-")[0].cast("long") - col0) * width
    y = (F.split(tile, "-")[1].cast("long") - row0) * width
    return x, y, x + width, y + width


def segment_distance(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """(distance, share along) of the nearest point on a segment; a point segment has share 0."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = F.when(length2 > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / length2))).otherwise(F.lit(0.0))
    return F.hypot(px - ax - t * dx, py - ay - t * dy), t


#: Half-axis, flattening, scale and origins (degrees, metres) of the planar systems.
ELLIPSOID = (6378137.0, 1 / 298.257222101)
SYSTEMS = {3763: (1.0, -8.133108333333334, 39.66825833333333, 0.0, 0.0), 25830: (0.9996, -3.0, 0.0, 500000.0, 0.0)}


def to_tm(lon: Column, lat: Column, code: int) -> tuple[Column, Column]:
    """Longitude and latitude in degrees to transverse Mercator (x, y) by the series in the third flattening, to n^3."""
    a, f = ELLIPSOID
    k0, lon0, lat0, x0, y0 = SYSTEMS[code]
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    origin = math.sinh(math.atanh(math.sin(math.radians(lat0))) - e * math.atanh(e * math.sin(math.radians(lat0))))
    xi0 = math.atan(origin)
    m0 = radius * (xi0 + sum(alpha[j] * math.sin(2 * (j + 1) * xi0) for j in range(3)))
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    d = F.radians(lon - lon0)
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j in range(3):
        east = east + alpha[j] * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta)
        north = north + alpha[j] * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta)
    return x0 + k0 * radius * east, y0 + k0 * radius * north - k0 * m0


def from_tm(x: Column, y: Column, code: int) -> tuple[Column, Column]:
    """Transverse Mercator (x, y) back to longitude and latitude in degrees, by the inverse series to n^3."""
    a, f = ELLIPSOID
    k0, lon0, lat0, x0, y0 = SYSTEMS[code]
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    e = 2 * math.sqrt(n) / (1 + n)
    xi0 = math.atan(math.sinh(math.atanh(math.sin(math.radians(lat0))) - e * math.atanh(e * math.sin(math.radians(lat0)))))
    m0 = radius * (xi0 + sum(alpha[j] * math.sin(2 * (j + 1) * xi0) for j in range(3)))
    north, east = ((y - y0) / k0 + m0) / radius, (x - x0) / (k0 * radius)
    xi, eta = north, east
    for j in range(3):
        xi = xi - beta[j] * F.sin(2 * (j + 1) * north) * F.cosh(2 * (j + 1) * east)
        eta = eta - beta[j] * F.cos(2 * (j + 1) * north) * F.sinh(2 * (j + 1) * east)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for j in range(3):
        lat = lat + delta[j] * F.sin(2 * (j + 1) * chi)
    return lon0 + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def quintic(p0: tuple, p1: tuple, t0: tuple, t1: tuple, t: Column) -> tuple[Column, Column, Column]:
    """(x, y, curvature) at t of the quintic between two points with given tangents and no curvature at its ends (F16)."""
    h = [1 - 10 * t**3 + 15 * t**4 - 6 * t**5, t - 6 * t**3 + 8 * t**4 - 3 * t**5, 10 * t**3 - 15 * t**4 + 6 * t**5, -4 * t**3 + 7 * t**4 - 3 * t**5]
    d1 = [-30 * t**2 + 60 * t**3 - 30 * t**4, 1 - 18 * t**2 + 32 * t**3 - 15 * t**4, 30 * t**2 - 60 * t**3 + 30 * t**4, -12 * t**2 + 28 * t**3 - 15 * t**4]
    d2 = [-60 * t + 180 * t**2 - 120 * t**3, -36 * t + 96 * t**2 - 60 * t**3, 60 * t - 180 * t**2 + 120 * t**3, -24 * t + 84 * t**2 - 60 * t**3]
    at = lambda w, i: w[0] * p0[i] + w[1] * t0[i] + w[2] * p1[i] + w[3] * t1[i]
    dx, dy, ddx, ddy = at(d1, 0), at(d1, 1), at(d2, 0), at(d2, 1)
    speed2 = dx * dx + dy * dy
    return at(h, 0), at(h, 1), F.when(speed2 > 0, (dx * ddy - dy * ddx) / F.pow(speed2, 1.5))


def quintic_length(p0: tuple, p1: tuple, t0: tuple, t1: tuple, steps: int = 200) -> Column:
    """Length of that quintic, as the sum of ``steps`` chords between even values of t (F16). Rows are taken in arrays, some thousand at once."""
    h = np.linspace(0.0, steps, steps + 1) / steps
    weights = np.stack([1 - 10 * h**3 + 15 * h**4 - 6 * h**5, h - 6 * h**3 + 8 * h**4 - 3 * h**5, 10 * h**3 - 15 * h**4 + 6 * h**5, -4 * h**3 + 7 * h**4 - 3 * h**5])
    # Chords are differences of the weights: what cancels between two ends is not added first.
    chord = np.diff(weights, axis=1)

    def lengths(*columns: pd.Series) -> pd.Series:
        values = np.stack([c.to_numpy(float, na_value=np.nan) for c in columns])
        total = np.empty(values.shape[1])
        for k in range(0, len(total), 4096):
            part = values[:, k : k + 4096]
            total[k : k + 4096] = np.hypot(part[0::2].T @ chord, part[1::2].T @ chord).sum(axis=1)
        return pd.Series(total)

    measured = F.pandas_udf(lengths, "double")(*[c.cast("double") for p in (p0, t0, p1, t1) for c in p])
    return F.nanvl(measured, F.lit(None).cast("double"))
