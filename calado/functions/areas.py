"""Many polygons at once in arrays: which come into a box, which hold a place, and common areas by signed sides.

For these a polygon is the sum of the regions below its sides, +1 where it lies below a side and -1 where above, so the area common to two is a sum over pairs of
sides of what lies below both. Nothing is sorted, and sides on each other need no care.
"""

from __future__ import annotations

import numpy as np


def _cuts(sides: np.ndarray) -> np.ndarray:
    """Share along each side (n, k) where each other (n, k) of the same polygon meets it between its ends, else nan: (n, k, k)."""
    ax, ay, bx, by = (sides[:, :, None, i] for i in range(4))
    cx, cy, ex, ey = (sides[:, None, :, i] for i in range(4))
    dx, dy, ux, uy, wx, wy = bx - ax, by - ay, ex - cx, ey - cy, cx - ax, cy - ay
    with np.errstate(all="ignore"):
        det = dx * uy - dy * ux
        t, u = (wx * uy - wy * ux) / det, (wx * dy - wy * dx) / det
    return np.where((det != 0) & (t > 1e-9) & (t < 1 - 1e-9) & (u > -1e-9) & (u < 1 + 1e-9), t, np.nan)


def _signs(sides: np.ndarray) -> np.ndarray:
    """(n, k) of polygons (n, k, 4) whose sides meet at ends only: 1 where the inside, by parity, lies below a side, -1 where above; sides on each other share it; upright ones have 0."""
    ax, ay, bx, by = (sides[:, None, :, i] for i in range(4))
    x, y = ((sides[:, :, i] + sides[:, :, i + 2])[:, :, None] / 2 for i in (0, 1))
    with np.errstate(all="ignore"):
        off = np.where((ax > x) != (bx > x), ay + (x - ax) / (bx - ax) * (by - ay) - y, np.nan)
    on = np.abs(off) <= 1e-10 * np.ptp(sides.reshape(len(sides), -1, 2), axis=1).max(axis=1)[:, None, None]
    above, same = np.count_nonzero((off > 0) & ~on, axis=2), np.maximum(np.count_nonzero(on, axis=2), 1)
    return np.where((same % 2 == 1) & (sides[:, :, 0] != sides[:, :, 2]), np.where(above % 2 == 0, 1.0, -1.0), 0.0) / same


def signed(shapes: list[np.ndarray]) -> list[np.ndarray]:
    """Of each polygon (its sides, rows ax, ay, bx, by) the sides from left to right with their sign: rows x0, y0, x1, y1, sign. Holes, parts and crossing sides by
    parity; sides without a place count as none."""
    out: list = [np.empty((0, 5))] * len(shapes)
    shapes = [s[np.isfinite(s).all(axis=1)] for s in shapes]
    by_size: dict[int, list[int]] = {}
    for i, s in enumerate(shapes):
        by_size.setdefault(len(s), []).append(i)
    for k, ids in by_size.items():
        step = max(1, 500_000 // (k * k or 1))
        for c in range(0, len(ids) if k else 0, step):
            part = ids[c : c + step]
            sides = np.stack([shapes[i] for i in part])
            # Near its own corner, so that small shapes far out lose nothing.
            low = np.minimum(sides[:, :, :2], sides[:, :, 2:]).min(axis=1)
            near = sides - np.tile(low, 2)[:, None]
            cuts = _cuts(near)
            crossed = np.isfinite(cuts).any(axis=(1, 2))
            sign = _signs(near)
            for j, i in enumerate(part):
                rows, weight = sides[j], sign[j]
                if crossed[j]:
                    ends = [np.unique(np.r_[0.0, t[np.isfinite(t)], 1.0]) for t in cuts[j]]
                    at = np.concatenate([np.stack([t[:-1], t[1:]], axis=1) for t in ends])
                    of = np.repeat(np.arange(k), [len(t) - 1 for t in ends])
                    a, d = near[j][of, :2], near[j][of, 2:] - near[j][of, :2]
                    pieces = np.concatenate([a + at[:, :1] * d, a + at[:, 1:] * d], axis=1)
                    rows, weight = pieces + np.tile(low[j], 2), _signs(pieces[None])[0]
                keep = weight != 0
                rows, weight = rows[keep], weight[keep]
                turned = rows[:, 0] > rows[:, 2]
                rows[turned] = rows[turned][:, [2, 3, 0, 1]]
                out[i] = np.column_stack([rows, weight])
    return out


def below(sides: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Area of each polygon of signed ``sides``, given the places of their first ones."""
    y = np.add.reduceat(sides[:, 1], starts) / np.diff(np.r_[starts, len(sides)])
    mean = (sides[:, 1] + sides[:, 3]) / 2 - np.repeat(y, np.diff(np.r_[starts, len(sides)]))
    return np.add.reduceat(sides[:, 4] * (sides[:, 2] - sides[:, 0]) * mean, starts)


def common(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray) -> np.ndarray:
    """Areas common to each polygon of ``a`` and each of ``b``, signed sides with the places of their first ones."""
    low = a[:, :4].reshape(-1, 2).min(axis=0)
    ax0, ay0, ax1, ay1 = ((a[:, i] - low[i % 2])[:, None] for i in range(4))
    bx0, by0, bx1, by1 = (b[:, i] - low[i % 2] for i in range(4))
    rise_a, rise_b = (ay1 - ay0) / (ax1 - ax0), (by1 - by0) / (bx1 - bx0)
    lo, hi = np.maximum(ax0, bx0), np.minimum(ax1, bx1)
    width = np.maximum(hi - lo, 0.0)
    a_lo, a_hi, b_lo, b_hi = ay0 + rise_a * (lo - ax0), ay0 + rise_a * (hi - ax0), by0 + rise_b * (lo - bx0), by0 + rise_b * (hi - bx0)
    d_lo, d_hi = a_lo - b_lo, a_hi - b_hi
    both = np.abs(d_lo) + np.abs(d_hi)
    with np.errstate(all="ignore"):
        apart = np.where(d_lo * d_hi < 0, (d_lo * d_lo + d_hi * d_hi) / both, both)
    # The lower of two lines is their mean less half of what they are apart.
    part = a[:, 4, None] * b[:, 4] * width * ((a_lo + a_hi + b_lo + b_hi) - apart)
    return np.add.reduceat(np.add.reduceat(part, a_starts, axis=0), b_starts, axis=1) / 4


def boxed(sides: np.ndarray, box: tuple[float, float, float, float]) -> tuple[np.ndarray, np.ndarray]:
    """Which ``sides`` (rows ax, ay, bx, by) come into a box, and which a ray from there along x may cross."""
    ax, ay, bx, by = sides.T
    x0, y0, x1, y1 = box
    level = (np.maximum(ay, by) >= y0) & (np.minimum(ay, by) <= y1) & (np.maximum(ax, bx) >= x0)
    off = [(bx - ax) * (y - ay) - (by - ay) * (x - ax) for x in (x0, x1) for y in (y0, y1)]
    return level & (np.minimum(ax, bx) <= x1) & (np.minimum.reduce(off) <= 0) & (np.maximum.reduce(off) >= 0), level


def crossed(x: np.ndarray, y: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Whether rays from places along x cross sides, a last axis of them."""
    ax, ay, bx, by = sides.T
    with np.errstate(all="ignore"):
        return ((ay > y[..., None]) != (by > y[..., None])) & (x[..., None] < ax + (y[..., None] - ay) / (by - ay) * (bx - ax))


def odd(x: np.ndarray, y: np.ndarray, sides: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether places lie inside polygons, a last axis of them, by parity; ``starts`` are the places of their first sides."""
    return np.bitwise_xor.reduceat(crossed(x, y, sides), starts, axis=-1)
