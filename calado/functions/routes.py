"""Cheapest paths and their alternatives in arrays, on parts of a lattice that one task holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def least_linked(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` nodes the least one that edges ``a`` - ``b``, in any direction, link it to."""
    least = np.arange(n)
    while True:
        low, now = np.minimum(least[a], least[b]), least.copy()
        np.minimum.at(now, least[a], low)
        np.minimum.at(now, least[b], low)
        while not np.array_equal(now, now[now]):
            now = now[now]
        if np.array_equal(now, least):
            return least
        least = now


def _repeated(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. (counts[0] of them), starts[1], .."""
    return np.arange(counts.sum()) + np.repeat(starts - np.cumsum(counts) + counts, counts)


class Names:
    """Nodes numbered in order of their names."""

    def __init__(self, *columns: pa.ChunkedArray) -> None:
        names = pc.unique(pa.chunked_array([chunk for c in columns for chunk in c.chunks], pa.string()))
        self.names = names.take(pc.sort_indices(names))

    def numbers(self, names: pa.ChunkedArray) -> np.ndarray:
        return pc.index_in(names, self.names).to_numpy().astype(np.int64)


class Lattice(Names):
    """Edges (a, b, cost_0, cost_1, .., null where a price lacks the edge) between nodes named ``x,y``, by price and start."""

    def __init__(self, edges: pa.Table, ends: pa.Table, prices: int) -> None:
        super().__init__(edges["a"], edges["b"], ends["start"], ends["end"])
        self.n = n = len(self.names)
        self.index = {name: i for i, name in enumerate(self.names.to_pylist())}
        self.x, self.y = (np.array(v, float) for v in (zip(*map(_place, self.index), strict=True) if n else ([], [])))
        a, b = (self.numbers(edges[k]) for k in ("a", "b"))
        part = least_linked(a, b, n)
        order = np.argsort(part, kind="stable")
        first = np.searchsorted(part[order], np.arange(n))
        self.part, self.size, self.local = part, np.bincount(part, minlength=n), np.empty(n, np.int64)
        self.local[order] = np.arange(n) - first[part[order]]
        cost = [edges[f"cost_{m}"].to_numpy() for m in range(prices)]
        at = [np.flatnonzero(~np.isnan(c)) for c in cost]
        key = np.concatenate([m * n + a[i] for m, i in enumerate(at)])
        to, step = np.concatenate([b[i] for i in at]), np.concatenate([c[i] for c, i in zip(cost, at, strict=True)])
        order = np.lexsort((step, to, key))
        key, to, step = key[order], to[order], step[order]
        once = np.ones(len(key), bool)
        once[1:] = (key[1:] != key[:-1]) | (to[1:] != to[:-1])
        self.to, self.step, self.starts = to[once], step[once], np.searchsorted(key[once], np.arange(prices * n + 1))
        some = int(self.starts[n])
        self.hops, self.lengths = key[once][:some] * n + self.to[:some], self.step[:some]

    def length(self, path: np.ndarray) -> float:
        """The sum of the first price along a path; an edge that it lacks adds nothing."""
        hops = path[:-1] * self.n + path[1:]
        at = np.minimum(np.searchsorted(self.hops, hops), max(len(self.hops) - 1, 0))
        return float(sum(self.lengths[at[self.hops[at] == hops]].tolist())) if len(self.hops) else 0.0

    def cheapest(self, start: np.ndarray, end: np.ndarray, price: np.ndarray, tolled: list[np.ndarray], toll: np.ndarray, rounds: int = 10_000, most: int = 1 << 21) -> list[np.ndarray | None]:
        """The cheapest path of each search, None where it does not reach its end; ``tolled`` nodes cost ``toll`` more to enter.

        As in ``graph.shortest_paths`` nodes whose cost fell send it along their edges, and the least offer wins, ties by the path's names, until
        no cost below the end's falls. Searches go on together, as many as have ``most`` nodes."""
        found: list[np.ndarray | None] = [None] * len(start)
        held = np.flatnonzero(self.part[start] == self.part[end]) if len(start) else np.zeros(0, np.int64)
        group = np.cumsum(self.size[self.part[start[held]]]) // most
        for g in np.unique(group):
            own = held[group == g]
            for i, path in zip(own, self._searched(start[own], end[own], price[own], [tolled[i] for i in own], toll[own], rounds), strict=True):
                found[i] = path
        return found

    def _searched(self, start: np.ndarray, end: np.ndarray, price: np.ndarray, tolled: list[np.ndarray], toll: np.ndarray, rounds: int) -> Iterator[np.ndarray | None]:
        size = self.size[self.part[start]]
        base = np.cumsum(size) - size
        cost, extra = np.full(size.sum(), np.inf), np.zeros(size.sum())
        for s, nodes in enumerate(tolled):
            extra[base[s] + self.local[nodes]] = toll[s]
        search, node, rank = np.arange(len(start)), start, np.zeros(len(start), np.int64)
        last = base + self.local[end]
        cost[base + self.local[start]] = 0.0
        reached = np.where(start == end, 0, -1)
        place = np.where(start == end, search, 0)
        sent = [(node, search)]
        while len(node):
            key = price[search] * self.n + node
            count = self.starts[key + 1] - self.starts[key]
            edge, source = _repeated(self.starts[key], count), np.repeat(np.arange(len(node)), count)
            to, by = self.to[edge], search[source]
            at = base[by] + self.local[to]
            offer = cost[base[by] + self.local[node[source]]] + self.step[edge] + extra[at]
            # Offers above the end's cost cannot make it fall; the margin is far above the steps of 1e-12 that do not count.
            better = np.flatnonzero((offer < cost[at] - 1e-12) & (offer <= cost[last[by]] + 1e-6))
            better = better[np.lexsort((rank[source[better]], offer[better], at[better]))]
            better = better[np.flatnonzero(np.diff(at[better], prepend=-1))]
            cost[at[better]] = offer[better]
            # Paths of a round are equally long: they come in order of the path before and the node's name.
            better = better[np.lexsort((to[better], rank[source[better]]))]
            search, node, rank = by[better], to[better], np.arange(len(better))
            if len(node):
                if len(sent) > rounds:
                    raise ValueError(f"costs still fall after {rounds} rounds")
                ends = np.flatnonzero(at[better] == last[search])
                reached[search[ends]], place[search[ends]] = len(sent), ends
                sent.append((node, source[better]))
        for s in range(len(start)):
            if reached[s] < 0:
                yield None
                continue
            path, i = np.empty(reached[s] + 1, np.int64), place[s]
            for k in range(reached[s], -1, -1):
                path[k], i = sent[k][0][i], sent[k][1][i]
            yield path

    def middle(self, path: np.ndarray) -> np.ndarray:
        """The nodes of a path whose projection on the line from its start to its end lies from 0.18 to 0.82 of it."""
        x, y = self.x[path], self.y[path]
        dx, dy = x[-1] - x[0], y[-1] - y[0]
        with np.errstate(all="ignore"):
            along = ((x - x[0]) * dx + (y - y[0]) * dy) / (dx * dx + dy * dy)
        return path[(along >= 0.18) & (along <= 0.82)]

    def far_share(self, middle: np.ndarray, other: np.ndarray, far: float) -> float:
        """Share of a path's middle nodes that lie ``far`` or more from the line through another's nodes; 0 without middle nodes."""
        if not len(middle):
            return 0.0
        px, py, ax, ay = self.x[middle, None], self.y[middle, None], self.x[other], self.y[other]
        dx, dy = np.append(ax[1:], ax[-1]) - ax, np.append(ay[1:], ay[-1]) - ay
        length2 = dx * dx + dy * dy
        t = np.clip(((px - ax) * dx + (py - ay) * dy) / np.where(length2 > 0, length2, 1.0), 0.0, 1.0)
        away = np.hypot(px - ax - t * dx, py - ay - t * dy).min(axis=1)
        return int((away >= far).sum()) / len(middle)

    def beside(self, paths: list[np.ndarray]) -> np.ndarray:
        """Nodes of the 3 x 3 cells around the middle of paths."""
        cells = {(int(self.x[p] + i), int(self.y[p] + j)) for path in paths for p in self.middle(path) for i in (-1, 0, 1) for j in (-1, 0, 1)}
        return np.array([i for i in (self.index.get(f"{x},{y}") for x, y in cells) if i is not None], np.int64)

    def alternatives(
        self, start: np.ndarray, end: np.ndarray, k: int, tries: list[tuple[int, float]], max_jaccard: float, max_length: float, far: float, min_far: float, together: int = 6
    ) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """Per pair of ends the accepted paths: (nodes, length, jaccard, far_share). ``tries`` are (price, toll); some are searched together, and the first
        good one counts."""
        none = np.zeros(0, np.int64)
        base = self.cheapest(start, end, np.zeros(len(start), np.int64), [none] * len(start), np.zeros(len(start)))
        found = [[] if p is None else [(p, self.length(p), 0.0, 1.0)] for p in base]
        todo, nxt = [q for q, f in enumerate(found) if f and k > 1 and tries], [0] * len(found)
        tolled = {q: self.beside([found[q][0][0]]) for q in todo}
        while todo:
            wanted = [(q, i) for q in todo for i in range(nxt[q], min(nxt[q] + together, len(tries)))]
            at = np.array([q for q, _ in wanted])
            paths = self.cheapest(start[at], end[at], np.array([tries[i][0] for _, i in wanted]), [tolled[q] for q, _ in wanted], np.array([tries[i][1] for _, i in wanted]))
            accepted = set()
            for (q, i), path in zip(wanted, paths, strict=True):
                if q in accepted:
                    continue
                nxt[q] = i + 1
                if path is None:
                    continue
                own, middle, length, old = set(path.tolist()), self.middle(path), self.length(path), [f[0] for f in found[q]]
                jaccard = max(len(own & o) / len(own | o) for o in (set(p.tolist()) for p in old))
                if jaccard > max_jaccard or length > max_length * found[q][0][1]:
                    continue
                share = min(self.far_share(middle, p, far) for p in old)
                if share >= min_far:
                    accepted.add(q)
                    found[q].append((path, length, jaccard, share))
                    tolled[q] = self.beside([*old, path])
            todo = [q for q in todo if len(found[q]) < k and nxt[q] < len(tries)]
        return found


def _place(name: str) -> tuple[float, float]:
    x, y = name.split(",")[:2]
    return float(x), float(y)
