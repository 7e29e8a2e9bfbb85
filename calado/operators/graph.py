"""Lattice graphs: nodes and edges, shortest paths in rounds of joins, alternatives, chains and modules."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from calado.functions.geometry import segment_distance
from calado.functions.routes import Lattice, Names, least_linked
from calado.operators.joins import by_count
from calado.operators.storage import checkpointed, deleted, stored

#: Steps to the neighbours of a lattice cell.
FOUR = [(-1, 0), (1, 0), (0, -1), (0, 1)]
EIGHT = FOUR + [(-1, -1), (-1, 1), (1, -1), (1, 1)]


def node_id(x: Column, y: Column) -> Column:
    return F.concat_ws(",", x.cast("long").cast("string"), y.cast("long").cast("string"))


def lattice_nodes(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """The cells (x, y, ...) all four tiles (tx, ty, tile_id) of which exist, with ``tile_ids`` by row and then column.

    Cell (x, y) holds tiles (2x, 2y) to (2x + 1, 2y + 1). Of tiles at one place the least id counts; a tile without an id is none.
    """
    place = [F.struct(F.lit(2 * j + i).alias("_i"), (2 * F.col("x") + i).alias("tx"), (2 * F.col("y") + j).alias("ty")) for j in (0, 1) for i in (0, 1)]
    known = tiles.where("tile_id IS NOT NULL").groupBy("tx", "ty").agg(F.min("tile_id").alias("_id"))
    need = cells.select("x", "y").distinct().select("x", "y", F.explode(F.array(*place)).alias("_t")).select("x", "y", "_t.*")
    held = need.join(known, ["tx", "ty"]).groupBy("x", "y").agg(F.array_sort(F.collect_list(F.struct("_i", "_id"))).alias("_ids")).where(F.size("_ids") == 4)
    return cells.join(held.select("x", "y", F.transform("_ids", lambda t: t["_id"]).alias("tile_ids")), ["x", "y"])


def lattice(cells: DataFrame, mode: str, steps: list[tuple[int, int]] = EIGHT) -> DataFrame:
    """Edges (a, b, cost) between neighbouring cells (x, y, z, relief).

    Costs: ``distance`` the length; ``relief`` length times 1 + mean relief; ``terrain`` length plus the height step;
    ``balanced`` the mean of relief and terrain. ``short`` and ``road`` count steps: 1, a share of the relief of the cell entered and of
    the height step, and for ``road`` a share of that cell's distance to a road (``road``, up to 4,000; null counts nothing). Cells without
    ground are no nodes.
    """
    nodes = cells.where("z IS NOT NULL")
    near = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in steps])).alias("_o")
    left = nodes.select("x", "y", "z", "relief", near).select(F.col("x"), F.col("y"), F.col("z"), F.col("relief"), (F.col("x") + F.col("_o.i")).alias("bx"), (F.col("y") + F.col("_o.j")).alias("by"))
    road = F.col("road").cast("double") if mode == "road" else F.lit(None).cast("double")
    right = nodes.select(F.col("x").alias("bx"), F.col("y").alias("by"), F.col("z").alias("_z"), F.col("relief").alias("_r"), road.alias("_road"))
    length = F.hypot(F.col("bx") - F.col("x"), F.col("by") - F.col("y"))
    relief = length * (1 + (F.col("relief") + F.col("_r")) / 2)
    terrain = length + F.abs(F.col("z") - F.col("_z"))
    rise = F.abs(F.col("z") - F.col("_z"))
    # Shares of relief, of the height step, and of the distance to a road.
    short = 1 + 0.0007 * F.col("_r") + 0.0002 * rise
    near_road = 1 + 0.004 * F.col("_r") + 0.001 * rise + F.when(F.col("_road").isNotNull(), 0.0004 * F.least("_road", F.lit(4000.0))).otherwise(0.0)
    cost = {"distance": length, "relief": relief, "terrain": terrain, "balanced": (relief + terrain) / 2, "short": short, "road": near_road}[mode]
    return left.join(by_count(right), ["bx", "by"]).select(node_id(F.col("x"), F.col("y")).alias("a"), node_id(F.col("bx"), F.col("by")).alias("b"), cost.alias("cost"))


def shortest_paths(edges: DataFrame, queries: DataFrame, rounds: int = 10_000, by: tuple[str, ...] = (), tolls: DataFrame | None = None) -> DataFrame:
    """(q, node, cost, path) of the cheapest path from each query's start to every node it reaches.

    All queries are relaxed together: the nodes whose cost fell send it along their edges, and the least offer wins, ties
    by the path's names. It stops when no cost falls; where one still would after ``rounds`` rounds, that is an error.
    Costs are not negative; nodes that edges do not name are never crossed.
    Rows hold their path, which is as long as the route, so that no second pass has to trace it back. A round's rows go when the next are written.
    ``by`` are columns of edges and queries, which must agree (a kind of cost, say); ``tolls`` (q, node, toll) are added to
    the cost of entering a node, for one query.
    """
    key = ["q", *by]
    steps = edges.select(*by, F.col("a").alias("node"), "b", F.col("cost").alias("_step"))
    zero = queries.select(*key, F.col("start").alias("node"), F.lit(0.0).alias("cost"), F.array("start").alias("path"))
    best, path = stored(zero)
    frontier = best
    for done in range(rounds + 1):
        sent = frontier.join(steps, [*by, "node"]).select(*key, F.col("b").alias("node"), (F.col("cost") + F.col("_step")).alias("offer"), F.concat("path", F.array("b")).alias("via"))
        if tolls is not None:
            sent = sent.join(tolls, ["q", "node"], "left").withColumn("offer", F.col("offer") + F.coalesce("toll", F.lit(0.0)))
        least = sent.groupBy(*key, "node").agg(F.min(F.struct("offer", "via")).alias("_m")).select(*key, "node", "_m.offer", "_m.via")
        better = F.col("offer").isNotNull() & (F.col("cost").isNull() | (F.col("offer") < F.col("cost") - 1e-12))
        met = best.join(least, [*key, "node"], "full_outer")
        now, new = stored(met.select(*key, "node", F.when(better, F.col("offer")).otherwise(F.col("cost")).alias("cost"), F.when(better, F.col("via")).otherwise(F.col("path")).alias("path"), better.alias("_new")))
        deleted(edges.sparkSession, path)
        path = new
        best, frontier = now.drop("_new"), now.where("_new").drop("_new")
        if not frontier.limit(1).count():
            return best
        if done == rounds:
            raise ValueError(f"costs still fall after {rounds} rounds")


def _place(node: Column) -> tuple[Column, Column]:
    parts = F.split(node, ",")
    return parts[0].cast("double"), parts[1].cast("double")


def _middle(nodes: Column) -> Column:
    """The nodes of a path whose projection on the line from its start to its end lies from 0.18 to 0.82 of it."""
    (ax, ay), (bx, by) = _place(F.element_at(nodes, 1)), _place(F.element_at(nodes, -1))
    along = lambda n: ((_place(n)[0] - ax) * (bx - ax) + (_place(n)[1] - ay) * (by - ay)) / F.nullif((bx - ax) ** 2 + (by - ay) ** 2, F.lit(0.0))
    return F.filter(nodes, lambda n: along(n).between(0.18, 0.82))


def _far_share(nodes: Column, other: Column, far: float) -> Column:
    """Share of a path's middle nodes that lie ``far`` or more from the line through another's nodes; 0 without middle nodes."""

    def away(node: Column) -> Column:
        x, y = _place(node)
        sides = F.transform(other, lambda n, i: segment_distance(x, y, *_place(n), *_place(F.coalesce(F.get(other, i + 1), n)))[0])
        return F.array_min(sides)

    middle = _middle(nodes)
    return F.coalesce(F.size(F.filter(middle, lambda n: away(n) >= far)) / F.nullif(F.size(middle), F.lit(0)), F.lit(0.0))


def lattice_parts(edges: DataFrame, tile: int = 256) -> DataFrame:
    """(node, part): the least node, by name, of those that edges (a, b) in any direction link with each other.

    Nodes are named ``x,y``. Squares of ``tile`` x ``tile`` cells are linked in one task each; only their parts that share a node meet in rounds.
    """
    x, y = _place(F.col("a"))
    tiles = edges.select("a", "b", F.floor(x / tile).alias("_tx"), F.floor(y / tile).alias("_ty"))

    def linked(group: pa.Table) -> pa.Table:
        own = Names(group["a"], group["b"])
        least = least_linked(own.numbers(group["a"]), own.numbers(group["b"]), len(own.names))
        return pa.table({"node": own.names, "part": own.names.take(pa.array(least))})

    held, path = stored(tiles.groupBy("_tx", "_ty").applyInArrow(linked, "node string, part string"))
    shared = held.groupBy("node").agg(F.array_sort(F.collect_set("part")).alias("_p")).where(F.size("_p") > 1)
    links, kept = stored(shared.select(F.explode(F.slice("_p", F.lit(2), F.size("_p") - 1)).alias("u"), F.element_at("_p", 1).alias("v")).distinct())
    if links.limit(1).count():
        roots = _roots(links, kept)
        held = held.join(by_count(roots.select(F.col("u").alias("part"), "v")), "part", "left").select("node", F.coalesce("v", "part").alias("part"))
    out = stored(held.groupBy("node").agg(F.min("part").alias("part")))[0]
    deleted(edges.sparkSession, path)
    return out


def _roots(links: DataFrame, path: str) -> DataFrame:
    """(u, v): the least name v that links (u, v), v < u, lead u to, by large-star and small-star rounds; ``links`` are stored at ``path``."""
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(low.hint("merge"), F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt, new = stored(small.unionByName(low.select(F.col("n").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct())
        deleted(links.sparkSession, path)
        links, path = nxt, new
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == state:
            return links
        state = now


def alternatives(
    edges: dict[str, DataFrame], queries: DataFrame, k: int = 3, attempts: int = 24, toll: float = 1.0, rise: float = 1.25, max_jaccard: float = 0.68, max_length: float = 1.48,
    far: float = 2.0, min_far: float = 0.19, most_nodes: int = 1 << 17,
) -> DataFrame:
    """Up to ``k`` spatially distinct paths per query: (q, variant, nodes, cost, jaccard, far_share).

    ``edges`` are prices by name on one lattice; the first one's measure length. Its cheapest path is variant 0. Attempts take the
    other prices and then the first in turn; each turn adds ``rise`` to the ``toll`` on the 3 x 3 cells around the middle of
    every path accepted so far. An attempt is accepted if the Jaccard of its nodes with each accepted path is at most
    ``max_jaccard``, at least ``min_far`` of its middle lies ``far`` cells from each, and its length is at most ``max_length`` times
    the first. Attempts between two acceptances do not depend on each other, so all that are left run together and the first good
    one of each query counts; then those after it run again with its tolls. Nodes are named ``x,y``; an edge without a cost is none.

    A query needs only the part of the lattice that hangs together with its start, so parts of up to ``most_nodes`` nodes are dealt to groups of some
    thousand nodes, each of which is searched with all its queries in arrays, in one pass. Larger parts take rounds of joins (``shortest_paths``).
    """
    names = list(edges)
    priced = None
    for name in names:
        one = edges[name].select(F.lit(name).alias("mode"), "a", "b", "cost").where("a IS NOT NULL AND b IS NOT NULL AND cost IS NOT NULL AND NOT isnan(cost)")
        priced = one if priced is None else priced.unionByName(one)
    spark, limits = queries.sparkSession, (max_jaccard, max_length, far, min_far)
    wide, path = stored(priced.groupBy("a", "b").agg(*[F.min(F.when(F.col("mode") == name, F.col("cost"))).cast("double").alias(f"cost_{i}") for i, name in enumerate(names)]))
    parts = lattice_parts(wide)
    sizes = parts.groupBy("part").agg(F.count(F.lit(1)).alias("_n"))
    large = checkpointed(sizes.where(F.col("_n") > most_nodes).select("part"))
    n = math.ceil((parts.count() or 1) / 8192)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n, 10_000))
    group = F.pmod(F.xxhash64("part"), F.lit(n)).cast("int").alias("_g")
    found = None
    rounds = bool(large.limit(1).count())
    if rounds:
        parts = parts.join(large.withColumn("_large", F.lit(True)), "part", "left")
        far_on = by_count(parts.where("_large").select("node"))
        left = queries.join(far_on, F.col("start") == F.col("node"), "left_semi")
        found = _alternatives_in_rounds(priced.join(far_on, F.col("a") == F.col("node"), "left_semi"), names, left, k, attempts, toll, rise, *limits)
        parts, queries = parts.where("_large IS NULL").drop("_large"), queries.join(far_on, F.col("start") == F.col("node"), "left_anti")
    asked = queries.where("q IS NOT NULL AND start IS NOT NULL AND end IS NOT NULL").select("q", "start", "end")
    asked = asked.join(by_count(parts.withColumnRenamed("node", "start")), "start", "left").withColumn("part", F.coalesce("part", "start")).select("q", "start", "end", group)
    held = wide.join(by_count(parts.select(F.col("node").alias("a"), "part")), "a").select("a", "b", *[f"cost_{i}" for i in range(len(names))], group)
    turn = [*range(1, len(names)), 0]
    tries = [(turn[i % len(turn)], toll + rise * (i // len(turn))) for i in range(attempts)]
    double = [StructField(c, DoubleType()) for c in ("cost", "jaccard", "far_share")]
    kind = StructType([StructField("q", queries.schema["q"].dataType), StructField("variant", IntegerType()), StructField("nodes", ArrayType(StringType())), *double])

    def searched(own: pa.Table, wanted: pa.Table) -> pa.Table:
        lattice = Lattice(own, wanted, len(names))
        paths = lattice.alternatives(lattice.numbers(wanted["start"]), lattice.numbers(wanted["end"]), k, tries, *limits)
        rows = [(i, v, lattice.names.take(pa.array(p)).to_pylist(), *rest) for i, one in enumerate(paths) for v, (p, *rest) in enumerate(one)]
        at, variant, nodes, *rest = zip(*rows, strict=True) if rows else ([],) * 6
        kinds = (pa.int32(), pa.list_(pa.string()), pa.float64(), pa.float64(), pa.float64())
        return pa.table([wanted["q"].take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip((variant, nodes, *rest), kinds, strict=True)]], names=kind.names)

    both = [df.repartition(tasks, "_g").groupBy("_g") for df in (held, asked)]
    out, _ = stored(both[0].cogroup(both[1]).applyInArrow(searched, kind))
    deleted(spark, path)
    return out.unionByName(found) if rounds else out


def _alternatives_in_rounds(
    priced: DataFrame, names: list[str], queries: DataFrame, k: int, attempts: int, toll: float, rise: float, max_jaccard: float, max_length: float, far: float, min_far: float
) -> DataFrame:
    """``alternatives`` on parts of any size: rounds of joins for all queries together."""
    priced = checkpointed(priced)
    lengths = priced.where(F.col("mode") == names[0]).select(F.col("a").alias("node"), F.col("b").alias("_to"), F.col("cost").alias("_c"))
    turn = names[1:] + names[:1]

    def routes(wanted: DataFrame, tolls: DataFrame | None) -> DataFrame:
        """(q, nodes, cost) of wanted rows (q, mode, start, end): the path that reaches the end, and its length."""
        ends = shortest_paths(priced, wanted, by=("mode",), tolls=tolls).join(wanted.select("q", F.col("end").alias("node")), ["q", "node"]).select("q", F.col("path").alias("nodes"))
        hops = ends.select("q", F.posexplode("nodes").alias("i", "node"), F.get("nodes", F.col("i") + 1).alias("_to")).join(lengths, ["node", "_to"])
        cost = hops.groupBy("q").agg(F.sum("_c").alias("cost"))
        return ends.join(cost, "q", "left").select("q", "nodes", F.coalesce("cost", F.lit(0.0)).alias("cost"))

    base = routes(queries.withColumn("mode", F.lit(names[0])), None)
    found = checkpointed(base.select("q", F.lit(0).alias("variant"), "nodes", "cost", F.lit(0.0).alias("jaccard"), F.lit(1.0).alias("far_share"), F.lit(-1).alias("_at")))
    tries = [(i, turn[i % len(turn)], toll + rise * (i // len(turn))) for i in range(attempts)]
    tried = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(m).alias("mode"), F.lit(t).alias("toll")) for i, m, t in tries])) if tries else None
    for variant in range(1, k if tries else 1):
        last = found.groupBy("q").agg(F.max("_at").alias("_at"), F.max("variant").alias("_v")).where(F.col("_v") == variant - 1)
        wanted = queries.join(last, "q").select("q", "start", "end", "_at", tried.alias("_t")).select(F.col("q").alias("_q"), "start", "end", "_at", "_t.*").where("_i > _at")
        wanted = checkpointed(wanted.withColumn("q", F.struct("_q", "_i")))
        if not wanted.limit(1).count():
            break
        x, y = _place(F.col("node"))
        beside = F.explode(F.array(*[node_id(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("node")
        cells = found.select(F.col("q").alias("_q"), F.explode(_middle(F.col("nodes"))).alias("node")).select("_q", beside).distinct()
        made = routes(wanted, checkpointed(wanted.join(cells, "_q").select("q", "node", "toll"))).select("q._q", "q._i", "nodes", "cost")
        old = found.select(F.col("q").alias("_q"), F.col("nodes").alias("_n"), F.when(F.col("variant") == 0, F.col("cost")).alias("_c"))
        share = F.size(F.array_intersect("nodes", "_n")) / F.size(F.array_union("nodes", "_n"))
        rated = made.join(old, "_q").groupBy("_q", "_i", "nodes", "cost").agg(F.max(share).alias("jaccard"), F.min(_far_share(F.col("nodes"), F.col("_n"), far)).alias("far_share"), F.max("_c").alias("_first"))
        good = rated.where((F.col("jaccard") <= max_jaccard) & (F.col("far_share") >= min_far) & (F.col("cost") <= max_length * F.col("_first")))
        best = good.groupBy("_q").agg(F.min(F.struct("_i", "nodes", "cost", "jaccard", "far_share")).alias("_m"))
        new = best.select(F.col("_q").alias("q"), F.lit(variant).alias("variant"), "_m.nodes", "_m.cost", "_m.jaccard", "_m.far_share", F.col("_m._i").alias("_at"))
        found = checkpointed(found.unionByName(new))
    return found.drop("_at")


def compose_chains(*legs: DataFrame, anchors: tuple[Callable[[Column], Column], ...] = (), adjacent: bool = False) -> DataFrame:
    """Chains of one leg (leg, nodes array) of each table in turn: a leg starts where the one before ends, and no cell repeats.

    Returns (chain, n_cells, nodes) of the chains that hold. With ``adjacent``, nodes are named ``x,y`` and every step goes to one of the
    eight cells around. Each of ``anchors``, a condition on a node, must hold at a node of the chain. Legs that break a rule by
    themselves go before any join, chains that cross themselves after each; legs without nodes hold nothing.
    """

    def steps_hold(nodes: Column) -> Column:
        def one(n: Column, i: Column) -> Column:
            (ax, ay), (bx, by) = _place(F.coalesce(F.get(nodes, i - 1), n)), _place(n)
            return (i == 0) | (F.greatest(F.abs(ax - bx), F.abs(ay - by)) == 1)

        return F.forall(F.transform(nodes, one), lambda ok: ok)

    once = F.size(F.array_distinct("nodes")) == F.size("nodes")
    rows = None
    for d in legs:
        own = d.select(F.col("leg").cast("string").alias("leg"), "nodes").where((F.size("nodes") > 0) & once)
        own = own.where(steps_hold(F.col("nodes"))) if adjacent else own
        if rows is None:
            rows = own.select(F.col("leg").alias("chain"), "nodes", F.element_at("nodes", -1).alias("_end"))
            continue
        nxt = own.select("leg", F.element_at("nodes", 1).alias("_end"), F.slice("nodes", F.lit(2), F.size("nodes")).alias("_rest"), F.element_at("nodes", -1).alias("_last"))
        met = rows.join(nxt, "_end").select(F.concat_ws("/", "chain", "leg").alias("chain"), F.concat("nodes", "_rest").alias("nodes"), F.col("_last").alias("_end"))
        rows = met.where(once)
    for holds in anchors:
        rows = rows.where(F.exists("nodes", holds))
    return rows.select("chain", F.size("nodes").alias("n_cells"), "nodes")


def split_modules(paths: DataFrame, route: str, order: str, node: str, is_anchor: Column) -> DataFrame:
    """(route, module, edges, digest): parts between anchors, the digest over their undirected edges in order of name."""
    w = Window.partitionBy(route).orderBy(order)
    rows = paths.withColumn("_n", F.lead(node).over(w)).withColumn("module", F.sum(F.when(is_anchor, 1).otherwise(0)).over(w))
    edge = F.concat_ws("~", F.least(F.col(node), F.col("_n")), F.greatest(F.col(node), F.col("_n")))
    rows = rows.where("_n IS NOT NULL").withColumn("_e", edge)
    return rows.groupBy(route, "module").agg(F.count(F.lit(1)).alias("edges"), F.sha2(F.array_join(F.array_sort(F.collect_list("_e")), "|"), 256).alias("digest"))
