"""Fronts, bests, greedy picks, plans of partitions, and set audits."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from calado.operators.gates import require
from calado.operators.storage import checkpointed


def pareto(df: DataFrame, dims: list[str], senses: list[str], part: list[str], key: str, eps: float = 1e-9, blocks: int = 16, rows_each: int = 2000) -> DataFrame:
    """Rows that no row of their ``part`` dominates: at least as good in all ``dims``, better in one by over ``eps``.

    Rows with a null measure are left out. Rounds of salted blocks, at least ``blocks`` a part and of about ``rows_each`` rows in large parts,
    drop most rows by comparing only within a block, dealt anew each round, until a round drops under half. What is left is cut into ranges
    of its first measure, of about ``rows_each`` rows, and each range is compared with itself and the better ones, one task a range and part. In blocks a row goes only if another is as good in all ``dims`` without tolerance: that other dominates all that the row
    does, so that dropping it changes nothing for the rest.
    """
    up = [F.col(c) if s == "max" else -F.col(c) for c, s in zip(dims, senses, strict=True)]
    full = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dims]))
    rows = full.select(*part, key, *[u.alias(f"_d{i}") for i, u in enumerate(up)])

    def undominated(these: DataFrame, others: DataFrame, by: list[str], slack: float) -> DataFrame:
        a, b = these.alias("a"), others.alias("b")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
        no_worse = [F.col(f"b._d{i}") >= F.col(f"a._d{i}") - slack for i in range(len(dims))]
        better = [F.col(f"b._d{i}") > F.col(f"a._d{i}") + eps for i in range(len(dims))]
        return a.join(b, reduce(lambda x, y: x & y, [*same, *no_worse, reduce(lambda x, y: x | y, better)]), "left_anti")

    left, before, step = rows, None, 0
    while True:
        sizes = left.groupBy(*[F.col(c).alias(f"_p_{c}") for c in part]).agg(F.count(F.lit(1)).alias("_n"))
        of_part = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in part], F.lit(True))
        n = F.greatest(F.lit(blocks), F.ceil(F.col("_n") / rows_each)).cast("long")
        dealt = left.join(sizes, of_part).withColumn("_salt", F.pmod(F.xxhash64(key, F.lit(step)), n)).select(*rows.columns, "_salt")
        left = checkpointed(undominated(dealt, dealt, [*part, "_salt"], 0.0).drop("_salt"))
        now = left.count()
        if now <= blocks * rows_each or (before is not None and 2 * now > before):
            break
        before, step = now, step + 1
    shares = [i / -(-now // rows_each) for i in range(1, -(-now // rows_each))]
    cuts = F.percentile_approx("_d0", F.array(*[F.lit(q) for q in shares]), 10 * len(shares)) if shares else F.array()
    bounds = left.groupBy(*[F.col(c).alias(f"_p_{c}") for c in part]).agg(cuts.cast("array<double>").alias("_cuts"))
    ranged = left.withColumn("_first", F.col("_d0").cast("double")).join(bounds, of_part)
    at = lambda v: F.size(F.filter("_cuts", lambda c: c < v))
    these = ranged.withColumn("_range", at(F.col("_first"))).select(*rows.columns, "_range")
    others = ranged.withColumn("_range", F.explode(F.sequence(F.lit(0), at(F.col("_first") + 2 * eps)))).select(*rows.columns, "_range")
    front = undominated(these, others, [*part, "_range"], eps)
    kept = front.select(*[F.col(c).alias(f"_k_{c}") for c in [*part, key]])
    return full.join(kept, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*part, key]]), "left_semi")


def best_by(df: DataFrame, group: list[str], order: list[Column], columns: list[str]) -> DataFrame:
    """Per group the columns of the row least by an ordered tuple."""
    least = F.min(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *columns)).alias("_m")
    return df.groupBy(*group).agg(least).select(*group, *[F.col(f"_m.{c}") for c in columns])


def top_n(df: DataFrame, part: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each part, with ``rank``."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("rank") <= n)


def greedy_disjoint(df: DataFrame, part: str, order: list[str], ids: str, picks: int = 4) -> DataFrame:
    """Per part up to ``picks`` rows in order, none with an id of its array that an earlier one has; ``rank`` is the place among all rows of the part.

    Each round takes the least row of every part that is after its last pick and holds no id taken there, over all rows; ties go by the
    other columns. Null ids clash with none. Only picks are joined, once for each of a part's salts, as one part may hold most rows.
    """
    salts = 16
    columns = [*order, *[c for c in df.columns if c not in order]]
    rows = checkpointed(df.select(F.col(part).alias("_part"), F.struct(*columns, F.monotonically_increasing_id().alias("_id")).alias("_row"), F.array_compact(F.coalesce(ids, F.array().cast(df.schema[ids].dataType))).alias("_ids")))
    rows = rows.withColumn("_salt", F.pmod("_row._id", F.lit(salts)).cast("int"))

    def dealt(picked: DataFrame) -> DataFrame:
        return picked.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s")).withColumnRenamed("_part", "_p")

    at_part = F.col("_part").eqNullSafe(F.col("_p")) & (F.col("_salt") == F.col("_s"))
    picked, free = None, rows
    for step in range(picks):
        least = free.groupBy("_part", "_salt").agg(F.min(F.struct("_row", "_ids")).alias("_m")).groupBy("_part").agg(F.min("_m").alias("_m"))
        new = checkpointed(least.select("_part", "_m._row", "_m._ids", F.lit(step).alias("_step")))
        if not new.limit(1).count():
            break
        picked = new if picked is None else picked.unionByName(new)
        taken = picked.groupBy("_part").agg(F.max("_row").alias("_last"), F.array_distinct(F.flatten(F.collect_list("_ids"))).alias("_taken"))
        free = rows.join(dealt(taken), at_part).where((F.col("_row") > F.col("_last")) & ~F.arrays_overlap("_ids", "_taken")).select(*rows.columns)
    if picked is None:
        return df.limit(0).withColumn("rank", F.lit(0))
    ends = picked.groupBy("_part").agg(F.array_sort(F.collect_list("_row")).alias("_ends"))
    # The first pick that a row is not after; rows up to it, summed over the picks before, give its place.
    placed = rows.join(dealt(ends), at_part).select("_part", "_salt", F.size(F.filter("_ends", lambda e: e < F.col("_row"))).alias("_step"))
    counts = placed.groupBy("_part", "_salt", "_step").agg(F.count(F.lit(1)).alias("_n")).groupBy("_part", "_step").agg(F.sum("_n").alias("_n"))
    ranks = counts.withColumn("rank", F.sum("_n").over(Window.partitionBy("_part").orderBy("_step")).cast("int")).select(F.col("_part").alias("_p"), F.col("_step").alias("_s"), "rank")
    met = picked.join(ranks, F.col("_part").eqNullSafe(F.col("_p")) & (F.col("_step") == F.col("_s")))
    return met.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns], "rank")


def greedy_cover(items: DataFrame, item: str, unit: str, n: int, score: str | None = None, at_once: int = 64) -> DataFrame:
    """(step, item, gain): ``n`` times the item that adds most unseen units, ties by the highest ``score`` (a column of the item), then by item.

    Gains only fall, so an item's last gain bounds its next one. A step counts anew the ``at_once`` items of the highest bounds, and more of
    them while a bound not counted yet reaches the best gain found; the rest of the items are not looked at. Bounds and the units seen are
    checkpointed, only the items counted in a step come to the driver.
    """
    rows = items.select(item, unit).where(F.col(item).isNotNull()).distinct()
    rank = [F.col("_bound").desc(), F.col("_score").desc_nulls_last(), F.col(item)]
    points = items.where(F.col(item).isNotNull()).groupBy(item).agg((F.max(score) if score else F.lit(0)).alias("_score"))
    bounds = checkpointed(rows.groupBy(item).agg(F.count(F.lit(1)).alias("_bound")).join(points, item))
    rows, seen, chosen = checkpointed(rows), None, []
    better = lambda r: (-r["_gain"], r["_score"] is None, -(r["_score"] or 0), r[item])
    while len(chosen) < n:
        counted: dict = {}
        while True:
            next_ones = bounds.where(~F.col(item).isin(list(counted))) if counted else bounds
            top = next_ones.orderBy(*rank).limit(at_once).collect()
            best = min(counted.values(), key=better, default=None)
            if not top or best is not None and top[0]["_bound"] < best["_gain"]:
                break
            some = rows.where(F.col(item).isin([r[item] for r in top]))
            left = some if seen is None else some.join(seen, unit, "left_anti")
            gains = dict(left.groupBy(item).count().collect())
            counted |= {r[item]: {item: r[item], "_score": r["_score"], "_gain": gains.get(r[item], 0)} for r in top}
        if best is None or not best["_gain"]:
            break
        chosen.append((len(chosen) + 1, best[item], best["_gain"]))
        known = items.sparkSession.createDataFrame([(k, v["_gain"]) for k, v in counted.items()], f"{item} {items.schema[item].dataType.simpleString()}, _new bigint")
        bounds = checkpointed(bounds.join(F.broadcast(known), item, "left").select(item, F.coalesce("_new", "_bound").alias("_bound"), "_score").where(F.col(item) != F.lit(best[item])))
        mine = rows.where(F.col(item) == F.lit(best[item])).select(unit)
        seen = checkpointed(mine if seen is None else seen.union(mine).distinct())
    return items.sparkSession.createDataFrame(chosen, f"step int, {item} {items.schema[item].dataType.simpleString()}, gain bigint")


def extremes(df: DataFrame, group: list[str], key: str, rules: dict[str, Column]) -> DataFrame:
    """Per group the key least by each rule, one row for each key with the rules it meets."""
    found = df.groupBy(*group).agg(*[F.min(F.struct(c.alias("o"), F.col(key).alias("k"))).getField("k").alias(n) for n, c in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias(key)) for n in rules])).alias("e")
    return found.select(*group, pairs).groupBy(*group, F.col(f"e.{key}").alias(key)).agg(F.array_join(F.array_sort(F.collect_list("e.rule")), ",").alias("rules"))


def plan_chunks(members: DataFrame, max_cells: int, prefer: str) -> DataFrame:
    """Split requests (request, dim_a array, dim_b array) in halves until the product of sizes is at most ``max_cells``.

    The preferred dimension is halved first, else the larger one. A request of one cell over the limit is an error.
    """
    other = "dim_b" if prefer == "dim_a" else "dim_a"
    done, left = None, members
    cells = F.size("dim_a") * F.size("dim_b")
    for _ in range(64):
        fits = left.where(cells <= max_cells)
        done = fits if done is None else done.unionByName(fits)
        left = left.where(cells > max_cells)
        if not left.limit(1).count():
            return done
        pick = F.size(prefer) > 1
        half = lambda c: F.ceil(F.size(c) / 2).cast("int")

        def parts(c: str, cut: Column) -> tuple[Column, Column]:
            return (F.when(cut, F.slice(c, F.lit(1), half(c))).otherwise(F.col(c)), F.when(cut, F.slice(c, half(c) + 1, F.size(c))).otherwise(F.col(c)))

        (p0, p1), (o0, o1) = parts(prefer, pick), parts(other, ~pick)
        guard = F.when(cells <= 1, F.raise_error(F.lit("one cell is over the limit"))).otherwise(F.lit(0))
        both = F.explode(F.array(F.struct(p0.alias(prefer), o0.alias(other)), F.struct(p1.alias(prefer), o1.alias(other)))).alias("_h")
        left = checkpointed(left.withColumn("_g", guard).where("_g = 0").select("request", both).select("request", "_h.dim_a", "_h.dim_b"))
    raise ValueError("requests do not shrink")


def plan_requests(selections: DataFrame, period: str, dims: list[str], prefer: str, max_cells: int, max_length: int, address: str) -> DataFrame:
    """(request, period, dims, cells, length): each request split so that it has one period, at most ``max_cells`` cells and an
    encoded address of at most ``max_length`` characters.

    ``selections`` has ``request`` and an array of codes for the period and each of ``dims``. A dimension that is still whole is left out of the
    address, the period never. What is over either budget is halved, the first half the longer one: in the dimension ``prefer`` if it has several
    members, else in that with most, the first of equals. One cell over a budget is an error, as nothing is left to split.

    Halves are ranges of places in the arrays, found for many requests at once from the sums of their codes' encoded lengths; codes themselves are cut out at the end.
    A null code counts as an empty one.
    """
    encoded = lambda c: F.coalesce(F.length(F.replace(F.replace(F.url_encode(c.cast("string")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))), F.lit(0))
    names = [period, *dims]
    kept = ["request", *names]
    rows = selections.select(*kept, *[F.transform(c, encoded).alias(f"_l{i}") for i, c in enumerate(names)]).where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names]))
    place = StructType([StructField(c, LongType()) for c in ("p", *[f"{v}{i}" for i in range(len(dims)) for v in ("s", "n")], "cells", "length")])
    out = StructType([*rows.select(*kept).schema.fields, StructField("_plan", ArrayType(place))])
    first, heads = dims.index(prefer), [len(c) + 2 for c in names]

    def plans(part: pa.RecordBatch) -> Iterator[np.ndarray]:
        """Plans (row, period, then start and number of each dimension, cells, length) of some requests, at most some hundred thousand at once."""
        sizes = [part[f"_l{i}"].value_lengths().to_numpy().astype(np.int64) for i in range(len(names))]
        begin = [np.r_[0, np.cumsum(s)[:-1]] for s in sizes]
        sums = [np.r_[0, np.cumsum(part[f"_l{i}"].flatten().to_numpy().astype(np.int64))] for i in range(len(names))]
        row = np.repeat(np.arange(len(part)), sizes[0])
        whole = [c for s in sizes[1:] for c in (np.zeros(len(row), np.int64), s[row])]
        todo = [np.column_stack([row, np.arange(len(row)) - begin[0][row], *whole])]
        while todo:
            left = todo.pop()
            if len(left) > 1 << 17:
                todo += [left[: len(left) // 2], left[len(left) // 2 :]]
                continue
            row, numbers = left[:, 0], left[:, 3::2]
            at = begin[0][row] + left[:, 1]
            length = len(address) + heads[0] + sums[0][at + 1] - sums[0][at]
            for i in range(1, len(names)):
                n, at = numbers[:, i - 1], begin[i][row] + left[:, 2 * i]
                length = length + np.where(n == sizes[i][row], 0, heads[i] + sums[i][at + n] - sums[i][at] + 3 * (n - 1))
            cells = numbers.prod(axis=1)
            over = (cells > max_cells) | (length > max_length)
            yield np.column_stack([left, cells, length])[~over]
            left, numbers = left[over], numbers[over]
            if not len(left):
                continue
            if (numbers.max(axis=1) <= 1).any():
                raise ValueError("one cell is over a budget")
            pick = 2 + 2 * np.where(numbers[:, first] > 1, first, numbers.argmax(axis=1))
            i = np.arange(len(left))
            cut = (left[i, pick + 1] + 1) // 2
            low, high = left.copy(), left.copy()
            low[i, pick + 1] = cut
            high[i, pick] += cut
            high[i, pick + 1] -= cut
            todo.append(np.concatenate([low, high]))

    def rowed(part: pa.RecordBatch, found: list[np.ndarray]) -> pa.RecordBatch:
        some = np.concatenate(found)
        some = some[np.argsort(some[:, 0], kind="stable")]
        row, number = np.unique(some[:, 0], return_counts=True)
        listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(number)].astype(np.int32)), pa.StructArray.from_arrays([pa.array(c) for c in some[:, 1:].T], names=place.names))
        held = part.select(kept).take(pa.array(row))
        return pa.RecordBatch.from_arrays([*held.columns, listed], names=[*kept, "_plan"])

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in range(0, len(batch), 256):
                part, found = batch.slice(c, 256), []
                for some in plans(part):
                    found.append(some)
                    if sum(map(len, found)) > 1 << 17:
                        yield rowed(part, found)
                        found = []
                if any(map(len, found)):
                    yield rowed(part, found)

    split = rows.mapInArrow(planned, out).withColumn("_plan", F.explode("_plan"))
    part = lambda i, c: F.slice(c, (F.col(f"_plan.s{i}") + 1).cast("int"), F.col(f"_plan.n{i}").cast("int")).alias(c)
    return split.select("request", F.get(period, F.col("_plan.p").cast("int")).alias(period), *[part(i, c) for i, c in enumerate(dims)], "_plan.cells", "_plan.length")


def first_pass(df: DataFrame, group: list[str], order: list[str], passed: Column, columns: list[str]) -> DataFrame:
    """Per group the first passing candidate in order, null where none passes, and how many were tried."""
    key = F.struct(*order, *[c for c in columns if c not in order])
    return df.groupBy(*group).agg(F.min(F.when(passed, key)).alias("_m"), F.count(F.lit(1)).alias("attempts")).select(*group, *[F.col(f"_m.{c}") for c in columns], "attempts")


def study_points(df: DataFrame, key: str, x: str, y: str, exact: int | None = None) -> DataFrame:
    """Keys by shared coordinates: (x, y, keys, n). With ``exact`` another number of rows, or a key that repeats, is an error."""
    if exact is not None:
        df = require(df, {f"{exact} rows": F.count(F.lit(1)) == exact, "no repeated key": F.count_distinct(key) == F.count(F.lit(1))})
    return df.groupBy(x, y).agg(F.array_join(F.array_sort(F.collect_set(F.col(key).cast("string"))), ",").alias("keys"), F.count_distinct(key).alias("n"))


def union_first(frames: list[DataFrame], key: str) -> DataFrame:
    """Union of scans in order; of rows with one key the first scan's stays, with ``scan`` its number."""
    marked = [f.withColumn("scan", F.lit(i)) for i, f in enumerate(frames)]
    rows = reduce(lambda a, b: a.unionByName(b), marked)
    columns = [c for c in rows.columns if c not in (key, "scan")]
    return rows.groupBy(key).agg(F.min(F.struct("scan", *columns)).alias("_m")).select(key, *[F.col(f"_m.{c}") for c in ["scan", *columns]])


def set_audit(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: members in both, in one only, whether a is a subset of b, and whether they are equal."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    met = left.join(right, key, "full_outer")
    only_a, only_b = F.count_if(F.col("_b").isNull()), F.count_if(F.col("_a").isNull())
    both = F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return met.agg(both.alias("both"), only_a.alias("only_a"), only_b.alias("only_b"), (only_a == 0).alias("subset"), ((only_a == 0) & (only_b == 0)).alias("equal"))


def assert_subset(sub: DataFrame, src: DataFrame, columns: list[str], key: str, geometry: str | None = None) -> DataFrame:
    """One row: rows of ``sub`` that ``src`` lacks, counted as often as they are lacking, repeated keys of ``sub`` and, given the column
    ``geometry``, how many of its rows have none."""
    lacking = sub.select(columns).exceptAll(src.select(columns)).agg(F.count(F.lit(1)).alias("lacking"))
    repeated = sub.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("repeated_keys"))
    out = lacking.join(F.broadcast(repeated))
    return out if geometry is None else out.join(F.broadcast(sub.agg(F.count_if(F.col(geometry).isNull()).alias("null_geometry"))))
