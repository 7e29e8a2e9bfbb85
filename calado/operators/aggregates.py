"""Aggregations: fingerprints, quality reports, zonal statistics, overlaps, reconciliations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from calado.functions import areas
from calado.functions.polygons import area, edges, inner_point, overlap_area
from calado.operators.joins import bbox_join, by_count, cell_join, covers_join, within_distance
from calado.operators.storage import checkpointed


def fingerprint(assets: DataFrame, group: list[str]) -> DataFrame:
    """Per group ``fingerprint``, SHA-256 of the native assets (name, sha256, bytes) in canonical JSON by name."""
    parts = F.array_sort(F.collect_list(F.when(F.col("role") == "native", F.struct("name", "sha256", "bytes"))))
    return assets.groupBy(*group).agg(F.sha2(F.to_json(parts), 256).alias("fingerprint"), F.count_if(F.col("role") == "native").alias("n_assets"))


def quality_report(index: DataFrame, specs: DataFrame, receipts: DataFrame, states: dict[str, str]) -> DataFrame:
    """(rule, violations, status) of an index of source_set_id, state, action against specs and receipts."""
    expected = F.create_map(*[F.lit(x) for kv in states.items() for x in kv])
    duplicate = index.groupBy("source_set_id").count().where("count > 1")
    unknown = index.where(~F.col("state").isin(list(states)) | F.col("state").isNull())
    mismatch = index.where(F.col("state").isin(list(states)) & (F.try_element_at(expected, F.col("state")) != F.col("action")))
    missing = specs.join(index, "source_set_id", "left_anti")
    unheard = index.join(receipts, "source_set_id", "left_anti")
    rules = [("duplicate_id", duplicate), ("unknown_state", unknown), ("action_mismatch", mismatch), ("spec_without_state", missing), ("state_without_receipt", unheard)]
    out = None
    for name, rows in rules:
        one = rows.agg(F.lit(name).alias("rule"), F.count(F.lit(1)).alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))


def catchment(zones: DataFrame, points: DataFrame, zone: list[str], key: str, weight: str, radius: float) -> DataFrame:
    """Per zone (columns ``zone``; x, y of its centres) the features within ``radius`` of any centre: ``features``, the sum of
    weights ``people``, and ``unknown`` weights. A feature counts once in a zone of several centres; without place it counts nowhere.

    Features of one place, and places of one cell, are added up first: a zone takes the sums of the cells that it reaches wholly and asks only
    places in cells at its edge.
    """
    spark, r = zones.sparkSession, float(radius)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = points.select(key, weight, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rows = rows.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)").distinct()
    once = rows.groupBy(key, weight).agg(F.count(F.lit(1)).alias("_n"), F.first("x").alias("x"), F.first("y").alias("y"))
    once = checkpointed(once)
    places = checkpointed(_places(once.where("_n = 1"), weight))
    # Features of several places are few; they meet the centres themselves.
    again = rows.join(by_count(once.where("_n > 1").select(F.col(key).alias("_k"), F.col(weight).alias("_w"))), F.col(key).eqNullSafe(F.col("_k")) & F.col(weight).eqNullSafe(F.col("_w"))).select(*rows.columns)
    spaced = zones.select(*zone, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    centres = checkpointed(spaced.distinct().repartition(tasks))
    near = within_distance(centres, again, r).select(*zone, key, weight).distinct()
    several = near.groupBy(*zone).agg(F.count(F.lit(1)).alias("features"), F.sum(weight).alias("people"), F.count_if(F.col(weight).isNull()).alias("unknown"))

    # Cells as wide as makes their number and that of the places in those at the edge about equal.
    n, held = places.groupBy(F.floor(F.col("x") / r), F.floor(F.col("y") / r)).count().agg(F.sum("count"), F.count(F.lit(1))).first()
    width = min(max((math.pi * r / 4 * (r * r * held / n)) ** (1 / 3), r / 64), r / 2) if n else r
    located = places.withColumns({"_cx": F.floor(F.col("x") / width), "_cy": F.floor(F.col("y") / width)})
    cells = _added(located, ["_cx", "_cy"])
    y0 = F.col("_cy") * width
    half = F.sqrt(F.greatest(F.lit(r * r) - F.pow(F.greatest(y0 - F.col("_y"), F.col("_y") - y0 - width, F.lit(0.0)), 2), F.lit(0.0))) + 1e-6 * r
    reached = centres.select(*zone, F.col("x").alias("_x"), F.col("y").alias("_y"))
    reached = reached.withColumn("_cy", F.explode(F.sequence(F.floor((F.col("_y") - r * (1 + 1e-6)) / width), F.floor((F.col("_y") + r * (1 + 1e-6)) / width))))
    reached = reached.withColumn("_cx", F.explode(F.sequence(F.floor((F.col("_x") - half) / width), F.floor((F.col("_x") + half) / width))))
    far = lambda c, at: F.greatest(F.abs(F.col(c) - F.col(at) * width), F.abs(F.col(c) - (F.col(at) + 1) * width))
    reached = reached.withColumn("_whole", F.pow(far("_x", "_cx"), 2) + F.pow(far("_y", "_cy"), 2) <= r * r * (1 - 1e-7))
    whole, cut = reached.where("_whole").select(*zone, "_cx", "_cy"), reached.where("NOT _whole").drop("_whole")
    many = bool(centres.groupBy(*zone).count().where("count > 1").limit(1).count())
    if many:
        # What one centre reaches wholly is not asked of the others.
        whole = checkpointed(whole.distinct())
        taken = whole.select(*[F.col(c).alias(f"_z{i}") for i, c in enumerate(zone)], F.col("_cx").alias("_tx"), F.col("_cy").alias("_ty"))
        same = [F.col(c).eqNullSafe(F.col(f"_z{i}")) for i, c in enumerate(zone)]
        cut = cut.join(by_count(taken), reduce(lambda a, b: a & b, same, (F.col("_cx") == F.col("_tx")) & (F.col("_cy") == F.col("_ty"))), "left_anti")
    by_cell = whole.join(by_count(cells), ["_cx", "_cy"]).select(*zone, "features", "people", "unknown")
    met = cell_join(cut, located).where(F.pow(F.col("_x") - F.col("x"), 2) + F.pow(F.col("_y") - F.col("y"), 2) <= r * r)
    met = met.dropDuplicates([*zone, "x", "y"]) if many else met
    return _added(by_cell.unionByName(met.select(*by_cell.columns)).unionByName(several), zone)


def area_catchment(cut: DataFrame, key: list[str], area: str, cut_area: str, weight: str) -> DataFrame:
    """A03 by area: rows of features cut to a zone (``G05``), each with its whole ``area``, ``cut_area`` and ``weight``: per ``key`` the
    features whose boxes met (``met``), those that really intersect, those without a usable area (``invalid``), and ``people`` by share of area."""
    valid = F.col(area) > 0
    share = F.least(F.col(cut_area) / F.col(area), F.lit(1.0))
    return cut.groupBy(*key).agg(
        F.count(F.lit(1)).alias("met"),
        F.count_if(valid & (F.col(cut_area) > 0)).alias("intersecting"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("invalid"),
        F.sum(F.when(valid & (F.col(cut_area) > 0), F.col(weight) * share)).alias("people"),
    )


def point_catchment(features: DataFrame, zones: DataFrame, key: str, weight: str, width: float) -> DataFrame:
    """A03 by representative points: per zone (``polygon_id``, ``rings``) the ``features`` whose inner point it covers, the sum of their weights
    ``people`` and ``unknown`` weights. Features have ``rings`` too; one without any area counts nowhere. Features at one place are added up first."""
    # Much work a row, so a fixed number of tasks; the only member of an array is worked out once.
    spread = features.select(weight, "rings").repartition(int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    at = spread.select(weight, F.inline(F.array(inner_point(edges(F.col("rings"))))))
    held = covers_join(checkpointed(_places(at, weight)), zones, width)
    return _added(held, ["polygon_id"])


def _places(points: DataFrame, weight: str) -> DataFrame:
    """(x, y, features, people, unknown) of each place that has points."""
    return points.groupBy("x", "y").agg(F.count(F.lit(1)).alias("features"), F.sum(weight).alias("people"), F.count_if(F.col(weight).isNull()).alias("unknown"))


def _added(places: DataFrame, zone: list[str]) -> DataFrame:
    """The sums of ``_places`` by zone, in their types."""
    return places.groupBy(*zone).agg(*[F.sum(c).cast(places.schema[c].dataType).alias(c) for c in ("features", "people", "unknown")])


def _ends(sides: str, axis: str) -> Column:
    return F.transform(sides, lambda e: e[f"a{axis}"])


def cut_features(features: DataFrame, zones: DataFrame, key: str, weight: str, width: float) -> DataFrame:
    """Rows (polygon_id, key, weight, area, cut_area) of features and zones whose boxes meet, both with ``rings`` of any shape: the input
    of ``area_catchment``."""

    def boxed(df: DataFrame, *keep: str) -> DataFrame:
        rows = df.select(*keep, edges(F.col("rings")).alias("sides"))
        ends = {f"{c}{n}": f(_ends("sides", c)) for c in "xy" for n, f in (("min", F.array_min), ("max", F.array_max))}
        return rows.select("*", *[v.alias(k) for k, v in ends.items()])

    met = bbox_join(boxed(features, key, weight), boxed(zones, "polygon_id"), width)
    return met.select(F.col("polygon_id_b").alias("polygon_id"), F.col(f"{key}_a").alias(key), F.col(f"{weight}_a").alias(weight), area(F.col("sides_a")).alias("area"), overlap_area(F.col("sides_a"), F.col("sides_b")).alias("cut_area"))


def _block_sums(boxes: np.ndarray, facts: np.ndarray, shapes: list[np.ndarray], zones: np.ndarray, rings: list[np.ndarray], least: float) -> np.ndarray:
    """(zones, 5) of features (box, facts: rows, rows without a usable area, area, weight, rows with a weight; sides): met, intersecting, invalid, people and
    rows with a weight among the intersecting, of each zone (box, sides).

    Features are halved by their centres; what a zone holds wholly is added at once, what it is apart from is only counted, and areas are taken where few are left at its border.
    """
    out = np.zeros((len(zones), 5))
    listed = lambda parts: (np.concatenate(parts), np.array([len(s) for s in parts]), np.cumsum(np.r_[0, [len(s) for s in parts]])[:-1])
    outline, around, shapes = listed(rings), listed(areas.signed(rings)), areas.signed(shapes)

    def drawn_by(all_of: tuple, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sides of zones ``z`` and their places in it."""
        sides, sizes, first = all_of
        of = np.repeat(np.arange(len(z)), sizes[z])
        return sides[(first[z] - np.cumsum(np.r_[0, sizes[z]])[:-1])[of] + np.arange(len(of))], of

    own = np.array([len(s) for s in shapes])
    corners, begin = np.concatenate(shapes), np.cumsum(np.r_[0, own])
    n, invalid, area, weight, known = facts.T
    whole = np.zeros(len(own))
    if own.any():
        whole[own > 0] = areas.below(corners, begin[:-1][own > 0])
    valid = n - invalid

    def sums(cut: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of cut areas (features ``at``, ...) intersecting, people, known."""
        held = (cut > least) & (valid[at] > 0)[:, None]
        with np.errstate(all="ignore"):
            share = np.where(held, np.minimum(cut / area[at][:, None], 1.0), 0.0)
        return np.stack([valid[at] @ held, weight[at] @ share, known[at] @ held], axis=1)

    def counted(at: np.ndarray, z: np.ndarray) -> None:
        f, step = boxes[at], max(1, 1_000_000 // len(at))
        for c in range(0, len(z), step):
            b = zones[z[c : c + step]]
            meet = (f[:, None, 0] <= b[:, 2]) & (f[:, None, 2] >= b[:, 0]) & (f[:, None, 1] <= b[:, 3]) & (f[:, None, 3] >= b[:, 1])
            out[z[c : c + step], 0] += n[at] @ meet
            out[z[c : c + step], 2] += invalid[at] @ meet

    todo = [(np.arange(len(boxes)), np.arange(len(zones)))]
    while todo:
        at, z = todo.pop()
        x0, y0, x1, y1 = *boxes[at, :2].min(axis=0), *boxes[at, 2:].max(axis=0)
        z = z[(zones[z, 0] <= x1) & (zones[z, 2] >= x0) & (zones[z, 1] <= y1) & (zones[z, 3] >= y0)]
        if not len(z):
            continue
        slack = 1e-9 * max(x1 - x0, y1 - y0, abs(x0), abs(x1), abs(y0), abs(y1))
        s, of = drawn_by(outline, z)
        near, _ = areas.boxed(s, (x0 - slack, y0 - slack, x1 + slack, y1 + slack))
        touched = np.bincount(of[near], minlength=len(z)) > 0
        inside = np.bincount(of[areas.crossed(np.array((x0 + x1) / 2), np.array((y0 + y1) / 2), s)], minlength=len(z)) % 2 == 1
        held, apart = inside & ~touched, ~inside & ~touched
        if held.any():
            add = sums(whole[at][:, None], at)[0]
            out[z[held]] += [n[at].sum(), add[0], invalid[at].sum(), *add[1:]]
        if apart.any():
            counted(at, z[apart])
        if not touched.any():
            continue
        z = z[touched]
        if len(at) > 12:
            centre = boxes[at, :2] + boxes[at, 2:]
            order = np.argsort(centre[:, int(np.ptp(centre[:, 1]) > np.ptp(centre[:, 0]))], kind="stable")
            todo += [(at[order[: len(at) // 2]], z), (at[order[len(at) // 2 :]], z)]
            continue
        counted(at, z)
        drawn = at[own[at] > 0]
        # Sides of zones beside or below the features add nothing.
        s, of = drawn_by(around, z)
        over = (s[:, 0] < x1) & (s[:, 2] > x0) & (np.maximum(s[:, 1], s[:, 3]) > y0)
        s, of = s[over], of[over]
        if not len(drawn) or not len(s):
            continue
        mine = np.concatenate([corners[begin[i] : begin[i + 1]] for i in drawn])
        starts, to = np.cumsum(np.r_[0, own[drawn]])[:-1], np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        step = max(1, 16_384 * len(to) // max(1, len(mine) * len(s)))
        for c in range(0, len(to), step):
            part = slice(to[c], to[c + step] if c + step < len(to) else len(s))
            cut = areas.common(mine, starts, s[part], to[c : c + step] - to[c])
            out[z[of[to[c : c + step]]][:, None], [1, 3, 4]] += sums(cut, drawn)
    return out


def area_catchment_of(features: DataFrame, zones: DataFrame, weight: str, width: float, least: float = 1e-9) -> DataFrame:
    """A03 by area, from features and zones (``polygon_id``) with ``rings`` of any shape: the rows of ``area_catchment`` over ``cut_features``, where a common area up to
    ``least`` counts as none, without a row for each pair.

    Features of one shape are added up first. Each goes to the tile of its centre, as wide as ``width`` or, for larger ones, doubled until it fits; zones go to
    the tiles that such features reach from. A tile's features and zones meet in blocks of both; sums of the blocks are added.
    """
    from calado.operators.joins import blocks

    def boxed(df: DataFrame, *keep: str) -> DataFrame:
        rows = df.select(*keep, edges(F.col("rings")).alias("sides"))
        ends = {f"{c}{n}": f(_ends("sides", c)) for n, f in (("min", F.array_min), ("max", F.array_max)) for c in "xy"}
        return rows.select("*", *[v.alias(k) for k, v in ends.items()]).where("xmin IS NOT NULL AND ymin IS NOT NULL")

    box = ["xmin", "ymin", "xmax", "ymax"]
    same = features.groupBy("rings").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(weight).cast("double")).alias("_w"), F.count(weight).alias("_known"))
    rows = boxed(same, "_n", "_w", "_known").withColumn("_area", area(F.col("sides")))
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(width))
    rows = rows.withColumn("_size", F.ceil(F.log2(extent / width) - 1e-12).cast("int")).withColumn("_tile", F.lit(width) * F.pow(F.lit(2.0), "_size"))
    rows = checkpointed(rows.withColumns({f"_c{c}": F.floor((F.col(f"{c}min") + F.col(f"{c}max")) / 2 / F.col("_tile")) for c in "xy"}).drop("_tile"))
    # At most some dozens of sizes, doubled one from the other.
    sizes = sorted(r[0] for r in rows.select("_size").distinct().collect())
    around = boxed(zones, "polygon_id").withColumn("_size", F.explode(F.array(*[F.lit(s) for s in sizes]).cast("array<int>"))).withColumn("_tile", F.lit(width) * F.pow(F.lit(2.0), "_size"))
    for c in "xy":
        reach = F.col("_tile") * (0.5 + 1e-9)
        around = around.withColumn(f"_c{c}", F.explode(F.sequence(F.floor((F.col(f"{c}min") - reach) / F.col("_tile")), F.floor((F.col(f"{c}max") + reach) / F.col("_tile")))))
    key = ["_size", "_cx", "_cy"]
    left, right, tasks = blocks(rows, around.drop("_tile"), key, (1 << 14, 1 << 12))
    key += ["_i", "_j"]

    def shapes(table: pa.Table) -> list[np.ndarray]:
        listed = table["sides"].combine_chunks()
        ends, flat = listed.offsets.to_numpy(), listed.values
        rows = np.stack([flat.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("ax", "ay", "bx", "by")], axis=1)
        return [rows[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def summed(near: pa.Table, zone: pa.Table) -> pa.Table:
        boxes = [np.stack([t[c].to_numpy() for c in box], axis=1) for t in (near, zone)]
        n, area, w, known = (pc.fill_null(near[c].cast("double"), 0.0).to_numpy() for c in ("_n", "_area", "_w", "_known"))
        facts = np.stack([n, np.where(area > 0, 0.0, n), area, w, known], axis=1)
        met, intersecting, invalid, people, known = _block_sums(boxes[0], facts, shapes(near), boxes[1], shapes(zone), least).T
        out = {"met": met.astype(np.int64), "intersecting": intersecting.astype(np.int64), "invalid": invalid.astype(np.int64), "people": people, "_known": known.astype(np.int64)}
        return pa.table({"polygon_id": zone["polygon_id"], **{c: pa.array(v) for c, v in out.items()}}).filter(pa.array(met > 0))

    counts = [StructField(c, LongType()) for c in ("met", "intersecting", "invalid")]
    kind = StructType([zones.schema["polygon_id"], *counts, StructField("people", DoubleType()), StructField("_known", LongType())])
    left, right = left.repartition(tasks, *key), right.repartition(tasks, *key)
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(summed, kind)
    total = parts.groupBy("polygon_id").agg(*[F.sum(c).alias(c) for c in ("met", "intersecting", "invalid", "people", "_known")])
    return total.select("polygon_id", "met", "intersecting", "invalid", F.when(F.col("_known") > 0, F.col("people")).alias("people"))


def access_by_threshold(df: DataFrame, group: list[str], minutes: str, people: str, times: list[int]) -> DataFrame:
    """People within each time, and those whose time is not known, as columns."""
    columns = [F.sum(F.when(F.col(minutes) <= t, F.col(people)).otherwise(0)).alias(f"within_{t}") for t in times]
    unknown = F.sum(F.when(F.col(minutes).isNull(), F.col(people)).otherwise(0)).alias("unknown")
    return df.groupBy(*group).agg(*columns, unknown, F.sum(people).alias("total"))


def city_summary(df: DataFrame, group: list[str], km: str, minutes: str, within: tuple[int, ...] = (3, 8, 20)) -> DataFrame:
    """Least and largest minutes, counts within distances, and how many have a time."""
    counts = [F.count_if(F.col(km) <= k).alias(f"within_{k}km") for k in within]
    return df.groupBy(*group).agg(F.min(minutes).alias("min_minutes"), F.max(minutes).alias("max_minutes"), *counts, F.count(minutes).alias("qualified"))


def sample_cells(points: DataFrame, width: float, cap: int, weight: str = "w", key: str = "id") -> DataFrame:
    """Per grid cell the sum and its largest point; the first ``cap`` cells are sampled, the rest stay as unknown.

    The order of all cells needs one rank, found on the aggregated cells only.
    """
    cells = points.groupBy(F.floor(F.col("x") / width).alias("cx"), F.floor(F.col("y") / width).alias("cy")).agg(
        F.sum(weight).alias("total"), F.max_by(key, F.struct(F.col(weight), -F.col(key))).alias("representative")
    )
    top = cells.orderBy(F.col("total").desc(), "cx", "cy").limit(cap).select("cx", "cy", F.lit(True).alias("_s"))
    return cells.join(top, ["cx", "cy"], "left").withColumn("sampled", F.coalesce("_s", F.lit(False))).drop("_s")


def zonal_stats(cells: DataFrame, zone: list[Column], z: str, min_n: int) -> DataFrame:
    """P05, P50, P95, relief and count per zone; too few values give null statistics."""
    rows = cells.groupBy(*zone).agg(F.count(z).alias("n"), F.percentile(z, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("_p"))
    ok = lambda c: F.when(F.col("n") >= min_n, c)
    p = [F.col("_p")[i] for i in range(3)]
    return rows.withColumns({"p05": ok(p[0]), "p50": ok(p[1]), "p95": ok(p[2]), "relief": ok(p[2] - p[0])}).drop("_p")


def ranked_values(values: DataFrame, column: str) -> DataFrame:
    """(value, n, upto, total): the distinct values of ``column``, nulls left out, how often each occurs, and how many are no greater.

    Values are counted, parted by range and written, so that running counts come from one window a range and the sums of the ranges
    before, a few numbers: no task gets all values.
    """
    counts = values.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    parts = checkpointed(counts.repartitionByRange("value").withColumn("_p", F.spark_partition_id()))
    sums = parts.groupBy("_p").agg(F.sum("n").alias("_n"))
    line = Window.orderBy("_p")
    before = F.coalesce(F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select("_p", before.alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("_p").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    return parts.withColumn("_upto", upto).join(sums, "_p").select("value", "n", (F.col("_before") + F.col("_upto")).alias("upto"), "total")


def quantile(p: float) -> Column:
    """Aggregate over ``ranked_values``: the exact quantile, between two values by their distance."""
    at = (F.col("total") - 1) * F.lit(float(p))
    holds = lambda k: (F.col("upto") - F.col("n") <= k) & (k < F.col("upto"))
    low, high = F.max(F.when(holds(F.floor(at)), F.col("value"))), F.max(F.when(holds(F.ceil(at)), F.col("value")))
    weight = F.max(at - F.floor(at))
    return F.when(low == high, low).otherwise(low * (1 - weight) + high * weight)


def crossres(coarse: DataFrame, fine: DataFrame, k: int) -> DataFrame:
    """Residuals of coarse cells against the mean of their k x k fine cells, in one row."""
    mean = fine.groupBy(F.floor(F.col("row") / k).alias("row"), F.floor(F.col("col") / k).alias("col")).agg(F.avg("z").alias("m"))
    r = F.col("z") - F.col("m")
    residuals = checkpointed(coarse.join(mean, ["row", "col"]).where(r.isNotNull()).select(r.alias("r")))
    sums = residuals.agg(
        F.count("r").alias("n"),
        F.avg("r").alias("mean"),
        F.avg(F.abs("r")).alias("mae"),
        F.sqrt(F.avg(F.col("r") * F.col("r"))).alias("rms"),
        F.avg(F.when(F.abs("r") > 1, 1.0).otherwise(0.0)).alias("share_over_1"),
    )
    middle = ranked_values(residuals, "r").agg(quantile(0.5).alias("median"))
    sizes = ranked_values(residuals.select(F.abs("r").alias("size")), "size").agg(quantile(0.95).alias("p95"), quantile(0.99).alias("p99"))
    # One row each.
    return sums.join(middle).join(sizes).select("n", "mean", "median", "mae", "rms", "p95", "p99", "share_over_1")


def raster_qa(cells: DataFrame, group: list[str], low: float, high: float, expected: int) -> DataFrame:
    """A10: valid, NoData, extremes, mean, plausible range, and whether the counts close at ``expected``."""
    return cells.groupBy(*group).agg(
        F.count("z").alias("valid"),
        F.count_if(F.col("z").isNull()).alias("nodata"),
        F.min("z").alias("zmin"),
        F.max("z").alias("zmax"),
        F.avg("z").alias("zmean"),
        F.coalesce((F.min("z") >= low) & (F.max("z") <= high), F.lit(False)).alias("plausible"),
        (F.count(F.lit(1)) == expected).alias("closed"),
    )


def slope_stats(cells: DataFrame, res: float, below: tuple[float, ...] = (5.0, 15.0)) -> DataFrame:
    """Percent slope by central differences over rows and columns (one-sided at edges), as quantiles and shares."""

    def gradient(part: str, order: str) -> Column:
        w = Window.partitionBy(part).orderBy(order)
        before, after = F.coalesce(F.lag("z").over(w), F.col("z")), F.coalesce(F.lead("z").over(w), F.col("z"))
        span = F.coalesce(F.lead(order).over(w), F.col(order)) - F.coalesce(F.lag(order).over(w), F.col(order))
        return F.when(span > 0, (after - before) / (span * res))

    rows = cells.withColumn("gx", gradient("row", "col")).withColumn("gy", gradient("col", "row"))
    slope = rows.select((F.hypot("gx", "gy") * 100).alias("slope")).where("slope IS NOT NULL")
    shares = [(F.sum(F.when(F.col("value") < b, F.col("n")).otherwise(0)) / F.sum("n")).alias(f"below_{b:g}") for b in below]
    n = F.coalesce(F.sum("n"), F.lit(0)).alias("n")
    return ranked_values(slope, "slope").agg(n, quantile(0.5).alias("p50"), quantile(0.9).alias("p90"), F.max("value").alias("max_slope"), *shares)


def pressure(df: DataFrame, group: list[str], deviation: str, length: str) -> DataFrame:
    """Length-weighted mean of absolute deviation, and lengths below -25 and -50 and above 25."""
    d, n = F.col(deviation), F.col(length)
    return df.groupBy(*group).agg(
        (F.sum(F.abs(d) * n) / F.sum(F.when(d.isNotNull(), n))).alias("mean_abs"),
        F.sum(F.when(d < -25, n).otherwise(0)).alias("below_25"),
        F.sum(F.when(d < -50, n).otherwise(0)).alias("below_50"),
        F.sum(F.when(d > 25, n).otherwise(0)).alias("above_25"),
    )


def class_shares(parts: DataFrame, group: list[str], cls: str, area: str, zone_area: Column) -> DataFrame:
    """Area and share of the zone per class."""
    return parts.groupBy(*group, cls).agg(F.sum(area).alias("area")).withColumn("share", F.col("area") / zone_area)


def rect_union(rects: DataFrame, group: list[str]) -> DataFrame:
    """Exact area of the union of rectangles: slabs between distinct x edges, y spans merged within each.

    Rectangles are cut at strips as wide as the group's mean width, rounded up to a power of two: at most some three pieces a rectangle,
    and slabs meet only the pieces of their strip. Rectangles without width have no area.
    """
    wide = rects.where("xmax > xmin").groupBy(*[F.col(c).alias(f"_g_{c}") for c in group]).agg(F.pow(F.lit(2.0), F.ceil(F.log2(F.avg(F.col("xmax") - F.col("xmin"))))).alias("_w"))
    met = rects.where("xmax > xmin").join(wide, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_g_{c}") for c in group], F.lit(True)))
    strips = F.sequence(F.floor(F.col("xmin") / F.col("_w")), F.ceil(F.col("xmax") / F.col("_w")) - 1)
    cut = met.select(*group, "xmin", "xmax", "ymin", "ymax", "_w", F.explode(strips).alias("_strip"))
    low, high = F.greatest("xmin", F.col("_strip") * F.col("_w")), F.least("xmax", (F.col("_strip") + 1) * F.col("_w"))
    cut = cut.select(*group, "_strip", low.alias("xmin"), high.alias("xmax"), "ymin", "ymax")
    return slab_areas(cut, [*group, "_strip"]).groupBy(*group).agg(F.sum("_d").alias("area"))


def slab_areas(rects: DataFrame, group: list[str]) -> DataFrame:
    """Rows of ``group``, rectangles that do not overlap and make up the union (xmin, ymin, xmax, ymax), and ``_d``, their areas; some have none."""
    edges = rects.select(*group, F.explode(F.array("xmin", "xmax")).alias("x")).distinct()
    w = Window.partitionBy(*group).orderBy("x")
    slabs = edges.withColumn("x1", F.lead("x").over(w)).where("x1 IS NOT NULL")
    inside = slabs.join(rects, group).where((F.col("xmin") <= F.col("x")) & (F.col("xmax") >= F.col("x1")))
    v = Window.partitionBy(*group, "x").orderBy("ymin", "ymax")
    top = F.max("ymax").over(v.rowsBetween(Window.unboundedPreceding, -1))
    span = F.greatest(F.col("ymax") - F.greatest("ymin", F.coalesce(top, F.col("ymin"))), F.lit(0.0))
    low = F.greatest("ymin", F.coalesce(top, F.col("ymin")))
    return inside.select(*group, F.col("x").alias("xmin"), low.alias("ymin"), F.col("x1").alias("xmax"), (low + span).alias("ymax"), (span * (F.col("x1") - F.col("x"))).alias("_d"))


def field_inventory(rows: DataFrame, fields: str, samples: int = 5) -> DataFrame:
    """For each key of a map column: rows, filled rows, and the first ``samples`` distinct values in order."""
    pairs = rows.select(F.explode(F.map_entries(fields)).alias("e")).select("e.key", "e.value")
    counts = pairs.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("key").orderBy("value")
    ranked = counts.withColumn("_i", F.when(F.col("value").isNotNull(), F.row_number().over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.sum(F.when(F.col("value").isNull(), 1).otherwise(0)).over(w)))
    return ranked.groupBy("key").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("_i") <= samples, F.col("value")))), "|").alias("samples"),
    )


def schema_signatures(rows: DataFrame, fields: str) -> DataFrame:
    """How many rows of a map column have each set of keys: (signature, keys, rows), keys in order and joined by a bar."""
    keys = F.array_sort(F.map_keys(fields))
    return rows.groupBy(F.array_join(keys, "|").alias("signature")).agg(F.first(F.size(fields)).alias("keys"), F.count(F.lit(1)).alias("rows"))


def pair_overlap(sets: DataFrame, item: str, member: str) -> DataFrame:
    """For pairs of items that share members: (a, b, common, total, jaccard), a < b."""
    rows = sets.select(item, member).distinct()
    sizes = rows.groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    left, right = rows.select(F.col(item).alias("a"), member), rows.select(F.col(item).alias("b"), member)
    common = left.join(right, member).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    na, nb = sizes.select(F.col(item).alias("a"), F.col("n").alias("na")), sizes.select(F.col(item).alias("b"), F.col("n").alias("nb"))
    total = F.col("na") + F.col("nb") - F.col("common")
    return common.join(na, "a").join(nb, "b").select("a", "b", "common", total.alias("total"), (F.col("common") / total).alias("jaccard"))


def nearest_set(sets: DataFrame, item: str, member: str, hot: int = 256, thresholds: tuple[float, ...] = (0.7, 0.4)) -> DataFrame:
    """Per item its ``n`` members and the ``other`` item of greatest Jaccard index, ties to the least, with ``common`` members and
    ``jaccard``; null where no other shares a member.

    Equal sets are taken together first: the others of a set's class are at 1. Members are put in order, rarest first. Two sets at t or
    more share one of their first n - t n + 1 members, so each round of falling thresholds joins only those, of sets whose best is still below
    t, with sets of sizes within t; the last round takes all. Members of more than ``hot`` sets join nothing: two sets that share only such
    members are alike by the part of hot members they hold and by their sizes, so for each such part, and each number of hot members in
    common, the two smallest sets that have it stand for all. So no member's sets are ever paired with each other beyond ``hot``.
    """
    rows = sets.select(F.col(item).alias("i"), F.col(member).alias("m")).where("i IS NOT NULL AND m IS NOT NULL").distinct()
    whole = rows.groupBy("i").agg(F.sort_array(F.collect_list("m")).alias("_set"))
    classes = checkpointed(whole.groupBy("_set").agg(F.min("i").alias("c"), F.count(F.lit(1)).alias("_k")))
    # The first two of a class, of which tasks keep two each before the shuffle; its rows may be very many.
    two = whole.withColumn("_r", F.row_number().over(Window.partitionBy("_set").orderBy("i"))).where("_r <= 2").groupBy("_set").agg(F.min("i").alias("_first"), F.max("i").alias("_second"))
    met = _salted(whole, two.where("_first < _second"), ["_set"], "i")
    copies = met.select("i", F.size("_set").alias("n"), F.when(F.col("i") > F.col("_first"), F.col("_first")).otherwise(F.col("_second")).alias("other"), F.size("_set").alias("common"), F.lit(1.0).alias("jaccard"))

    members = classes.select("c", F.size("_set").alias("n"), F.explode("_set").alias("m"))
    counts = members.groupBy("m").agg(F.count(F.lit(1)).alias("df"))
    ranked = _salted(members, counts, ["m"], "c").withColumn("at", F.row_number().over(Window.partitionBy("c").orderBy("df", "m")))
    ranked = checkpointed(ranked)
    sized = classes.select("c", F.size("_set").alias("n"), "_set")
    best = checkpointed(_best(_hot_pairs(ranked.where(F.col("df") > hot))))
    rare, done = ranked.where(F.col("df") <= hot), None
    left = checkpointed(classes.where("_k = 1").select("c"))
    for t in [*thresholds, 0.0]:
        head = rare.where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1) if t else rare
        mine = head.join(left, "c", "left_semi").select("c", "n", "m")
        theirs = head.select(F.col("c").alias("o"), F.col("n").alias("no"), "m")
        near = (F.col("no") >= F.col("n") * t - 1e-9) & (F.col("n") >= F.col("no") * t - 1e-9)
        pairs = mine.join(theirs, "m").where((F.col("c") != F.col("o")) & near).select("c", "o").distinct()
        met = pairs.join(sized.select("c", F.col("_set").alias("_a")), "c").join(sized.select(F.col("c").alias("o"), F.col("_set").alias("_b")), "o")
        shared = F.size(F.array_intersect("_a", "_b"))
        found = met.select("c", "o", F.size("_a").alias("n"), shared.alias("common"), (shared / (F.size("_a") + F.size("_b") - shared)).alias("jaccard"))
        best = _best(found.unionByName(best.join(left, "c", "left_semi")))
        sure = checkpointed(best.where(F.col("jaccard") >= t))
        done = sure if done is None else done.unionByName(sure)
        left = checkpointed(left.join(sure, "c", "left_anti"))
        best = checkpointed(best.join(left, "c", "left_semi"))
    alone = sized.join(left, "c", "left_semi").select(F.col("c").alias("i"), "n", F.lit(None).cast(done.schema["o"].dataType).alias("other"), F.lit(None).cast("int").alias("common"), F.lit(None).cast("double").alias("jaccard"))
    out = done.select(F.col("c").alias("i"), "n", F.col("o").alias("other"), "common", "jaccard").unionByName(copies).unionByName(alone)
    return out.withColumnRenamed("i", item)


def _salted(many: DataFrame, few: DataFrame, on: list[str], by: str, salts: int = 16) -> DataFrame:
    """Join with rows of ``few``, one a key; a key of very many rows is split in ``salts`` parts."""
    parts = many.withColumn("_s", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    return parts.join(few.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [*on, "_s"]).drop("_s")


def _best(pairs: DataFrame) -> DataFrame:
    """Per set (c) its best other (o): the greatest index, then the least name."""
    top = F.min(F.struct((-F.col("jaccard")).alias("d"), "o", "common", "n")).alias("_m")
    return pairs.groupBy("c").agg(top).select("c", "_m.o", "_m.n", "_m.common", (-F.col("_m.d")).alias("jaccard"))


def _hot_pairs(hot: DataFrame) -> DataFrame:
    """Pairs (c, o, n, common, jaccard) of each set with the two smallest sets of each number of hot members in common, counted as if they shared
    no others: exact where they do not, and never too high."""
    held = hot.groupBy("c", "n").agg(F.sort_array(F.collect_list("m")).alias("_p"))
    parts = held.select("_p").distinct()
    member = lambda p: parts.select(F.col("_p").alias(p), F.explode("_p").alias("m"))
    alike = member("_p").join(member("_q"), "m").groupBy("_p", "_q").agg(F.count(F.lit(1)).alias("common"))
    small = held.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy("n", "c"))).where("_i <= 2").select(F.col("_p").alias("_q"), F.col("c").alias("o"), F.col("n").alias("no"))
    by_common = alike.join(small, "_q").withColumn("_i", F.row_number().over(Window.partitionBy("_p", "common").orderBy("no", "o"))).where("_i <= 2").drop("_i", "_q")
    lists = by_common.groupBy("_p").agg(F.collect_list(F.struct("o", "no", "common")).alias("_l"))
    met = held.join(lists, "_p").select("c", "n", F.inline("_l")).where("c <> o")
    return met.select("c", "o", "n", F.col("common").cast("int").alias("common"), (F.col("common") / (F.col("n") + F.col("no") - F.col("common"))).alias("jaccard"))


def cell_frequency(paths: DataFrame, cell: list[str], variant: str, top: int | None = 25) -> DataFrame:
    """How many variants use each cell, and whether all do; the ``top`` cells by use."""
    n = paths.agg(F.count_distinct(variant).alias("_all"))
    rows = paths.groupBy(*cell).agg(F.count_distinct(variant).alias("variants")).join(F.broadcast(n)).withColumn("common", F.col("variants") == F.col("_all")).drop("_all")
    return rows if top is None else rows.orderBy(F.col("variants").desc(), *cell).limit(top)


def missing_ground(paths: DataFrame, ground: DataFrame, cell: list[str], variant: str, top: int | None = 25) -> DataFrame:
    """Cells of the paths without a height in ``ground`` (``cell``, z): in how many variants each recurs, and whether in all; the ``top`` ones."""
    known = ground.where("z IS NOT NULL").select(*cell).distinct()
    n = paths.agg(F.count_distinct(variant).alias("_all"))
    rows = paths.select(*cell, variant).join(known, cell, "left_anti").groupBy(*cell).agg(F.count_distinct(variant).alias("variants"))
    rows = rows.join(F.broadcast(n)).withColumn("common", F.col("variants") == F.col("_all")).drop("_all")
    return rows if top is None else rows.orderBy(F.col("variants").desc(), *cell).limit(top)


def topk_hits(ranked: DataFrame, key: str, rank: str, k: int) -> DataFrame:
    """How often each option is among the first ``k`` of a ranking."""
    return ranked.groupBy(key).agg(F.count_if(F.col(rank) <= k).alias("hits"), F.count(F.lit(1)).alias("rankings"), F.min(rank).alias("best"))


def hotspots(df: DataFrame, group: list[str], s: str, value: str, block: float, top: int) -> DataFrame:
    """The ``top`` chainage blocks per group by P90 of absolute values, with shares over 25 and 50."""
    rows = df.groupBy(*group, F.floor(F.col(s) / block).cast("long").alias("block")).agg(
        F.percentile(F.abs(value), F.lit(0.9)).alias("p90"),
        F.avg(F.when(F.abs(value) > 25, 1.0).otherwise(0.0)).alias("over_25"),
        F.avg(F.when(F.abs(value) > 50, 1.0).otherwise(0.0)).alias("over_50"),
    )
    w = Window.partitionBy(*group).orderBy(F.col("p90").desc(), "block")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def reconcile(df: DataFrame, keys: list[str], parts: list[str], total: str, tolerance: str = "0.01") -> DataFrame:
    """Exact decimal balance of parts against the total, and whether it is within ``tolerance``."""
    d = lambda c: F.sum(F.col(c).cast("decimal(18,2)"))
    left = None
    for p in parts:
        left = d(p) if left is None else left + d(p)
    rows = df.groupBy(*keys).agg((left - d(total)).alias("difference"))
    return rows.withColumn("balanced", F.abs("difference") <= F.lit(tolerance).cast("decimal(18,2)"))


def coverage(requested: DataFrame, observed: DataFrame, dim: str, code: str) -> DataFrame:
    """Per dimension the requested and missing members, and whether none is missing."""
    seen = observed.select(dim, code).distinct().withColumn("_seen", F.lit(1))
    met = requested.select(dim, code).distinct().join(seen, [dim, code], "left")
    return met.groupBy(dim).agg(
        F.count(F.lit(1)).alias("requested"),
        F.count_if(F.col("_seen").isNull()).alias("missing"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("_seen").isNull(), F.col(code)))), ",").alias("missing_codes"),
        F.bool_and(F.col("_seen").isNotNull()).alias("complete"),
    )


def forced_requests(plan: DataFrame, observed: DataFrame) -> DataFrame:
    """The requests of ``plan`` to send again with all their codes named, once each: rows of the plan with ``explicit`` true.

    ``plan`` has (request, dim, codes, omitted, explicit), one row a dimension; ``omitted`` says that the dimension was whole and so left out of the
    address. An answer (``observed``: request, dim, code) that lacks a code of an omitted dimension, or has another, is a part; one to a
    request that named its codes is final.
    """
    seen = observed.groupBy("request", "dim").agg(F.collect_set("code").alias("_seen"))
    met = plan.join(seen, ["request", "dim"], "left")
    none = F.coalesce("_seen", F.slice("codes", 1, 0))
    part = F.col("omitted") & ~F.col("explicit") & ((F.size(F.array_except("codes", none)) > 0) | (F.size(F.array_except(none, "codes")) > 0))
    again = met.groupBy("request").agg(F.bool_or(part).alias("_part")).where("_part").select("request")
    return plan.join(again, "request", "left_semi").withColumn("explicit", F.lit(True))


def covered_by_requests(plan: DataFrame, respond: Callable[[DataFrame], DataFrame], most_rounds: int = 10) -> tuple[DataFrame, int]:
    """((dim, requested, missing, missing_codes, complete), rounds) after asking ``respond`` for the plan, and again, with codes named, for what came
    back in part, until nothing is asked again. Answers to the last asking of a request count."""
    left, kept, rounds = checkpointed(plan), None, 0
    while not left.isEmpty():
        rounds += 1
        if rounds > most_rounds:
            raise ValueError("requests still come back in part")
        answer = checkpointed(respond(left))
        again = checkpointed(forced_requests(left, answer))
        final = answer.join(again.select("request").distinct(), "request", "left_anti")
        kept = final if kept is None else kept.unionByName(final)
        left = again
    asked = plan.select("dim", F.explode("codes").alias("code"))
    return coverage(asked, kept if kept is not None else asked.limit(0), "dim", "code"), rounds


def dedupe_strict(df: DataFrame, keys: list[str], content: list[str]) -> DataFrame:
    """One row per key with ``copies`` and ``conflict``, whether rows of the key differ in ``content``."""
    from calado.functions.text import canon_hash

    rows = df.withColumn("_h", canon_hash(*[F.col(c) for c in content]))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), (F.min("_h") != F.max("_h")).alias("conflict"))


def plane_fit(samples: DataFrame, group: list[str], max_grade: float, cell_area: float, min_share: float = 0.98) -> DataFrame:
    """Least-squares grade along, clamped; median intercept; P90 of residuals; cut and fill volumes; null if too few are valid."""
    fit = samples.groupBy(*group).agg(F.regr_slope("z", "along").alias("slope"), F.count("z").alias("valid"), F.count(F.lit(1)).alias("total"))
    fit = fit.withColumn("grade", F.greatest(F.lit(-max_grade), F.least(F.lit(max_grade), F.col("slope"))))
    flat = samples.join(fit, group).withColumn("_b", F.col("z") - F.col("grade") * F.col("along"))
    base = flat.groupBy(*group).agg(F.median("_b").alias("intercept"))
    left = flat.join(base, group).withColumn("_r", F.col("_b") - F.col("intercept"))
    out = left.groupBy(*group).agg(
        F.first("grade").alias("grade"), F.first("intercept").alias("intercept"), F.percentile(F.abs("_r"), F.lit(0.9)).alias("p90"),
        F.sum(F.greatest("_r", F.lit(0.0)) * cell_area).alias("cut"), F.sum(F.greatest(-F.col("_r"), F.lit(0.0)) * cell_area).alias("fill"),
        (F.first("valid") / F.first("total")).alias("valid_share"),
    )
    ok = lambda c: F.when(F.col("valid_share") >= min_share, F.col(c)).alias(c)
    return out.select(*group, "valid_share", *[ok(c) for c in ("grade", "intercept", "p90", "cut", "fill")])


def strict_mean(column: str) -> Column:
    """The mean only when no member is null."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.avg(column))


def scan_summary(requests: DataFrame, group: list[str], window: str, tile: str, product: str | None = None) -> DataFrame:
    """Complete only if every window is; distinct tiles; windows. With ``product`` also ``products``, and ``paired``, the tiles that all of the
    group's products have."""
    if product:
        by_tile = requests.groupBy(*group, tile).agg(F.collect_set(product).alias("_p"))
        held = by_tile.groupBy(*group).agg(F.size(F.array_distinct(F.flatten(F.collect_set("_p")))).alias("products"))
        paired = by_tile.join(held, group).groupBy(*group).agg(F.first("products").alias("products"), F.count_if(F.size("_p") == F.col("products")).alias("paired"))
        return scan_summary(requests, group, window, tile).join(paired, group)
    return requests.groupBy(*group).agg(F.bool_and("complete").alias("complete"), F.count_distinct(tile).alias("tiles"), F.count_distinct(window).alias("windows"))


def measure_routes(paths: DataFrame, cells: DataFrame, route: str, order: str, cell: list[str]) -> DataFrame:
    """Cells, lattice length, elevation range, median relief, largest step and share of cells with ground."""
    w = Window.partitionBy(route).orderBy(order)
    rows = paths.join(cells, cell, "left")
    x, y = cell
    rows = rows.withColumns({"_d": F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)), "_s": F.abs(F.col("z") - F.lag("z").over(w))})
    return rows.groupBy(route).agg(
        F.count(F.lit(1)).alias("cells"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("length"), (F.max("z") - F.min("z")).alias("range"),
        F.median("relief").alias("relief"), F.max("_s").alias("max_step"), (F.count("z") / F.count(F.lit(1))).alias("ground_share"),
    )


def separation(df: DataFrame, option: str, s: str, limit: int | None = None, block: int = 1 << 14) -> DataFrame:
    """Per pair of options the greatest distance at equal chainage, and at how many chainages they meet.

    Options are dealt to blocks of about ``block`` options and at most some 2^20 rows. A block is packed into one compressed row, which is sent once for each
    block, and each pair of blocks is one group that gives its pairs whole: no row and no pair of rows is shuffled for it. A place without coordinates has no distance.
    """
    rows = df.select(F.col(option).alias("o"), F.col(s).alias("s"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where("o IS NOT NULL AND s IS NOT NULL")
    size = rows.agg(F.count(F.lit(1)), F.countDistinct("o")).first()
    n = max(1, math.ceil(size[0] / 2**20), min(8, math.ceil(size[0] / 2**17)), math.ceil(size[1] / block))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n * (n + 1) // 2, 10_000))
    kind = StructType([StructField("a", rows.schema["o"].dataType), StructField("b", rows.schema["o"].dataType), StructField("_d2", DoubleType()), StructField("chainages", LongType())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        if sum(batch.num_rows for batch in own):
            group, sink = pa.Table.from_batches(own).sort_by([("o", "ascending"), ("s", "ascending")]), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, group.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(group)
            yield pa.RecordBatch.from_arrays([group["_b"][:1].combine_chunks(), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["_b", "_rows"])

    dealt = rows.withColumn("_b", F.pmod(F.xxhash64("o"), F.lit(n)).cast("int")).repartitionById(n, F.col("_b")).mapInArrow(packed, "_b int, _rows binary")
    sent = dealt.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(F.least("_b", "_k").alias("_i"), F.greatest("_b", "_k").alias("_j"), "_rows")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        alone = own[0].column("_i")[0].as_py() == own[0].column("_j")[0].as_py()
        yield from met(pa.concat_tables([pa.ipc.open_stream(packed.as_buffer()).read_all() for batch in own for packed in batch.column("_rows")]), alone)

    def met(group: pa.Table, alone: bool) -> Iterator[pa.RecordBatch]:
        names = pc.unique(group["o"])
        names = names.take(pc.sort_indices(names))
        o, at = pc.index_in(group["o"], names).to_numpy(), np.unique(group["s"].to_numpy(), return_inverse=True)[1]
        x, y = group["x"].to_numpy(), group["y"].to_numpy()
        m, t = len(names), int(at.max()) + 1
        side = np.empty(m, np.int64)
        side[o] = group["_b"].to_numpy()
        once = len(np.unique(o.astype(np.int64) * t + at)) == len(o)
        if once and m * t <= 8 * len(o):
            # Rows in a table of options and chainages: one option meets all later ones at once.
            xs, ys, there = np.full((m, t), np.nan), np.full((m, t), np.nan), np.zeros((m, t), np.float32)
            xs[o, at], ys[o, at], there[o, at] = x, y, 1
        else:
            # By chainage, so that an option meets the rows at its own chainages.
            order, by = np.argsort(o, kind="stable"), np.argsort(at, kind="stable")
            starts, first = np.searchsorted(o[order], np.arange(m + 1)), np.searchsorted(at[by], np.arange(t + 1))
            there = None
        for k in range(m):
            if there is not None:
                to = np.arange(k + 1, m)
                to = to if alone else to[side[to] != side[k]]
                count = (there[to] @ there[k]).astype(np.int64)
                to, count = to[count > 0], count[count > 0]
                best = np.empty(len(to))
                for p in range(0, len(to), 512):
                    part = to[p : p + 512]
                    best[p : p + 512] = np.fmax.reduce((xs[part] - xs[k]) ** 2 + (ys[part] - ys[k]) ** 2, axis=1)
            else:
                mine = order[starts[k] : starts[k + 1]]
                low, times = first[at[mine]], first[at[mine] + 1] - first[at[mine]]
                left = np.repeat(mine, times)
                right = by[np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)]
                ok = (o[right] > k) & (alone | (side[o[right]] != side[k]))
                left, right = left[ok], right[ok]
                count, far = np.bincount(o[right], minlength=m), np.full(m, np.nan)
                np.fmax.at(far, o[right], (x[left] - x[right]) ** 2 + (y[left] - y[right]) ** 2)
                to = np.flatnonzero(count)
                count, best = count[to], far[to]
            if len(to):
                yield pa.RecordBatch.from_arrays([names.take(pa.array(np.full(len(to), k))), names.take(pa.array(to)), pa.array(best), pa.array(count.astype(np.int64))], ["a", "b", "_d2", "chainages"])

    found = sent.repartition(tasks, "_i", "_j").groupBy("_i", "_j").applyInArrow(pairs, kind)
    return found.select("a", "b", F.sqrt(F.nanvl("_d2", F.lit(None).cast("double"))).alias("separation"), "chainages")
