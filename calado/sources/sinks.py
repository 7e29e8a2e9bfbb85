"""Writers and receipts: flat CSV, JSON lines, bounded parts, manifests, append-only receipts, shards, line features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.functions.text import canon_hash


def flat(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in a fixed order; arrays of text joined by |, other nested columns as JSON."""
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        if c not in kinds:
            return F.lit(None).cast("string").alias(c)
        if kinds[c] == "array<string>":
            return F.array_join(c, "|").alias(c)
        if kinds[c].startswith(("array", "map", "struct")):
            return F.to_json(c).alias(c)
        return F.col(c)

    return df.select(*[one(c) for c in columns])


def write_flat_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """``flat`` as CSV with a header in each part."""
    flat(df, columns).write.option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, gzip."""
    df.write.option("compression", "gzip").json(path)


def parts(df: DataFrame, group: list[str], order: str, target_bytes: int) -> DataFrame:
    """Add ``part``: bands of ``target_bytes`` of the rows' JSON in order within a group."""
    w = Window.partitionBy(*group).orderBy(order)
    rows = df.withColumn("_b", F.octet_length(F.to_json(F.struct(*df.columns))))
    before = F.coalesce(F.sum("_b").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumns({"part": F.floor(before / target_bytes).cast("long"), "row_bytes": F.col("_b").cast("long")}).drop("_b")


def write_parts(df: DataFrame, group: list[str], order: str, target_bytes: int, path: str) -> DataFrame:
    """Write one folder per group and part; returns rows and bytes of each."""
    marked = parts(df, group, order, target_bytes)
    marked.drop("row_bytes").write.partitionBy(*group, "part").json(path)
    return marked.groupBy(*group, "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("row_bytes").alias("bytes"))


def manifest(chunks: DataFrame, series: str, order: str) -> DataFrame:
    """Per series its chunks in order as JSON, their number and bytes, and whether positions are 0, 1, .. without a gap."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("position"), "name", "sha256", "bytes")))
    return chunks.groupBy(series).agg(
        F.to_json(listed).alias("chunks"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
        ((F.min(order) == 0) & (F.max(order) == F.count(F.lit(1)) - 1) & (F.count_distinct(order) == F.count(F.lit(1)))).alias("complete"),
    )


def merge_receipts(existing: DataFrame, incoming: DataFrame, keys: list[str], content: str, stamp: str) -> DataFrame:
    """Per incoming key ``outcome`` insert, noop or conflict, and the first timestamp that stands.

    Within the incoming rows the earliest of equal content stands; different content under one key is a conflict.
    """
    new = incoming.groupBy(*keys).agg(F.min(content).alias("_c"), F.max(content).alias("_d"), F.min(stamp).alias("_t"))
    old = existing.groupBy(*keys).agg(F.min(content).alias("_oc"), F.min(stamp).alias("_ot"))
    met = new.join(old, keys, "left")
    outcome = F.when(F.col("_c") != F.col("_d"), "conflict").when(F.col("_oc").isNull(), "insert").when(F.col("_oc") == F.col("_c"), "noop").otherwise("conflict")
    return met.select(*keys, outcome.alias("outcome"), F.coalesce("_ot", "_t").alias("stamp"))


def public_view(receipts: DataFrame, private: list[str]) -> DataFrame:
    """Rows without private columns; what they held is said by ``redacted``."""
    held = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in private]))
    return receipts.withColumn("redacted", F.array_join(held, ",")).drop(*private)


def to_linestring(df: DataFrame, group: str, order: str) -> DataFrame:
    """(group, wkt): LINESTRING Z of ordered samples with three decimals."""
    points = F.transform(F.array_sort(F.collect_list(F.struct(order, "x", "y", "z"))), lambda p: F.format_string("%.3f %.3f %.3f", p["x"], p["y"], p["z"]))
    return df.groupBy(group).agg(F.concat(F.lit("LINESTRING Z ("), F.array_join(points, ", "), F.lit(")")).alias("wkt"), F.count(F.lit(1)).alias("points"))


def write_shards(df: DataFrame, by: str, path: str) -> DataFrame:
    """One folder per value; returns rows and a digest that no order changes: the sum of the first 60 bits of the rows' SHA-256, in which a
    repeated row counts as often as it occurs."""
    df.write.partitionBy(by).parquet(path)
    bits = F.conv(F.substring(canon_hash(*[F.col(c) for c in df.columns]), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(bits).alias("digest"))
