"""Queries of the sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators.storage import shared_path
from calado.plans._query import query
from calado.plans.aggregate import ASSETS
from calado.plans.sequence import PROFILE
from calado.sources import sinks as K


@query("K01_flat_csv", "SELECT o_orderkey, 'orders|' || o_orderstatus AS tags, '{\"s\":\"' || o_orderstatus || '\",\"c\":' || o_custkey || '}' AS extra, CAST(NULL AS VARCHAR) AS missing FROM orders")
def _(t):
    rows = t("orders").select("o_orderkey", F.array(F.lit("orders"), "o_orderstatus").alias("tags"), F.struct(F.col("o_orderstatus").alias("s"), F.col("o_custkey").alias("c")).alias("extra"))
    path = shared_path(t.spark, "flat")
    columns = ["o_orderkey", "tags", "extra", "missing"]
    K.write_flat_csv(rows, path, columns)
    back = t.spark.read.schema("o_orderkey bigint, tags string, extra string, missing string").option("header", True).option("escape", "\\").csv(path)
    return back


@query("K02_jsonl", "SELECT conv_id, turn, role, text FROM conversations")
def _(t):
    path = shared_path(t.spark, "lines")
    rows = t("conversations").select("conv_id", "turn", "role", "text")
    K.write_jsonl(rows, path)
    return t.spark.read.schema(rows.schema).json(path)


@query(
    "K03_parts",
    """WITH b AS (SELECT l_suppkey, l_orderkey * 10 + l_linenumber AS k, octet_length(encode('{"l_suppkey":' || l_suppkey || ',"k":' || (l_orderkey * 10 + l_linenumber) || ',"f":"' || l_returnflag || '"}')) AS n FROM lineitem),
    p AS (SELECT *, CAST(floor(coalesce(sum(n) OVER (PARTITION BY l_suppkey ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 2000) AS BIGINT) AS part FROM b)
    SELECT l_suppkey, part, count(*) AS rows, sum(n) AS bytes FROM p GROUP BY 1, 2""",
)
def _(t):
    rows = t("lineitem").select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("k"), F.col("l_returnflag").alias("f"))
    return K.parts(rows, ["l_suppkey"], "k", 2000).groupBy("l_suppkey", "part").agg(F.count(F.lit(1)).alias("rows"), F.sum("row_bytes").alias("bytes"))


@query(
    "K04_manifest",
    """SELECT source_set_id, '[' || string_agg('{"position":' || p || ',"name":"' || name || '","sha256":"' || sha256 || '","bytes":' || bytes || '}', ',' ORDER BY p, name, sha256, bytes) || ']' AS chunks, count(*) AS n, sum(bytes) AS bytes, min(p) = 0 AND max(p) = count(*) - 1 AND count(DISTINCT p) = count(*) AS complete
    FROM (SELECT *, CAST(replace(name, 'asset-', '') AS BIGINT) - 1 AS p FROM assets) GROUP BY source_set_id""",
    assets=ASSETS,
)
def _(t, assets):
    return K.manifest(assets.withColumn("p", F.replace("name", F.lit("asset-"), F.lit("")).cast("long") - 1), "source_set_id", "p")


@query(
    "K05_merge_receipts",
    """WITH o AS (SELECT o_custkey AS k, min(o_orderstatus) AS oc, min(o_orderkey) AS ot FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), n AS (SELECT o_custkey AS k, min(o_orderstatus) AS c, max(o_orderstatus) AS d, min(o_orderkey) AS t FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 5 = 0 GROUP BY 1)
    SELECT n.k AS source, CASE WHEN c <> d THEN 'conflict' WHEN oc IS NULL THEN 'insert' WHEN oc = c THEN 'noop' ELSE 'conflict' END AS outcome, coalesce(ot, t) AS stamp FROM n LEFT JOIN o ON n.k = o.k""",
)
def _(t):
    rows = t("orders").select(F.col("o_custkey").alias("source"), F.col("o_orderstatus").alias("c"), F.col("o_orderkey").alias("t"))
    return K.merge_receipts(rows.where("t % 2 = 0"), rows.where("t % 2 = 1 AND t % 5 = 0"), ["source"], "c", "t")


@query("K06_public_view", "SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 0 THEN 'c_name,balance' ELSE 'c_name' END AS redacted FROM customer")
def _(t):
    rows = t("customer").select("c_custkey", "c_mktsegment", "c_name", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return K.public_view(rows, ["c_name", "balance"])


@query("K07_to_linestring", "SELECT grp, 'LINESTRING Z (' || string_agg(printf('%.3f %.3f %.3f', x, s, z), ', ' ORDER BY seq) || ')' AS wkt, count(*) AS points FROM profile GROUP BY grp", profile=PROFILE)
def _(t, profile):
    return K.to_linestring(profile.withColumn("y", F.col("s")), "grp", "seq")


@query("K08_write_shards", "SELECT source, count(*) AS rows, CAST(sum(CAST('0x' || left(sha256(doc_id || chr(31) || coalesce(source, chr(9216)) || chr(31) || n_chars), 15) AS HUGEINT)) AS VARCHAR) AS digest FROM documents GROUP BY source")
def _(t):
    docs = t("documents").select("doc_id", "source", "n_chars")
    return K.write_shards(docs, "source", shared_path(t.spark, "shards")).withColumn("digest", F.col("digest").cast("string"))
