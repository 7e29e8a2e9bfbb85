"""Query of the streaming intake."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators.storage import shared_path
from calado.plans._query import query
from calado.streaming.receipts import run_intake


@query("Z01_receipt_stream", "SELECT DISTINCT 's' || o_custkey AS source, 'f' || o_orderkey % 50 AS fingerprint, 'c' || o_orderkey % 50 AS content FROM orders")
def _(t):
    """Orders land as receipts in several files, some twice; each (source, fingerprint) is accepted once."""
    rows = t("orders").select(F.concat(F.lit("s"), "o_custkey").alias("source"), F.concat(F.lit("f"), F.col("o_orderkey") % 50).alias("fingerprint"), F.concat(F.lit("c"), F.col("o_orderkey") % 50).alias("content"), F.col("o_orderkey").alias("stamp"))
    landed, accepted, conflicts, state = (shared_path(t.spark, n) for n in ("landed", "accepted", "conflicts", "state"))
    rows.unionByName(rows.where("stamp % 10 = 0")).repartition(8).write.json(landed)
    run_intake(t.spark, landed, accepted, conflicts, state)
    return t.spark.read.schema("source string, fingerprint string, content string, stamp bigint, batch bigint").parquet(accepted).select("source", "fingerprint", "content")
