"""Queries of the catalogue operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import catalogue as C
from calado.plans._query import query
from calado.plans.aggregate import INDEX


@query(
    "C01_state_index",
    """WITH q AS (SELECT o_custkey AS k, count(*) AS n, max('q' || o_orderkey) AS a FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), p AS (SELECT o_custkey AS k, count(*) AS n, max('p' || o_orderkey) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), r AS (SELECT o_custkey AS k, count(*) AS n, max('r' || o_orderkey) AS a FROM orders WHERE o_orderkey % 29 = 0 GROUP BY 1)
    SELECT coalesce(q.k, p.k, r.k) AS source_set_id, CASE WHEN r.n IS NOT NULL THEN 'recovered' WHEN p.n IS NOT NULL THEN 'preserved' ELSE 'queued' END AS state, CASE WHEN r.n IS NULL AND p.n IS NULL THEN 'acquire' ELSE 'skip' END AS action, coalesce(r.a, p.a, q.a) AS locator, coalesce(p.n, 0) AS n_preserved, coalesce(r.n, 0) AS n_recovered
    FROM q FULL JOIN p ON q.k = p.k FULL JOIN r ON coalesce(q.k, p.k) = r.k""",
)
def _(t):
    rows = lambda where, mark: t("orders").where(where).select(F.col("o_custkey").alias("source_set_id"), F.concat(F.lit(mark), F.col("o_orderkey")).alias("locator"))
    return C.state_index(rows("o_orderstatus = 'O'", "q"), rows("o_orderstatus = 'F'", "p"), rows("o_orderkey % 29 = 0", "r"))


@query(
    "C02_primary_decision",
    """WITH i AS (SELECT source_set_id, min(state) AS state, min(action) AS action FROM idx GROUP BY 1) SELECT o_orderkey, CASE WHEN state IS NULL THEN 'proceed' WHEN action = 'never' THEN 'block' WHEN state IN ('preserved', 'recovered') AND NOT o_orderkey % 5 = 0 THEN 'skip' ELSE 'proceed' END AS decision FROM orders LEFT JOIN i ON o_custkey = source_set_id""",
    idx=INDEX,
)
def _(t, index):
    once = index.groupBy("source_set_id").agg(F.min("state").alias("state"), F.min("action").alias("action"))
    requests = t("orders").select("o_orderkey", F.col("o_custkey").alias("source_set_id"), (F.col("o_orderkey") % 5 == 0).alias("forced"))
    return C.primary_decision(requests, once).select("o_orderkey", "decision")


@query(
    "C03_check_authorisation",
    """WITH g AS (SELECT c_custkey AS grant_id, CASE WHEN c_acctbal > 0 THEN 'approve' ELSE 'refuse' END AS decision, c_nationkey AS n, c_mktsegment AS plane, c_acctbal > 3000 AS pub FROM customer WHERE c_custkey % 10 <> 3)
    SELECT o_orderkey, CASE WHEN g.grant_id IS NULL THEN 'no_grant' WHEN decision <> 'approve' THEN 'not_approved' WHEN o_orderkey % 25 NOT IN (n, n + 1, n + 2) THEN 'source_not_listed' WHEN plane <> 'BUILDING' THEN 'other_plane' WHEN o_orderkey % 2 = 0 AND NOT pub THEN 'publication' ELSE 'ok' END AS verdict FROM orders LEFT JOIN g ON o_custkey = grant_id""",
)
def _(t):
    n = F.col("c_nationkey").cast("long")
    grants = t("customer").where("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("grant_id"), F.when(F.col("c_acctbal") > 0, "approve").otherwise("refuse").alias("decision"), F.array(n, n + 1, n + 2).alias("sources"), F.col("c_mktsegment").alias("granted_plane"), (F.col("c_acctbal") > 3000).alias("may_publish"))
    requests = t("orders").select("o_orderkey", F.col("o_custkey").alias("grant_id"), (F.col("o_orderkey") % 25).alias("source_set_id"), F.lit("BUILDING").alias("plane"), (F.col("o_orderkey") % 2 == 0).alias("publish"))
    return C.check_authorisation(requests, grants).select("o_orderkey", "verdict")


@query(
    "C04_rights_gate",
    """WITH m AS (SELECT p_partkey AS k, CASE WHEN p_size % 3 <> 0 THEN 'verified' ELSE 'open' END AS reuse, CASE WHEN p_size % 5 <> 0 THEN 'gate' ELSE '' END AS gate, CASE WHEN p_size % 2 = 0 THEN 'text' ELSE 'asset' END AS chk, CASE WHEN p_size % 7 <> 0 THEN 'by' END AS licence, p_size > 20 AS ok FROM part)
    SELECT l_orderkey, l_linenumber, CASE WHEN k IS NULL THEN 'not_listed' WHEN reuse <> 'verified' THEN 'reuse_not_verified' WHEN gate = '' THEN 'no_gate' WHEN NOT CASE WHEN chk = 'text' THEN licence IS NOT NULL ELSE ok END THEN 'licence' ELSE 'ok' END AS verdict FROM lineitem LEFT JOIN m ON l_partkey + l_linenumber * 10 = k""",
)
def _(t):
    p = t("part")
    size = F.col("p_size")
    manifests = p.select(F.col("p_partkey").alias("source_set_id"), F.when(size % 3 != 0, "verified").otherwise("open").alias("reuse"), F.when(size % 5 != 0, "gate").otherwise("").alias("gate"), F.when(size % 2 == 0, "text").otherwise("asset").alias("check"), F.when(size % 7 != 0, "by").alias("licence"), (size > 20).alias("asset_ok"))
    items = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") + F.col("l_linenumber") * 10).alias("source_set_id"))
    return C.rights_gate(items, manifests).select("l_orderkey", "l_linenumber", "verdict")


@query(
    "C05_expand_package",
    """SELECT DISTINCT c_mktsegment || '-' || lpad(CAST(m AS VARCHAR), 7, '0') || '-' || CAST(y AS VARCHAR) AS request, m AS indicator, y AS year FROM (SELECT c_mktsegment, CAST(unnest([c_nationkey, c_nationkey + 1]) AS INTEGER) AS m, CAST(1990 + c_custkey % 40 AS BIGINT) AS y FROM customer) WHERE y BETWEEN 2000 AND 2024""",
)
def _(t):
    packages = t("customer").select(F.col("c_mktsegment").alias("package"), F.array("c_nationkey", F.col("c_nationkey") + 1).alias("members"), (1990 + F.col("c_custkey") % 40).alias("year"))
    return C.expand_package(packages, 2000, 2024)


@query(
    "C06_admit",
    """WITH a AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'wrong' ELSE split_part(text, ' ', 2) END AS raw FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
    SELECT a.doc_id AS observation_key, CASE WHEN st = 'admitted' THEN quality END AS value, st AS status FROM (SELECT a.doc_id, l.quality, CASE WHEN raw IN ('', 'the', 'de') THEN 'marker' WHEN l.quality IS NULL THEN 'not_observed' WHEN raw <> split_part(d.text, ' ', 2) THEN 'raw_differs' ELSE 'admitted' END AS st FROM a JOIN documents d USING (doc_id) LEFT JOIN (SELECT * FROM labels WHERE toxic = 0) l USING (doc_id)) a""",
)
def _(t):
    docs, labels = t("documents"), t("labels")
    second = F.coalesce(F.try_element_at(F.split("text", " "), F.lit(2)), F.lit(""))
    approved = docs.join(labels.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("observation_key"), F.when(F.col("doc_id") % 4 == 0, "wrong").otherwise(second).alias("raw_value"), F.col("doc_id").alias("source_line"), F.lit(2).alias("source_col"))
    rows = labels.where("toxic = 0").select(F.col("doc_id").alias("observation_key"), F.col("quality").alias("value"))
    return C.admit(rows, approved, docs.select(F.col("doc_id").alias("source_line"), F.col("text").alias("line_text")), ["", "the", "de"])


@query(
    "C07_evidence_gates",
    """WITH w AS (SELECT s_suppkey, f AS fact, n AS action FROM supplier, (VALUES ('A', 'ask'), ('N', 'measure'), ('X', 'survey')) v(f, n)), f AS (SELECT l_suppkey AS s_suppkey, l_returnflag AS fact, sum(l_quantity) AS value FROM lineitem WHERE l_quantity > 48 GROUP BY 1, 2)
    SELECT s_suppkey, fact, value, CASE WHEN value IS NULL THEN action END AS next_action FROM w LEFT JOIN f USING (s_suppkey, fact)""",
)
def _(t):
    facts = t("lineitem").where("l_quantity > 48").groupBy(F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("fact")).agg(F.sum("l_quantity").alias("value"))
    return C.evidence_gates(t("supplier"), facts, {"A": "ask", "N": "measure", "X": "survey"}, "s_suppkey")
