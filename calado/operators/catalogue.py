"""Catalogue and governance: state index, decisions, authorisation, rights, packages, admission, evidence gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_failing(rules: list[tuple[str, Column]], passed: str = "ok") -> Column:
    """The name of the first rule that does not hold (null counts as not), else ``passed``."""
    out = F.lit(passed)
    for name, holds in reversed(rules):
        out = F.when(~F.coalesce(holds, F.lit(False)), name).otherwise(out)
    return out


def state_index(queued: DataFrame, preserved: DataFrame, recovered: DataFrame, key: str = "source_set_id") -> DataFrame:
    """Per source the state, default action and locator; what was recovered goes before what was preserved, then the queue."""
    flat = lambda df, name: df.groupBy(key).agg(F.count(F.lit(1)).alias(f"n_{name}"), F.max("locator").alias(f"at_{name}"))
    parts = [flat(queued, "queued"), flat(preserved, "preserved"), flat(recovered, "recovered")]
    met = reduce(lambda a, b: a.join(b, key, "full_outer"), parts)
    state = F.when(F.col("n_recovered").isNotNull(), "recovered").when(F.col("n_preserved").isNotNull(), "preserved").otherwise("queued")
    action = F.when(state == "queued", "acquire").otherwise("skip")
    return met.select(
        key, state.alias("state"), action.alias("action"), F.coalesce("at_recovered", "at_preserved", "at_queued").alias("locator"),
        F.coalesce("n_preserved", F.lit(0)).alias("n_preserved"), F.coalesce("n_recovered", F.lit(0)).alias("n_recovered"),
    )


def primary_decision(requests: DataFrame, index: DataFrame, key: str = "source_set_id") -> DataFrame:
    """Unknown sources go on; ``never`` blocks even when forced; preserved ones are skipped unless forced."""
    met = requests.join(index.select(key, "state", "action"), key, "left")
    d = F.when(F.col("state").isNull(), "proceed").when(F.col("action") == "never", "block").when(F.col("state").isin("preserved", "recovered") & ~F.col("forced"), "skip").otherwise("proceed")
    return met.select(*requests.columns, d.alias("decision"))


def check_authorisation(requests: DataFrame, grants: DataFrame, key: str = "grant_id") -> DataFrame:
    """The first rule a request breaks: no grant, not approved, source not listed, other plane, sink or publication."""
    met = requests.join(grants.withColumn("_g", F.lit(True)), key, "left")
    rules = [
        ("no_grant", F.col("_g")),
        ("not_approved", F.col("decision") == "approve"),
        ("source_not_listed", F.array_contains("sources", F.col("source_set_id"))),
        ("other_plane", F.col("plane") == F.col("granted_plane")),
        ("publication", ~F.col("publish") | F.col("may_publish")),
    ]
    return met.select(*requests.columns, first_failing(rules).alias("verdict"))


def rights_gate(items: DataFrame, manifests: DataFrame, key: str = "source_set_id") -> DataFrame:
    """The first rule that an item's redistribution breaks: listed, verified, gated, associated, licence by kind of check."""
    met = items.join(manifests.withColumn("_m", F.lit(True)), key, "left")
    licence = F.when(F.col("check") == "text", F.col("licence").isNotNull()).when(F.col("check") == "asset", F.col("asset_ok")).otherwise(F.lit(False))
    rules = [("not_listed", F.col("_m")), ("reuse_not_verified", F.col("reuse") == "verified"), ("no_gate", F.length("gate") > 0), ("licence", licence)]
    return met.select(*items.columns, first_failing(rules).alias("verdict"))


def expand_package(packages: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """One row for each member and year: (request, indicator, year), once each; years outside the range are left out."""
    rows = packages.select("package", F.explode("members").alias("indicator"), "year")
    rows = rows.where(F.col("year").between(first_year, last_year)).distinct()
    request = F.concat_ws("-", "package", F.lpad(F.col("indicator").cast("string"), 7, "0"), F.col("year").cast("string"))
    return rows.select(request.alias("request"), "indicator", "year")


def admit(rows: DataFrame, approved: DataFrame, lines: DataFrame, markers: list[str]) -> DataFrame:
    """Approved observations whose raw token is at their line and column: (observation_key, value, status)."""
    token = F.try_element_at(F.split("line_text", " "), F.col("source_col"))
    met = approved.join(rows.select("observation_key", F.col("value").alias("_v")), "observation_key", "left").join(lines, "source_line", "left")
    status = (
        F.when(F.col("raw_value").isin(markers), "marker").when(F.col("_v").isNull(), "not_observed").when(~F.coalesce(token == F.col("raw_value"), F.lit(False)), "raw_differs").otherwise("admitted")
    )
    return met.select("observation_key", F.when(status == "admitted", F.col("_v")).alias("value"), status.alias("status"))


def evidence_gates(options: DataFrame, facts: DataFrame, expected: dict[str, str], key: str) -> DataFrame:
    """Every option with every expected fact; a fact not known stays null, with its next action."""
    want = F.explode(F.array(*[F.struct(F.lit(k).alias("fact"), F.lit(v).alias("action")) for k, v in expected.items()])).alias("_e")
    rows = options.select(key, want).select(key, "_e.fact", "_e.action")
    met = rows.join(facts.select(key, "fact", "value"), [key, "fact"], "left")
    return met.select(key, "fact", "value", F.when(F.col("value").isNull(), F.col("action")).alias("next_action"))
