"""Importance resampling: features, weights and ranks against plain loops; parallel sorting with many segments and hot keys."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from calado.llm import resampling as R


def plain(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]
    at = lambda t: [zlib.crc32(x.encode()) % buckets for x in runs(words(t))]
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for b in at(text):
            s[b] += 1
    for text in target:
        for b in at(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t, strict=True)]
    rows = []
    for doc_id, text in docs:
        found = at(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    part = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for i, r in enumerate(part[: percent * len(part) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def made(n, rng):
    words = ["Alpha", "beta", "ÉTÉ", "x-ray", "10", "the", "of", "zéro_b"]
    return [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(n)]


@pytest.mark.parametrize(("max_n", "segments", "percent"), [(1, 1, 10), (1, 7, 50), (2, 16, 100), (3, 4, 0)])
def test_as_plain_loops(spark, max_n, segments, percent):
    rng = random.Random(max_n)
    docs, target = made(400, rng), [t for _, t in made(30, rng)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    got = R.importance_ranks(df, spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n, segments=segments, percent=percent, samples_per_run=8)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, target, max_n=max_n, percent=percent)


def test_words_across_chunks(monkeypatch):
    """Runs of words do not depend on where a long text is cut."""
    text = " ".join(f"w{i % 13}" for i in range(500)).encode()
    whole = [b for words, old in R._word_lists(text, 3) for b in R._buckets(words, old, 3, 97).tolist()]
    monkeypatch.setattr(R, "_CHUNK", 11)
    parts = [b for words, old in R._word_lists(text, 3) for b in R._buckets(words, old, 3, 97).tolist()]
    assert sorted(whole) == sorted(parts) and len(whole) == 500 + 499 + 498


def test_one_key_of_most_rows(spark):
    """Rows that repeat one key are spread over segments, and get ranks of their own."""
    text = "some words of a text that repeats " * 4
    docs = spark.range(3000).select(F.when(F.col("id") < 2500, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(text).alias("text")).repartition(8)
    rows = R.importance_ranks(docs, docs.limit(5), percent=100, segments=10).select("rank").collect()
    assert sorted(r[0] for r in rows) == list(range(1, 3001))
    keyed = docs.withColumns({"_tie": F.monotonically_increasing_id(), "_down": F.lit(0)})
    cuts = R.splitters(R.regular_samples(keyed, ["_down", "doc_id", "_tie"], 16), ["_down", "doc_id", "_tie"], 10)
    at = R._deal(keyed.withColumn("_part", F.lit(True)), ["_down", "doc_id", "_tie"], cuts)
    sizes = [r[1] for r in at.groupBy("_segment").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 600


def test_samples_are_regular(spark):
    rows = spark.range(0, 1000, 1, 1).withColumnRenamed("id", "k")
    found = R.regular_samples(rows, ["k"], 10).collect()
    assert [r["k"] for r in found] == list(range(0, 1000, 64)) and {r["_step"] for r in found} == {64}


def test_samples_of_several_batches(spark):
    """A run's last batch may be shorter than the step, so that it gives no sample."""
    rows = spark.range(0, 20_001, 1, 1).withColumnRenamed("id", "k")
    assert [r["k"] for r in R.regular_samples(rows, ["k"], 64).collect()] == list(range(0, 20_001, 256))
    text = "some words of a text that repeats " * 4
    docs = spark.range(0, 20_001, 1, 1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    ranks = [r["rank"] for r in R.importance_ranks(docs, docs.limit(5), percent=50, segments=3).select("rank").collect()]
    assert sorted(x for x in ranks if x) == list(range(1, 10_001)) and len(ranks) == 20_001


def test_edges(spark):
    long = "Word " * 400_000
    docs = [(None, None, 1, "a"), (1, "", 2, "b"), (2, "?!", 3, "c"), (3, long, 4, "d"), (3, long, 4, "d"), (None, long, 5, "e")]
    df = spark.createDataFrame(docs, "doc_id long, text string, rank int, source string")
    empty = spark.createDataFrame([], "text string")
    got = R.importance_ranks(df, empty, percent=100, keep=["source", "rank"]).collect()
    assert sorted(((r["doc_id"], r["n_features"], r["source"]) for r in got), key=repr) == sorted([(None, 0, "a"), (1, 0, "b"), (2, 0, "c"), (3, 400_000, "d"), (3, 400_000, "d"), (None, 400_000, "e")], key=repr)
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3]
    assert all((r["weight"] == 0) for r in got if not r["n_features"])
    assert R.importance_ranks(df.limit(0), df).collect() == []
