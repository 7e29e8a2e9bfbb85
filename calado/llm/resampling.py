"""Importance resampling towards a target's distribution: array-scored weights, ranks from parallel sorting by regular sampling."""

from __future__ import annotations

import bisect
import itertools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calado.llm._shared import materialise

#: Every byte that is no part of a word becomes a blank; A-Z become a-z. Bytes of characters beyond ASCII stay.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_CHUNK = 1 << 20
_ORDER = ["_down", "_known", "doc_id", "n_features", "_tie"]


def _word_lists(text: bytes, max_n: int) -> Iterator[tuple[list[bytes], int]]:
    """(words, how many of them were given before) of chunks of about a megabyte: ``max_n`` - 1 words are given again, for the runs across a cut."""
    data, start, last = text.translate(_WORD_BYTES), 0, []
    while start < len(data):
        end = data.find(b" ", start + _CHUNK)
        end = len(data) if end < 0 else end
        words = last + data[start:end].split()
        yield words, len(last)
        last, start = words[len(words) - max_n + 1 :] if max_n > 1 else [], end


def _buckets(words: list[bytes], old: int, max_n: int, buckets: int) -> np.ndarray:
    """Buckets of the runs of 1 to ``max_n`` words that end in a new word."""
    found = [np.fromiter(map(zlib.crc32, words[old:]), np.int64, len(words) - old)]
    for n in range(2, max_n + 1):
        runs = [b" ".join(words[i - n + 1 : i + 1]) for i in range(max(old, n - 1), len(words))]
        found.append(np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)))
    return np.concatenate(found) % buckets


def bucket_counts(texts: DataFrame, max_n: int = 1, buckets: int = 10_000, column: str = "text") -> np.ndarray:
    """Features of all texts by bucket. Each task adds up its texts in one array; the driver gets ``buckets`` sums."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for rows in batches:
            for text in rows.column(0):
                for words, old in _word_lists(text.as_py() or b"", max_n):
                    sums += np.bincount(_buckets(words, old, max_n, buckets), minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    found = texts.select(F.col(column).cast("binary")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and source, rounded down."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + n) / ((s + 1) * (all_t + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(docs: DataFrame, gains: np.ndarray, max_n: int) -> DataFrame:
    """Add ``n_features``, ``_words`` and ``weight`` to rows (doc_id, _kept, text)."""
    kinds = docs.drop("text").schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "n_features bigint, _words bigint, weight bigint"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for text in rows.column("text"):
                features = n = total = 0
                for words, old in _word_lists(text.as_py() or b"", max_n):
                    at = _buckets(words, old, max_n, len(gains))
                    features, n, total = features + len(at), n + len(words) - old, total + int(gains[at].sum())
                found.append((features, n, total // features if features else 0))
            numbers = [pa.array(x, pa.int64()) for x in (zip(*found, strict=True) if found else ([], [], []))]
            yield pa.RecordBatch.from_arrays([*(rows.column(f.name) for f in kinds), *numbers], [*(f.name for f in kinds), "n_features", "_words", "weight"])

    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(weigh, schema)


def _luck(doc_id: Column, seed: int) -> Column:
    """A seeded Gumbel number of the document in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def regular_samples(runs: DataFrame, order: list[str], per_run: int) -> DataFrame:
    """From each sorted run ``per_run`` to twice as many rows at equal steps, with the step as ``_step``: one pass, which keeps every
    2^k-th row and drops every other one when there are too many."""
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in runs.select(*order).schema]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, seen, kept, schema = 1, 0, [], None
        for rows in batches:
            schema = rows.schema
            first = -seen % step
            kept += [(seen + first + i * step, row) for i, row in enumerate(rows.take(pa.array(range(first, rows.num_rows, step), pa.int64())).to_pylist())]
            seen += rows.num_rows
            while len(kept) > 2 * per_run:
                step *= 2
                kept = [x for x in kept if x[0] % step == 0]
        if kept:
            out = pa.Table.from_pylist([row for _, row in kept], schema).append_column("_step", pa.array([step] * len(kept), pa.int64()))
            yield from out.to_batches()

    return runs.select(*order).sortWithinPartitions(*order).mapInArrow(sample, ", ".join([*names, "_step bigint"]))


def splitters(samples: DataFrame, order: list[str], segments: int) -> list[tuple]:
    """The keys that part the weighted samples into ``segments`` equal shares: at most ``segments`` - 1."""
    rows = sorted((tuple(r[c] for c in order), r["_step"]) for r in samples.collect())
    sums = list(itertools.accumulate(step for _, step in rows))
    at = [bisect.bisect_left(sums, k * sums[-1] / segments) for k in range(1, segments)] if rows else []
    return [rows[i][0] for i in sorted(set(at))]


def _deal(rows: DataFrame, order: list[str], cuts: list[tuple]) -> DataFrame:
    """Add ``_segment``: how many of the splitters lie before the row; -1 for rows that take no part."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "_segment int"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("_part").to_pylist()
            keys = zip(*(batch.column(c).to_pylist() for c in order), strict=True)
            found = [bisect.bisect_left(cuts, k) if p else -1 for k, p in zip(keys, part, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())], [*batch.schema.names, "_segment"])

    return rows.mapInArrow(deal, schema)


def _number(rows: DataFrame) -> DataFrame:
    """Add ``_at``: the place of a row in its segment, from 1; rows come sorted, a segment in one partition."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "_at bigint"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, n = None, 0
        for batch in batches:
            found = []
            for s in batch.column("_segment").to_pylist():
                segment, n = s, n + 1 if s == segment else 1
                found.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], [*batch.schema.names, "_at"])

    return rows.mapInArrow(number, schema)


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    max_n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    keep: list[str] | None = None,
    segments: int | None = None,
    samples_per_run: int = 64,
) -> DataFrame:
    """Rows (doc_id, the columns ``keep``, n_features, weight, score, rank) of all documents; ``rank`` 1, 2, .. of those drawn, else null.

    Features are the runs of 1 to ``max_n`` words, hashed to ``buckets``. A document's weight is the mean log ratio of its
    buckets' shares in ``target`` and in ``docs``, in thousandths; its score adds a seeded Gumbel number, so that the ``percent`` of
    highest scores are a draw without replacement in proportion to the ratios. Of documents below ``min_words`` none is drawn.

    Ranks come from parallel sorting by regular sampling. Each task sorts its rows, a run; rows at equal steps of the runs
    give splitters; each row goes to the segment between its splitters, whose sort merges what the runs sent; counts of the
    segments before give exact ranks. Segments wholly beyond the draw are not exchanged. Keys are unique (ties of score and
    doc_id are told apart by features and then by a number written with the rows), so no repeated key outgrows a segment. The driver
    gets ``buckets`` counts, at most twice ``samples_per_run`` keys a run, and one count a segment (by default as many as shuffle
    partitions, at most 1024).

    Null and empty texts, and texts without a word, have 0 features and weight 0. A null doc_id is hashed as an empty one and comes
    first among ties. Repeated rows take part each, with ranks of their own; without a target text all shares are as if
    smoothed from nothing. Texts are read whole, in chunks of about a megabyte. Other columns of ``docs`` do no harm, whatever their names.
    """
    keep = [c for c in keep or [] if c not in ("doc_id", "n_features", "weight", "score", "rank")]
    spark = docs.sparkSession
    segments = segments or max(1, min(1024, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    gains = bucket_gains(bucket_counts(docs, max_n, buckets), bucket_counts(target, max_n, buckets))
    kept = F.struct(F.lit(0).alias("_"), *keep).alias("_kept")
    weighed = _weigh(docs.select("doc_id", kept, "text"), gains, max_n)
    scored = weighed.withColumns({"score": F.col("weight") + _luck(F.col("doc_id"), seed), "_tie": F.monotonically_increasing_id(), "_part": F.col("_words") >= min_words})
    scored = materialise(scored.drop("_words").withColumns({"_down": -F.col("score"), "_known": F.col("doc_id").isNotNull()}), "scored")

    cuts = splitters(regular_samples(scored.where("_part"), _ORDER, samples_per_run), _ORDER, segments)
    dealt = materialise(_deal(scored, _ORDER, cuts), "dealt")
    counts = dict(dealt.where("_part").groupBy("_segment").count().collect())
    drawn = percent * sum(counts.values()) // 100
    before = [0, *itertools.accumulate(counts.get(s, 0) for s in range(len(cuts) + 1))]
    last = bisect.bisect_left(before, drawn)  # segments from here on lie beyond the draw
    columns = ["doc_id", *[F.col(f"_kept.`{c}`").alias(c) for c in keep], "n_features", "weight", "score"]
    beyond = dealt.where(~F.col("_part") | (F.col("_segment") >= last)).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    if not last:
        return beyond
    exchanged = dealt.where(F.col("_part") & (F.col("_segment") < last)).repartitionById(last, F.col("_segment"))
    place = F.element_at(F.array(*[F.lit(n) for n in before[:last]]), F.col("_segment") + 1) + F.col("_at")
    ranked = _number(exchanged.sortWithinPartitions("_segment", *_ORDER)).withColumn("_place", place.cast("bigint"))
    return ranked.select(*columns, F.when(F.col("_place") <= drawn, F.col("_place")).alias("rank")).union(beyond)
