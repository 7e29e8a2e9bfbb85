"""Hard negatives by slot-decomposed selection: one pass for positives, one for the top of disjoint slots of scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.llm._shared import materialise

#: Bytes of scores that a task holds at once, of the anchors of a block and of the rows of a block as doubles; blocks of rows a task.
_SCORES, _ANCHORS, _ROWS, _RUN = 1 << 24, 1 << 25, 1 << 22, 16
_BLOCK = "ids binary, labels binary, vectors binary"
_FOUND = "anchor_id bigint, slot int, score bigint, vec_id bigint"


def whole_vectors(vectors: DataFrame, vector: str, scale: int = 256, limit: int = 1 << 20) -> DataFrame:
    """Rows (vec_id, label, v): components as floor(scale * x), rows that take no part left out, one row a vec_id."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & sound)
    held = F.forall("v", lambda c: F.abs(c) < limit)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), x.alias("v"))
    fits = F.assert_true(held, F.lit(f"components of {limit} and more after scaling: inner products would not be exact"))
    rows = rows.withColumn("v", F.when(fits.isNull(), F.transform("v", lambda c: c.cast("int"))))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("_r")).select("vec_id", "_r.label", "_r.v")


def _bytes(rows: pa.RecordBatch | pa.Table, dims: int, kind: str) -> list[pa.Array]:
    """Ids, labels and vectors of rows as one binary value each; short vectors are filled with zeros."""
    v = rows.column("v")
    v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
    full = np.zeros((rows.num_rows, dims), kind)
    full[np.arange(dims) < np.diff(v.offsets.to_numpy())[:, None]] = v.flatten().to_numpy()
    return [pa.array([x.tobytes()], pa.binary()) for x in (*(np.asarray(rows.column(c).to_numpy(), np.int64) for c in ("vec_id", "label")), full)]


def pack(rows: DataFrame, dims: int, kind: str) -> DataFrame:
    """Blocks of rows (vec_id, label, v) as one row of arrays in bytes."""
    size = max(1, _ROWS // (8 * dims))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                yield pa.RecordBatch.from_arrays(_bytes(batch.slice(start, size), dims, kind), ["ids", "labels", "vectors"])

    return rows.select("vec_id", "label", "v").mapInArrow(blocks, _BLOCK)


def _arrays(row: dict, side: str, dims: int, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[f"{side}{k}"], np.int64) for k in ("ids", "labels"))
    return ids, labels, np.frombuffer(row[f"{side}vectors"], kind).reshape(-1, dims)


def _first(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each (anchor, slot): higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])]) if len(order) else np.empty(0, np.int64)
    return order[np.arange(len(order)) - np.repeat(new, np.diff(np.r_[new, len(order)])) < k]


def _positives(ids, labels, scores, other_ids, other_labels, k, _limits):
    """(row, slot, column) of the best ``k`` same-label columns of each row of scores, ties at the last place included."""
    for label in np.intersect1d(labels, other_labels):
        mine, theirs = np.flatnonzero(labels == label), np.flatnonzero(other_labels == label)
        part = scores[np.ix_(mine, theirs)]
        part[ids[mine][:, None] == other_ids[theirs]] = -np.inf
        top = np.partition(part, len(theirs) - k, 1)[:, len(theirs) - k] if len(theirs) > k else np.full(len(mine), -np.inf)
        a, b = np.nonzero((part >= top[:, None]) & (part > -np.inf))
        yield mine[a], np.zeros(len(a), np.int64), theirs[b]


def _slotted(ids, labels, scores, other_ids, other_labels, k, limits):
    """(row, slot, column) of different-label columns in a window of their row. Slot j has the scores from limit j down to limit j + 1,
    which is left out; no window reaches below the last lower limit."""
    upper, lowest = limits
    a, b = np.nonzero((scores <= upper[:, :1]) & (scores >= lowest[:, None]) & (labels[:, None] != other_labels))
    yield a, (scores[a, b][:, None] <= upper[a]).sum(1) - 1, b


def _search(pairs: DataFrame, choose, dims: int, kind: str, k: int, n_limits: int = 0) -> DataFrame:
    """Rows of ``_FOUND`` from pairs of an anchor block and a row block: what ``choose`` picks from their scores, the first ``k`` a slot."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                ids, labels, vectors = _arrays(row, "a_", dims, kind)
                other_ids, other_labels, others = _arrays(row, "", dims, kind)
                others = others.T.astype(np.float64)
                limits = np.frombuffer(row["a_limits"]).reshape(len(ids), n_limits + 1) if n_limits else None
                step = max(1, _SCORES // (8 * len(other_ids)))
                for i in range(0, len(ids), step):
                    scores = vectors[i : i + step].astype(np.float64) @ others
                    held = limits is not None and (limits[i : i + step, :-1], limits[i : i + step, -1])
                    for a, slot, b in choose(ids[i : i + step], labels[i : i + step], scores, other_ids, other_labels, k, held):
                        score = scores[a, b].astype(np.int64)
                        at = _first(a, slot, score, other_ids[b], k)
                        columns = [ids[i + a[at]], slot[at].astype(np.int32), score[at], other_ids[b[at]]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "slot", "score", "vec_id"])

    return pairs.mapInArrow(search, _FOUND)


def _first_of(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each (anchor, slot) with their ``rank``; Spark drops later ones before the shuffle."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    vector: str = "embedding",
    anchor_every: int = 100,
    n_positives: int = 5,
    n_negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by ``anchor_every``; scores are inner products of the whole-number vectors. An
    anchor's positives are its best ``n_positives`` other rows of its label. For each positive come the best ``n_negatives`` rows of other
    labels whose score is ``low`` to ``high`` percent of the positive's; ties go to smaller ids.

    All windows of an anchor overlap, so each row is looked at once for all of them: the positives' upper limits part the scores
    into disjoint slots, tasks and then the shuffle keep the best ``n_negatives`` of each slot, and the best below a positive's limit are
    those of its slot and the ones after it, in this order. The lower limit then cuts that list's end.

    Anchors and rows are packed into blocks (32 MB of anchors, 4 MB of rows as doubles; two bytes a component where they fit). Every block of
    anchors meets every block of rows, in runs of 16, one pair of blocks a row of the join; a task holds one pair and 16 MB of scores, and for
    each anchor a pair sends at most ``n_negatives`` rows a slot. Nothing goes to the driver but the length of the longest vector, the largest
    component and counts. The work is anchors times rows, as it is for any exact search.

    Rows with a null id or label, a null vector or a null or non-finite component take no part. Rows are told apart by vec_id: of repeated
    ones the least by label and vector stays. Shorter vectors count as filled with zeros; empty ones score 0. A scaled component of
    2^20 or more is an error, as scores would not be exact. Anchors without positives have no rows; nor do positives of negative
    score. An empty table gives an empty table. Other columns do no harm, whatever their names.
    """
    rows = materialise(whole_vectors(vectors.select("vec_id", "label", vector), vector, scale), "vectors")
    is_anchor = F.col("vec_id") % anchor_every == 0
    largest = F.max(F.array_max(F.transform("v", F.abs)))
    dims, size, n_anchors = rows.agg(F.max(F.size("v")), largest, F.count_if(is_anchor)).first()
    dims, kind = max(dims or 0, 1), "i2" if (size or 0) < 1 << 15 else "i4"
    packed = materialise(pack(rows, dims, kind), "blocks")
    n_runs, n_blocks = -(-packed.count() // _RUN), max(1, -(-n_anchors * 8 * dims // _ANCHORS))
    spread = packed.withColumns({"_run": _scattered("ids", n_runs), "_block": F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))})

    anchors = rows.where(is_anchor).select("vec_id", "label", "v", _scattered("vec_id", n_blocks).alias("_block"))
    found = _search(_paired(spread, anchors, n_runs, dims, kind, 0), _positives, dims, kind, n_positives)
    positives = materialise(_first_of(found, n_positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    ladder = F.sort_array(F.collect_set("positive_score"), asc=False)
    limits = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(ladder.alias("_limits"))
    windows = F.transform("_limits", lambda p: F.when(p >= 0, p * low / high))
    limits = limits.select("vec_id", F.concat(F.transform("_limits", lambda p: p.cast("double")), F.array_repeat(F.lit(float("-inf")), n_positives - F.size("_limits"))).alias("_upper"), F.array_min(windows).alias("_lowest"))
    limits = limits.where(F.col("_lowest").isNotNull()).withColumn("_limits", F.concat("_upper", F.array("_lowest")))
    met = anchors.join(limits.select("vec_id", "_limits"), "vec_id")
    best = _first_of(_search(_paired(spread, met, n_runs, dims, kind, n_positives), _slotted, dims, kind, n_negatives, n_positives), n_negatives)

    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("_best"))
    # Descending scores run through the slots in order, so "the positive's slot and those after it" are the scores up to its limit.
    below = F.slice(F.filter("_best", lambda n: -n["down"] <= F.col("positive_score")), 1, n_negatives)
    reached = F.filter(below, lambda n: low * F.col("positive_score") <= -high * n["down"])
    out = positives.join(lists, "anchor_id").select("anchor_id", "positive_id", "positive_score", F.posexplode(reached).alias("_at", "_n"))
    return out.select("anchor_id", "positive_id", (F.col("_at") + 1).cast("int").alias("rank"), F.col("_n.vec_id").alias("negative_id"), "positive_score", (-F.col("_n.down")).alias("negative_score"))


def _scattered(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(max(n, 1))).cast("int")


def _paired(spread: DataFrame, anchors: DataFrame, n_runs: int, dims: int, kind: str, n_limits: int) -> DataFrame:
    """Pairs of blocks: rows of ``spread`` with the arrays of the anchors (vec_id, label, v, [_limits,] _block) of their ``_block``. Blocks of
    anchors go to each run of blocks of rows, so that no task gets all rows that meet one."""
    schema = "_block int, a_ids binary, a_labels binary, a_vectors binary, a_limits binary"

    def block(key: tuple, table: pa.Table) -> pa.Table:
        held = np.asarray(table.column("_limits").combine_chunks().flatten().to_numpy(), np.float64) if n_limits else np.empty(0)
        columns = [pa.array([key[0].as_py()], pa.int32()), *_bytes(table, dims, kind), pa.array([held.tobytes()], pa.binary())]
        return pa.Table.from_arrays(columns, ["_block", "a_ids", "a_labels", "a_vectors", "a_limits"])

    blocks = materialise(anchors.groupBy("_block").applyInArrow(block, schema), "anchors")
    return spread.join(blocks.withColumn("_run", F.explode(F.sequence(F.lit(0), F.lit(max(n_runs, 1) - 1)))), ["_block", "_run"])
