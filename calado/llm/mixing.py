"""Mixing sources to target weights: Sainte-Lague quotas of equal blocks, then a seeded choice of blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.llm._shared import BLANKS, WORD, count_words, materialise

#: A prime modulus and a multiplier of a linear congruential sequence; any SQL engine can repeat them.
PRIME, STEP = 2147483647, 48271


def _scatter(x: Column, seed: int) -> Column:
    """A seeded pseudo-random long from 0 to PRIME - 1; null counts as -1."""
    x = F.pmod(F.coalesce(x, F.lit(-1)).cast("long"), F.lit(PRIME))
    once = F.pmod(x * STEP + seed, F.lit(PRIME))
    return F.pmod((once + F.shiftright(once, 15)) * STEP, F.lit(PRIME))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Add ``target`` to rows of (source, source_size).

    Sources in code-point order, null last, weigh ``weights`` in turn; together they get ``share`` times all
    sizes. A target stops at ``limit`` times its source's size; the excess is shared again by weight until none
    is above. In the order of limit per weight that is one pass of running sums over the sources.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("_w", weight).withColumn("_cap", limit * F.col("source_size"))
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", (share * F.sum("source_size").over(whole) - before) / left)
    fits = F.when(F.col("_level") <= F.col("_cap") / F.col("_w"), F.col("_level"))
    level = F.coalesce(F.max(fits).over(whole), F.lit(float("inf")))
    return rows.select("source", "source_size", F.least(F.col("_cap"), level * F.col("_w")).alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], weight: str, seats: str) -> DataFrame:
    """Add ``quota``: the ``seats`` of each group go to its parties by the highest quotients weight / (2k - 1).

    Seats that any of the two bounds on the last winning quotient settle are counted at once; only the
    quotients between the bounds, about two a party, are made and ranked. Ties: by quotient, then party.
    """
    g = Window.partitionBy(*group)
    total, n = F.sum(weight).over(g), F.count(F.lit(1)).over(g)
    sure = 2.0 * F.col(seats) - n
    at_most = lambda x: F.floor((F.col(weight) / x + 1) / 2)
    rows = parties.withColumn("_base", F.when((sure > 0) & (total > 0), F.greatest(at_most(total / sure) - 1, F.lit(0))).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("_top", F.when(total > 0, at_most(total / (2.0 * F.col(seats) + n)) + 1).otherwise(F.lit(0)).cast("long"))
    rows = rows.withColumn("_free", F.col(seats) - F.sum("_base").over(g))
    k = F.sequence(F.col("_base") + 1, F.greatest(F.col("_top"), F.col("_base") + 1))
    tried = rows.where((F.col(seats) > 0) & (F.col(weight) > 0)).withColumn("_k", F.explode(k))
    order = g.orderBy((F.col(weight) / (2 * F.col("_k") - 1)).desc(), *[F.col(c).asc_nulls_last() for c in party])
    won = tried.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= F.col("_free"))
    won = won.groupBy(*[F.col(c).alias(f"_g_{c}") for c in [*group, *party]]).agg(F.count(F.lit(1)).alias("_won"))
    same = None
    for c in [*group, *party]:
        same = F.col(c).eqNullSafe(F.col(f"_g_{c}")) if same is None else same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    met = rows.join(won, same, "left")
    return met.select(*parties.columns, (F.col("_base") + F.coalesce("_won", F.lit(0))).cast("long").alias("quota"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    limit: float = 2.0,
    block_words: int = 16,
    shard_words: int = 1 << 18,
    seed: int = 20240601,
    with_text: bool = False,
) -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Adds to the rows of ``docs`` (in place of columns of these names): ``size`` (words), ``source_size``,
    ``target`` (double, its source's), ``taken``, and ``spans``: the word spans [start, end) taken, one for each repeat.
    ``text`` is returned only ``with_text``.

    Each source is dealt into shards of about ``shard_words`` words by a seeded number from ``doc_id``; a shard's
    documents lie in seeded order on one line of words, cut into n blocks of ``block_words``. Sainte-Lague gives
    blocks to sources by target, then each source's blocks to its shards by size. A shard with quota q takes every
    block q div n times, and once more the q mod n blocks from a seeded block on, around the end; a block is taken
    ``limit`` times at most. As the order is seeded and blocks follow each other, documents stay whole but for those at
    the ends of that run.

    ``doc_id`` is an integer, or text that is one; other text is an error. Null or empty text has size 0 and takes 0. A null source is a source of its own, last in order. Repeated rows
    take part like any others. Reruns agree, whatever the partitions. An empty table gives an empty table.
    """
    keep = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken", "spans")]
    narrow = [c for c in keep if c != "text"]
    sized = docs.select(*keep, count_words(F.col("text")).alias("size"))
    if with_text:
        rows = sized.withColumn("_tie", F.xxhash64("text"))
    else:
        keep = narrow
        rows = sized = materialise(sized.select(*narrow, "size"), "sizes")
        rows = rows.withColumn("_tie", F.lit(0))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, limit).withColumn("_all", F.lit(0))
    seats = F.round(F.sum("target").over(Window.partitionBy("_all")) / block_words).cast("long")
    targets = sainte_lague(targets.withColumn("_seats", seats), ["_all"], ["source"], "target", "_seats")
    targets = materialise(
        targets.select(
            F.col("source").alias("_source"),
            "source_size",
            F.col("target").cast("double").alias("target"),
            F.col("quota").alias("_blocks"),
            F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long").alias("_shards"),
        ),
        "targets",
    )

    def dealt(df: DataFrame) -> DataFrame:
        met = df.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        return met.withColumn("_shard", F.pmod(_scatter(F.col("doc_id"), seed), F.col("_shards")))

    shards = dealt(sized.select("doc_id", "source", "size")).groupBy("_source", "_shard").agg(F.sum("size").alias("_words"), F.first("_blocks").alias("_blocks"))
    shards = sainte_lague(shards, ["_source"], ["_shard"], "_words", "_blocks")
    shards = shards.select(F.col("_source").alias("_s"), F.col("_shard").alias("_h"), F.ceil(F.col("_words") / block_words).cast("long").alias("_n"), F.col("quota").alias("_q"))
    shards = shards.withColumn("_q", F.least(F.col("_q"), int(limit) * F.col("_n")))
    shards = shards.withColumn("_first", F.when(F.col("_n") > 0, F.pmod(_scatter(F.col("_h"), seed + 2), F.col("_n"))).otherwise(F.lit(0)))
    shards = shards.withColumn("_more", F.when(F.col("_n") > 0, F.pmod("_q", "_n")).otherwise(F.lit(0)))

    line = Window.partitionBy("_source", "_shard").orderBy("_at", "doc_id", "size", "_tie")
    laid = dealt(rows).withColumn("_at", _scatter(F.col("doc_id"), seed + 1))
    laid = laid.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.join(shards, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
    start, b, last = F.col("_end") - F.col("size"), F.lit(block_words).cast("long"), F.col("_first") + F.col("_more")
    # The run of blocks taken once more, as words on the line; what runs past the last block goes on at the first.
    runs = [(F.col("_first") * b, F.least(last, F.col("_n")) * b), (F.lit(0).cast("long"), (last - F.col("_n")) * b)]
    parts = [F.struct((F.greatest(x, start) - start).alias("start"), (F.least(y, F.col("_end")) - start).alias("end")) for x, y in runs]
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")), F.floor(F.col("_q") / F.greatest(F.col("_n"), F.lit(1))).cast("int"))
    spans = F.filter(F.concat(whole, F.array(*parts)), lambda x: x["end"] > x["start"])
    laid = laid.withColumn("spans", F.when(F.col("size") > 0, spans).otherwise(F.slice(spans, 1, 0)))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, x: sum_ + x["end"] - x["start"])
    return laid.select(*keep, "size", "source_size", "target", taken.alias("taken"), "spans")


def take_spans(mixed: DataFrame) -> DataFrame:
    """The mix as documents: one row for each span of ``mix_sources(..., with_text=True)``, its text cut to that span.

    A span over the whole document leaves the text as it is; others keep the blanks between their words.
    """
    keep = [c for c in mixed.columns if c not in ("size", "source_size", "target", "taken", "spans")]
    rows = mixed.select(*keep, "size", F.explode("spans").alias("_span"))
    words = F.regexp_extract_all("text", F.lit(rf"({WORD}[\x20\x09-\x0D]*)"), 1)
    start, end = F.col("_span.start"), F.col("_span.end")
    cut = F.array_join(F.slice(words, (start + 1).cast("int"), (end - start).cast("int")), "")
    text = F.when((start == 0) & (end == F.col("size")), F.col("text")).otherwise(F.btrim(cut, F.lit(BLANKS)))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in keep])
