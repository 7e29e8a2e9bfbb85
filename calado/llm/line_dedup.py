"""Line dedup: lines that many documents share stay only in one of them."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calado.llm._shared import BLANKS, materialise


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _digest(key: Column) -> Column:
    """128 bits of a key: at 10^12 lines one pair of different keys in 10^14 tables would meet."""
    return F.struct(F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2"))


def drop_shared_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drop lines whose key has ``min_chars`` code points or more and is in ``min_docs`` documents or more.

    The largest ``doc_id`` that holds such a key keeps all its lines with that key. Returns the rows of
    ``docs`` with ``text`` replaced, and ``n_lines`` (before dropping) and ``n_dropped`` added (they replace
    columns of these names).

    Null or empty text is one empty line, and becomes empty text. Documents are told apart by ``doc_id``:
    repeated rows of one id count once and get the same result; rows with a null id count as no document,
    so they hold no key for themselves, and lose the lines that others share. An empty table gives an empty table.

    Lines are exploded to (id, position, digest) only, digests are counted with partial aggregation, and
    positions to drop go back to the texts in one join; kept lines are cut out between those positions.
    """
    extra = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    long = docs.select(
        F.col("doc_id").alias("_id"),
        F.xxhash64("text").alias("_th"),
        F.posexplode(F.transform(lines, line_key)).alias("_pos", "_key"),
    ).where(F.char_length("_key") >= min_chars)
    seen = materialise(long.select("_id", "_th", "_pos", _digest(F.col("_key")).alias("_d")).select("_id", "_th", "_pos", "_d.*"), "lines")
    counted = seen.groupBy("h1", "h2").agg(F.countDistinct("_id").alias("_n"), F.max("_id").alias("_keeper"))
    # Written, so that the join below has shuffles of its own on both sides and a common line's rows can be split.
    shared = materialise(counted.where(F.col("_n") >= min_docs).drop("_n"), "shared")
    gone = (
        seen.join(shared, ["h1", "h2"])
        .where(~F.col("_id").eqNullSafe(F.col("_keeper")))
        .groupBy("_id", "_th")
        .agg(F.sort_array(F.collect_set("_pos")).alias("_gone"))
    )
    rows = docs.select(*extra, F.xxhash64("text").alias("_rh"))
    met = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_rh") == F.col("_th")), "left")
    cut = F.coalesce("_gone", F.array().cast("array<int>"))
    end = F.size("_lines")
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("_cut")),
        lambda i: F.slice(
            F.col("_lines"),
            F.coalesce(F.get(F.col("_cut"), i - 1), F.lit(-1)) + 2,
            F.coalesce(F.get(F.col("_cut"), i), end) - F.coalesce(F.get(F.col("_cut"), i - 1), F.lit(-1)) - 1,
        ),
    )
    split = met.withColumns({"_lines": lines, "_cut": cut})
    kept = F.when(F.size("_cut") == 0, F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(F.flatten(pieces), "\n"))
    return split.select(
        *[kept.alias("text") if c == "text" else F.col(c) for c in extra],
        end.cast("long").alias("n_lines"),
        F.size("_cut").cast("long").alias("n_dropped"),
    )
