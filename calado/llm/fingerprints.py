"""Document fingerprints by order min-hash, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.llm._shared import WORD

#: Bits of a k-mer's place that a packed number holds; places of longer texts are kept in steps.
_PLACE_BITS = 24


def order_min_hash(text: Column, k: int = 3, picked: int = 2, slots: int = 64) -> Column:
    """A string of ``slots`` groups of 4 hex digits, one for each position of the signature; all ``----`` for text without words.

    K-mers of ``k`` words (one shorter k-mer for texts with fewer words) get the number of their occurrence in the text,
    so that repeats count. Position j takes the ``picked`` k-mers whose hashes, less j / ``slots`` of the hash space and around its
    end, are least: every position has a minimum of its own and as many k-mers as the text has, up to ``picked``. They are put
    back in text order and hashed together, so moving text about changes the position. Null is text without words.
    Equal texts have equal fingerprints.
    """
    bits = slots.bit_length() - 1
    assert 1 << bits == slots
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), 1)
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def with_words(h: Column) -> Column:
        n = F.size(h)
        starts = F.sequence(F.lit(1), F.greatest(n - k + 1, F.least(n, F.lit(1))))
        starts = F.when(n > 0, starts).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.coalesce(F.get(h, i + (j - 1)), F.lit(0)) for j in range(k)]))

    def number(m: Column) -> Column:
        """(hash of k-mer and occurrence, place) packed into longs, in no order."""
        n = F.size(m)
        step = F.greatest(F.lit(0), F.length(F.bin(n.cast("long"))) - _PLACE_BITS)
        pack = lambda v, i: F.shiftleft(F.shiftright(v, _PLACE_BITS), _PLACE_BITS) + F.expr("0L") + F.call_function("shiftright", i.cast("long"), step)
        plain = F.transform(m, lambda v, i: pack(F.xxhash64(v, F.lit(0)), i))

        def occurrences(s: Column) -> Column:
            # s: (k-mer, place) in order; a run of one k-mer counts 0, 1, .. up to the next run's start.
            at = F.filter(F.transform(s, lambda x, j: F.when((j == 0) | (F.get(s, j - 1)["v"] != x["v"]), j)), lambda j: j.isNotNull())
            runs = _let(at, lambda r: F.flatten(F.transform(r, lambda a, j: F.sequence(F.lit(0), F.coalesce(F.get(r, j + 1), F.size(s)) - a - 1))))
            return F.zip_with(s, runs, lambda x, c: pack(F.xxhash64(x["v"], c), x["i"]))

        ordered = F.sort_array(F.transform(m, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(m)) == n, plain).otherwise(_let(ordered, occurrences))

    def tuples(p: Column) -> Column:
        """p: packed numbers in order. A position takes those from its share of the hash space on, around the end."""
        share = lambda x: F.shiftright(x, 64 - bits) + slots // 2  # noqa: E731  0 to slots - 1, in the order of p
        place = (1 << _PLACE_BITS) - 1
        n = F.size(p)
        at = F.filter(F.transform(p, lambda x, j: F.when((j == 0) | (share(F.get(p, j - 1)) != share(x)), j)), lambda j: j.isNotNull())

        def digest(a: Column) -> Column:
            taken = F.transform(F.sequence(a, a + F.least(n, F.lit(picked)) - 1), lambda i: F.get(p, F.pmod(i, n)))
            members = F.transform(taken, lambda x: F.struct(x.bitwiseAND(F.lit(place)).alias("i"), F.shiftright(x, _PLACE_BITS).alias("v")))
            code = F.xxhash64(F.transform(F.sort_array(members), lambda x: x["v"]))
            return F.substring(F.hex(code.bitwiseAND(F.lit(0xFFFF)) + 0x10000), 2, 4)

        def laid(r: Column) -> Column:
            # Positions after one start's share, up to the next start's, begin there; those after the last begin at the first.
            upto = lambda a: share(F.get(p, a)).cast("int")
            codes = F.transform(r, lambda a, j: F.repeat(digest(a), upto(a) - F.when(j == 0, F.lit(-1)).otherwise(upto(F.get(r, j - 1)))))
            return F.concat(F.array_join(codes, ""), F.repeat(digest(F.lit(0)), slots - 1 - share(F.get(p, n - 1)).cast("int")))

        return F.when(n == 0, F.lit("-" * (4 * slots))).otherwise(_let(at, laid))

    return _let(hashes, lambda h: _let(with_words(h), lambda m: _let(F.sort_array(number(m)), tuples)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: the only member of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def likeness(a: Column, b: Column, slots: int = 64) -> Column:
    """Share of positions with equal tuples; two empty fingerprints are alike (1), an empty and another one are not, null gives 0."""
    cut = lambda x: F.regexp_extract_all(x, F.lit("(.{4})"), 1)
    pairs = F.filter(F.arrays_zip(cut(a).alias("a"), cut(b).alias("b")), lambda x: (x["a"] != "----") | (x["b"] != "----"))
    same = _let(pairs, lambda p: F.when(F.size(p) == 0, F.lit(1.0)).otherwise(F.size(F.filter(p, lambda x: x["a"] == x["b"])) / F.size(p)))
    return F.coalesce(F.when(a == b, F.lit(1.0)).otherwise(same), F.lit(0.0))


def fingerprint(docs: DataFrame, k: int = 3, picked: int = 2, slots: int = 64) -> DataFrame:
    """``docs`` with a column ``fingerprint`` of the whole text (in place of one of that name)."""
    return docs.withColumn("fingerprint", order_min_hash(F.col("text"), k, picked, slots))


def id_bounds(docs: DataFrame, rows_each: int = 500, most: int = 1 << 18) -> list[int | None]:
    """First ids of blocks that part the rows, ascending: of about ``rows_each`` rows, of more where ``most`` blocks would not do.

    The first block begins with null if any id is null. Every block has rows. Only bounds go to the driver, 8 bytes for each
    block. A larger block is no more than a longer window: it is sorted with spill.
    """
    n, nulls, least = docs.agg(F.count(F.lit(1)), F.count_if(F.col("doc_id").isNull()), F.min("doc_id")).first()
    blocks = max(1, min(most, n // rows_each))
    cuts = [i / blocks for i in range(1, blocks)]
    found = docs.select(F.percentile_approx("doc_id", cuts, 10 * blocks)).first()[0] if cuts else []
    first = None if nulls else least
    return [first, *sorted(b for b in set(found or []) if first is None or b > first)]


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def block_of(value: Column, bounds: list[int], fan: int = 64) -> Column:
    """How many of the ascending ``bounds`` are no more than ``value``, found in steps of ``fan`` bounds at a time; null is below all."""
    if not bounds:
        return F.lit(0)
    levels = [bounds]
    while len(levels[-1]) > fan:
        levels.append(levels[-1][fan - 1 :: fan])  # the last of each full step
    found = F.lit(0)
    for level in reversed(levels):
        here = F.slice(_longs(level), found * fan + 1, F.lit(fan))
        found = found * fan + F.size(F.filter(here, lambda b: b <= value))
    return F.when(value.isNull(), 0).otherwise(found)


def edited_fingerprints(docs: DataFrame, k: int = 3, picked: int = 2, slots: int = 64) -> DataFrame:
    """Fingerprints of each text and of the text edited with its successor's start, and their likeness.

    Edited: the last floor(n / 2) code points are replaced by the first as many (or all) of the next document by ascending
    doc_id (an integer); after the last comes the first. Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next). Null text is empty. Null ids come first, repeated ids in the order of their texts.
    One row follows itself. Very long texts are read whole, to the last word. An empty table gives an empty table.

    Ids are parted into blocks; each block's first row is sent to the block before it as well, so that successors are
    found in windows over blocks, never over the whole table. Rows of one id stay in one block.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    heads = id_bounds(rows.select("doc_id"))
    marked = rows.withColumn("_b", block_of(F.col("doc_id").cast("bigint"), heads[1:]))
    # Of the rows with a block's first id only one is its first; the window's order picks it. The first block comes after the last.
    head = F.when(F.col("_b") == 0, F.lit(heads[0]).cast("bigint"))
    head = head.otherwise(F.get(_longs(heads[1:]), F.col("_b") - 1)) if heads[1:] else head
    here = F.struct(F.col("_b").alias("b"), F.lit(0).alias("late"))
    ahead = F.struct(F.pmod(F.col("_b") - 1, F.lit(len(heads))).alias("b"), F.lit(1).alias("late"))
    marked = marked.withColumn("_copies", F.when(F.col("doc_id").eqNullSafe(head), F.array(here, ahead)).otherwise(F.array(here)))
    spread = fingerprint(marked, k, picked, slots).select("doc_id", "text", "fingerprint", F.inline("_copies"))
    line = Window.partitionBy("b").orderBy("late", F.col("doc_id").asc_nulls_first(), "text")
    met = spread.withColumns({"_next": F.lead("text").over(line), "_next_print": F.lead("fingerprint").over(line)}).where(F.col("late") == 0)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    done = met.withColumn("_edited", edited).withColumn("edited_fingerprint", order_min_hash(F.col("_edited"), k, picked, slots))
    return done.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), slots).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next_print"), slots).alias("near_next"),
    )
