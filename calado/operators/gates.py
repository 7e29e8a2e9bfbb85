"""Predicates and gates: contracts, signatures, labels, admission of rows. Missing is never zero; gates fail closed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from calado.functions import printed
from calado.functions.geometry import segment_distance
from calado.functions.text import NUMBER, fold
from calado.operators.storage import checkpointed

# First bytes, in hex, of known formats.
SIGNATURES = {"xls": "D0CF11E0A1B11AE1", "avro": "4F626A01", "pdf": "255044462D", "zip": "504B0304", "gzip": "1F8B"}


def signature(content: Column) -> Column:
    """Name of the format by its first bytes; html for text that starts like a page; else null."""
    head = F.hex(F.substring(content, 1, 8))
    found = F.lit(None).cast("string")
    for name, mark in SIGNATURES.items():
        found = F.when(head.startswith(mark), name).otherwise(found)
    text = F.lower(F.ltrim(F.decode(F.substring(content, 1, 256), "ISO-8859-1")))
    return F.coalesce(found, F.when(text.startswith("<!doctype html") | text.startswith("<html"), "html"))


def verify_assets(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Per source whether all expected assets are there with their size and SHA-256; (source, assets, verified, all_ok)."""
    have = files.select("name", F.sha2("content", 256).alias("_h"), F.octet_length("content").alias("_b"))
    met = expected.join(have, "name", "left")
    ok = F.coalesce((F.col("_h") == F.col("sha256")) & (F.col("_b") == F.col("bytes")), F.lit(False))
    return met.groupBy("source").agg(F.count(F.lit(1)).alias("assets"), F.count_if(ok).alias("verified"), F.bool_and(ok).alias("all_ok"))


def require(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``df`` if every aggregate condition over it holds; otherwise the query fails and names the conditions."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), n) for n, c in checks.items()]))
    guard = df.agg(failed.alias("_f")).select(F.assert_true(F.size("_f") == 0, F.concat(F.lit("contract failed: "), F.array_join("_f", ", "))).alias("_ok"))
    return df.join(F.broadcast(guard)).where(F.col("_ok").isNull()).drop("_ok")


def resolve_label(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(wanted, code, status): a unique exact match of folded labels, else a unique match within a label, else none.

    Labels meet the wanted ones by runs of three characters (of fewer for shorter ones): an equi-join on the first such run of the
    wanted label, then the whole of it is looked for. An empty one is within every label. Members of one folded label are
    counted before they meet, and a wanted label that repeats is looked for once, so neither makes a key hot.
    """
    m = members.select("code", fold(F.col("label")).alias("_l")).groupBy("_l").agg(F.count(F.lit(1)).alias("_n"), F.min("code").alias("_c"))
    w = wanted.select("wanted", fold(F.col("wanted")).alias("_w"))
    sought = w.distinct()
    exact = sought.join(m, F.col("_w") == F.col("_l")).select("wanted", F.col("_n").alias("_ne"), F.col("_c").alias("_ce"))
    starts = F.sequence(F.lit(1), F.char_length("_l"))
    run_of = lambda n: F.transform(starts, lambda i: F.substring("_l", i, F.lit(n)))
    runs = F.concat(F.array(F.lit("")), run_of(1), run_of(2), run_of(3))
    runs = F.when(F.col("_l") == "", F.array(F.lit(""))).otherwise(F.array_distinct(runs))
    at_run = sought.withColumn("_run", F.substring("_w", F.lit(1), F.lit(3))).join(m.withColumn("_run", F.explode(runs)), "_run")
    part = at_run.where(F.col("_l").contains(F.col("_w"))).groupBy("wanted").agg(F.sum("_n").alias("_np"), F.min("_c").alias("_cp"))
    met = w.join(exact, "wanted", "left").join(part, "wanted", "left")
    code = F.when(F.col("_ne") == 1, F.col("_ce")).when(F.col("_ne").isNull() & (F.col("_np") == 1), F.col("_cp"))
    status = F.when(F.col("_ne") == 1, "exact").when(F.col("_ne") > 1, "ambiguous").when(F.col("_np") == 1, "within").when(F.col("_np") > 1, "ambiguous").otherwise("absent")
    return met.select("wanted", code.alias("code"), status.alias("status"))


def select_members(members: DataFrame, year: str | None = None, contains: str | None = None, codes: list[str] | None = None, level: str | None = None) -> DataFrame:
    """Members by year in code or label, by part of the label, by codes, and by level; all given conditions hold. A code that no member has is an
    error."""
    out = members
    if codes is not None:
        known = F.collect_set(F.when(F.col("code").isin(codes), F.col("code")))
        unknown = F.array_except(F.array(*[F.lit(c) for c in codes]).cast("array<string>"), known.cast("array<string>"))
        guard = members.agg(F.assert_true(F.size(unknown) == 0, F.concat(F.lit("unknown codes: "), F.array_join(unknown, ","))).alias("_ok"))
        out = out.join(F.broadcast(guard)).where(F.col("_ok").isNull()).drop("_ok")
    if year:
        out = out.where(F.col("code").contains(year) | F.col("label").contains(year))
    if contains:
        out = out.where(fold(F.col("label")).contains(contains.lower()))
    if codes is not None:
        out = out.where(F.col("code").isin(codes))
    if level:
        out = out.where(F.col("level") == level)
    return out


def _any_of(folded: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(folded, F.lit(w)) for w in words])


def tags_of(folded: Column, vocabulary: dict[str, list[str]]) -> Column:
    """Names of keyword families that occur in a folded text, in order."""
    return F.array_compact(F.array(*[F.when(_any_of(folded, words), name) for name, words in sorted(vocabulary.items())]))


def header_context(rows: DataFrame, table: list[str], order: str, text: str, headers: int = 2) -> DataFrame:
    """The rows of each table below its first ``headers`` ones, whose texts they get as ``context``, joined by a bar."""
    w = Window.partitionBy(*table).orderBy(order)
    numbered = rows.withColumn("_i", F.row_number().over(w))
    top = numbered.where(F.col("_i") <= headers).groupBy(*table).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", F.col(text).alias("t")))), lambda x: x["t"]), " | ").alias("context"))
    return numbered.where(F.col("_i") > headers).drop("_i").join(top, table)


def admit_rows(rows: DataFrame, text: str, vocabulary: dict[str, list[str]], context: str | None = None) -> DataFrame:
    """Add ``tags`` and ``status``: admitted with a number and a tag, candidate with either, else rejected. Tags are of the text and, if given, of
    the column ``context`` too; a number must be in the text."""
    number, tagged = F.col(text).rlike(NUMBER), F.size("_tags") > 0
    status = F.when(number & tagged, "admitted").when(number | tagged, "candidate").otherwise("rejected")
    whole = F.concat_ws(" ", context, text) if context else F.col(text)
    marked = rows.withColumn("_folded", fold(whole)).withColumn("_tags", tags_of(F.col("_folded"), vocabulary))
    return marked.withColumns({"tags": F.array_join("_tags", "|"), "status": status}).drop("_tags", "_folded")


def table_candidate_pages(lines: DataFrame, page: list[str], text: str = "text") -> DataFrame:
    """Pages with 4 or more lines of 2 or more numbers, or a heading of a table or figure."""
    numbers = F.regexp_count(text, F.lit(r"\d+(?:[.,]\d+)*"))
    heading = F.col(text).rlike(r"(?i)^\s*(tab(le|ela|la)|fig(ure|ura)?)\b")
    out = lines.groupBy(*page).agg(F.count_if(numbers >= 2).alias("number_lines"), F.count_if(heading).alias("headings"))
    return out.where((F.col("number_lines") >= 4) | (F.col("headings") > 0))


def _printed_cells(text: str) -> Column:
    """The cells of a printed line, array of structs (start, end, said): what two or more blanks, a tab or a bar part."""
    pieces = F.regexp_extract_all(F.replace(F.col(text), F.lit("\t"), F.lit("    ")), F.lit(r"( {2,}| *\| *|(?:(?! {2}| *\|)[^|])+)"), 1)
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,said:string>>").alias("cells"))
    cell = lambda a, p: F.array(F.struct(a["at"].alias("start"), (a["at"] + F.char_length(F.rtrim(p))).alias("end"), F.trim(p).alias("said")))
    step = lambda a, p: F.struct((a["at"] + F.char_length(p)).alias("at"), F.when(F.trim(p).isin("", "|"), a["cells"]).otherwise(F.concat(a["cells"], cell(a, p))).alias("cells"))
    return F.aggregate(pieces, empty, step)["cells"]


def tables_from_lines(
    lines: DataFrame, page: list[str], line: str = "line_no", text: str = "text", least_rows: int = 2, least_columns: int = 2, least_cells: int = 4, spanning: float = 0.25, most_lines: int = 16_384
) -> DataFrame:
    """(page, table_no, row_no, column_no, text): all cells, empty ones too, of the tables that a page's lines lay out.

    A cell ends at two or more blanks, a tab or a bar. Lines with two cells or more that follow each other without another line
    between are a table's rows. Its columns are where more than ``spanning`` of its rows have text, character by character, so the gaps they
    share part columns and a heading across several does not join them; a cell goes to the first column that it is not right of, and cells of
    a row that meet in one are joined by a blank. Tables below ``least_rows``, ``least_columns`` or ``least_cells`` filled cells are none. Rows,
    columns and tables count from 0. A page's lines are shuffled once and its tables found in arrays; pages of over ``most_lines`` lines take windows, of which a page is one key.
    """
    limits = (page, line, text, least_rows, least_columns, least_cells, spanning)
    of_page = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in page])
    many = lines.groupBy(*page).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most_lines).select(*[F.col(c).alias(f"_p_{c}") for c in page])
    many = checkpointed(many)
    if many.isEmpty():
        return _tables_in_arrays(lines, *limits)
    # A struct of its columns names a page, so that one without a name meets itself in joins.
    long = lines.join(many, of_page, "left_semi").select(F.struct(*page).alias("_page"), line, text)
    by_windows = _tables_by_windows(long, ["_page"], *limits[1:]).select("_page.*", "table_no", "row_no", "column_no", "text")
    return by_windows.unionByName(_tables_in_arrays(lines.join(many, of_page, "left_anti"), *limits))


def _tables_in_arrays(lines: DataFrame, page: list[str], line: str, text: str, *limits: float) -> DataFrame:
    """``tables_from_lines`` of pages whose lines come in order, some thousand lines at once; a page's last lines wait for the rest of it."""
    rows = lines.where(F.col(text).isNotNull()).select(*page, F.col(line).alias("_line"), F.col(text).alias("_text")).repartition(*page).sortWithinPartitions(*page, "_line")
    counts = [StructField(c, IntegerType()) for c in ("table_no", "row_no", "column_no")]
    kind = StructType([*[rows.schema[c] for c in page], *counts, StructField("text", StringType())])

    def first_lines(part: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(len(part), bool)
        new[:1] = True
        for c in page:
            a, b = part[c][1:], part[c][:-1]
            differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(a.is_null(), b.is_null()))
            new[1:] |= differ.to_numpy(zero_copy_only=False)
        return new

    def found(part: pa.RecordBatch, new: np.ndarray) -> pa.RecordBatch:
        at, *numbers, said = printed.tables(new, part["_line"].to_numpy(zero_copy_only=False), part["_text"], *limits)
        keys = part.select(page).take(pa.array(at))
        return pa.RecordBatch.from_arrays([*keys.columns, *[pa.array(n, pa.int32()) for n in numbers], said], names=kind.names)

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            if not len(batch):
                continue
            part = batch if waiting is None else pa.concat_batches([waiting, batch])
            new = first_lines(part)
            whole = int(np.flatnonzero(new)[-1])
            waiting = part.slice(whole)
            if whole:
                yield found(part.slice(0, whole), new[:whole])
        if waiting is not None:
            yield found(waiting, first_lines(waiting))

    return rows.mapInArrow(laid_out, kind)


def _tables_by_windows(lines: DataFrame, page: list[str], line: str, text: str, least_rows: int, least_columns: int, least_cells: int, spanning: float) -> DataFrame:
    """``tables_from_lines`` by windows, for pages of any length."""
    key = [*page, "_island"]
    rows = lines.select(*page, F.col(line).alias("_line"), _printed_cells(text).alias("_cells")).where(F.size("_cells") > 1)
    rows = rows.withColumn("_island", F.col("_line") - F.row_number().over(Window.partitionBy(*page).orderBy("_line")))

    ends = F.explode(F.flatten(F.transform("_cells", lambda c: F.array(F.struct(c["start"].alias("at"), F.lit(1).alias("d")), F.struct(c["end"].alias("at"), F.lit(-1).alias("d"))))))
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= least_rows)
    steps = rows.select(*key, ends.alias("_e")).groupBy(*key, F.col("_e.at").alias("_at")).agg(F.sum("_e.d").alias("_d")).join(counted, key)
    order = Window.partitionBy(*key).orderBy("_at")
    covered = steps.withColumn("_in", F.sum("_d").over(order) > spanning * F.col("_rows"))
    closing = covered.withColumn("_closes", ~F.col("_in") & F.coalesce(F.lag("_in").over(order), F.lit(False)))
    columns = closing.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(F.col("_closes"), F.col("_at")))).alias("_ends")).where(F.size("_ends") >= least_columns)

    placed = lambda c: F.least(F.size(F.filter("_ends", lambda e: e <= c["start"])), F.size("_ends") - 1)
    met = rows.join(columns, key).withColumn("_cells", F.transform("_cells", lambda c: F.struct(placed(c).alias("column"), c["said"].alias("said"))))
    said = lambda n: F.array_join(F.transform(F.filter("_cells", lambda c: c["column"] == n), lambda c: c["said"]), " ")
    met = met.withColumn("_row", F.transform(F.sequence(F.lit(0), F.size("_ends") - 1), said))
    table = Window.partitionBy(*key)
    met = met.withColumns({"_filled": F.sum(F.size(F.filter("_row", lambda t: t != ""))).over(table), "row_no": F.row_number().over(table.orderBy("_line")) - 1})
    met = met.where(F.col("_filled") >= least_cells).withColumn("table_no", F.dense_rank().over(Window.partitionBy(*page).orderBy("_island")) - 1)
    return met.select(*page, "table_no", "row_no", F.posexplode("_row").alias("column_no", "text"))


def scope_rows(lines: DataFrame, text: str, terms: list[str], places: list[str] | None = None) -> DataFrame:
    """Lines with a number, one of ``terms`` and, if given, one of ``places``."""
    t = fold(F.col(text))
    ok = F.col(text).rlike(NUMBER) & _any_of(t, terms)
    return lines.where(ok & _any_of(t, places) if places else ok)


def sentences(texts: DataFrame, text: str) -> DataFrame:
    """One row a sentence, with its place ``sentence_no``, where a source has no lines: a full stop, question or exclamation mark and a blank part
    them."""
    return texts.select("*", F.posexplode(F.split(text, r"(?<=[.!?])[ \t\n\r\f]+", -1)).alias("sentence_no", "_s")).withColumn(text, F.col("_s")).drop("_s")


def scope_by_profile(lines: DataFrame, source: str, text: str, profiles: dict[str, tuple[list[str], list[str] | None]]) -> DataFrame:
    """Lines of the sources with a profile (terms, places or None): those with a number, one of the terms and, where the profile has places, one of
    them. Sources without a profile have no rows."""
    folded = lines.withColumn("_folded", fold(F.col(text)))
    fits = lambda terms, places: _any_of(F.col("_folded"), terms) & (_any_of(F.col("_folded"), places) if places else F.lit(True))
    kept = reduce(lambda a, b: a | b, [(F.col(source) == name) & fits(*p) for name, p in profiles.items()])
    return folded.where(F.col(text).rlike(NUMBER) & kept).drop("_folded")


def classify_first(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The name of the first rule (name, keyword) whose keyword the folded text holds; null if none does."""
    t = fold(text)
    out = None
    for name, word in rules:
        out = F.when(F.contains(t, F.lit(word)), name) if out is None else out.when(F.contains(t, F.lit(word)), name)
    return out


def in_corridor(x: Column, y: Column, ax: Column, ay: Column, bx: Column, by: Column, local: Column, box: float = 6000.0, reach: float = 14000.0) -> Column:
    """P10: within a box around both ends for local links, else at most ``reach`` from the segment."""
    inside = x.between(F.least(ax, bx) - box, F.greatest(ax, bx) + box) & y.between(F.least(ay, by) - box, F.greatest(ay, by) + box)
    return F.when(local, inside).otherwise(segment_distance(x, y, ax, ay, bx, by)[0] <= reach)


def valid_travel(value: Column, snap_from: Column, snap_to: Column, limit: float) -> Column:
    """A travel value only when both ends snap within ``limit``; otherwise null, never zero."""
    return F.when((snap_from <= limit) & (snap_to <= limit), value)


def classify(value: Column, breaks: list[tuple[float, str]], last: str) -> Column:
    """The name of the first break that the value does not exceed; null stays null."""
    out = F.when(value.isNull(), None)
    for limit, name in breaks:
        out = out.when(value <= limit, name)
    return out.otherwise(last)


def coverage_status(status: Column, truncated: Column, features: Column) -> Column:
    """Unavailable, truncated, unknown, no_feature or hit are told apart; no hit never means clear."""
    return F.when(status.isNull() | (status >= 400), "unavailable").when(truncated, "truncated").when(features.isNull(), "unknown").when(features == 0, "no_feature").otherwise("hit")


def clean_count(value: Column) -> Column:
    """A count, or null where it is negative, not finite or missing."""
    return F.when((value >= 0) & ~F.isnan(value) & (value < float("inf")), value)


def interest_cells(local_m: Column, motorway_m: Column, ring_km: Column) -> Column:
    """Local road within 1200 m, motorway within 4000 m, ring of 2 to 12 km."""
    return (local_m <= 1200) & (motorway_m <= 4000) & ring_km.between(2, 12)


def flatten_metrics(rows: DataFrame, group: list[str], metric: str, value: str, names: list[str]) -> DataFrame:
    """One row for each group with a column of summed ``value`` for each of the metrics ``names``; null where a group has none. Other
    metrics are left out; the names are given, so that no pass over the rows has to find them."""
    return rows.groupBy(*group).pivot(metric, names).agg(F.sum(value))
