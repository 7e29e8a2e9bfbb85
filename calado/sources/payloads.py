"""Landed payloads to long tables: paged JSON, cubes, period maps, dimension members, nested JSON, HTML, XML, catalogues."""

from __future__ import annotations

import ast
import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.functions.text import canon_hash, fold, unescape
from calado.operators.storage import checkpointed


def validate_specs(specs: DataFrame) -> DataFrame:
    """Add ``errors``, codes of the broken rules in order; an empty array is a valid spec."""
    rules = [
        ("id", F.col("source_set_id").rlike(r"^F[0-9]{2,4}$")),
        ("title", F.length(F.trim("title")) > 0),
        ("access", F.col("access") == "public"),
        ("sink", F.col("sink").isin("public_release", "private_release", "receipt_only")),
        ("cadence", F.col("cadence").isin("once", "daily", "weekly", "monthly", "yearly")),
        ("release_reuse", (F.col("sink") != "public_release") | (F.col("reuse") == "verified")),
        ("release_gate", (F.col("sink") != "public_release") | (F.col("gate") == "asset_check_required")),
    ]
    return specs.withColumn("errors", F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), code) for code, ok in rules])))


def compose_record_pages(pages: DataFrame, results_key: str = "results", group: str = "dataset") -> DataFrame:
    """(group, page_offset, pos, record) of the list under ``results_key`` of each JSON page; a page without the list is an error."""
    parsed = pages.withColumn("_list", F.from_json(F.get_json_object("body", f"$.{results_key}"), "array<string>"))
    checked = F.when(F.col("_list").isNull(), F.raise_error(F.concat(F.lit("a page has no list: "), F.col("page_offset").cast("string")))).otherwise(F.col("_list"))
    return parsed.select(group, "page_offset", F.posexplode(checked).alias("pos", "record"))


def compose_feature_pages(pages: DataFrame) -> DataFrame:
    """Features of FeatureCollection pages in page order, geometry and properties as JSON text unchanged."""
    out = compose_record_pages(pages, "features")
    return out.select("dataset", "page_offset", "pos", F.get_json_object("record", "$.geometry").alias("geometry"), F.get_json_object("record", "$.properties").alias("properties"))


def check_pages(pages: DataFrame, size: int, most_pages: int = 10_000) -> DataFrame:
    """Per dataset the gate over (dataset, page_offset, source_url, n, total): counts close, only the last page is short,
    no page address repeats, the total is stable, and pages are at most ``most_pages``."""
    out = pages.groupBy("dataset").agg(
        F.sum("n").alias("observed"), F.max("total").alias("declared"), F.count(F.lit(1)).alias("pages"),
        (F.min("total") == F.max("total")).alias("stable"), (F.count_distinct("source_url") == F.count(F.lit(1))).alias("distinct_urls"),
        F.max_by("n", "page_offset").alias("_last"), F.count_if(F.col("n") < size).alias("_short"),
    )
    full = (F.col("_short") == 0) | ((F.col("_short") == 1) & (F.col("_last") < size))
    ok = (F.col("observed") == F.col("declared")) & F.col("stable") & F.col("distinct_urls") & full & (F.col("pages") <= most_pages)
    return out.withColumns({"full": full, "complete": F.coalesce(ok, F.lit(False))}).drop("_last", "_short")


def jsonstat_to_rows(cubes: DataFrame) -> DataFrame:
    """(cube, linear_index, codes, value, text, status) of cubes with ``id``, ``size``, ``codes`` map, and JSON text ``value`` and ``status``.

    Values and status are each a list of as many entries as the cube has cells, or an object by index; the last dimension runs
    fastest. Absent cells make no row; an explicit null stays null. ``text`` is a value that is no number, as the producer's "..". A list of
    another length, a key that is no index of the cube, other JSON and a dimension with another number of codes than its size are errors; a
    null or empty status says nothing.
    """
    total = F.aggregate("size", F.lit(1).cast("long"), lambda a, s: a * s)
    codes_fit = F.forall(F.arrays_zip(F.col("id").alias("d"), F.col("size").alias("n")), lambda x: F.coalesce(F.size(F.try_element_at("codes", x["d"])) == x["n"], F.lit(False)))
    right = lambda ok, why: F.when(~F.coalesce(ok, F.lit(False)), F.raise_error(F.concat(F.lit(f"{why}: cube "), F.col("cube").cast("string"))))

    def cells(column: str, empty: bool) -> Column:
        """Entries (i, v) of a list or an object, by index."""
        whole, items, keyed = F.col(column), F.from_json(column, "array<string>"), F.map_entries(F.from_json(column, "map<string,string>"))
        dense = F.transform(items, lambda v, i: F.struct(i.cast("long").alias("i"), v.alias("v")))
        sparse = F.array_sort(F.transform(keyed, lambda e: F.struct(e["key"].try_cast("long").alias("i"), e["value"].alias("v"))))
        nothing = F.slice(sparse, 1, 0)
        said = F.trim(whole)
        length = right((F.size(items) == total) | (F.lit(empty) & (F.size(items) == 0)), "a list is as long as the cube")
        inside = right(F.forall(sparse, lambda e: e["i"].isNotNull() & (e["i"] >= 0) & (e["i"] < F.col("_n"))), "an index is beyond the cube")
        other = right(F.lit(False), "a list or an object is asked for")
        none = F.coalesce(said, F.lit("null")).isin("null", "") if empty else F.lit(False)
        checked = lambda wrong, entries: F.when(wrong.isNull(), entries)
        return F.when(none, F.coalesce(nothing, F.array().cast("array<struct<i:bigint,v:string>>"))).when(said.startswith("["), checked(length, dense)).when(said.startswith("{"), checked(inside, sparse)).otherwise(checked(other, nothing))

    # A status by position: an object's entries, in order, with nulls between them, so that each cell looks up one place.
    full = lambda e: F.concat(F.flatten(F.transform(e, lambda x, k: F.concat(F.array_repeat(F.lit(None).cast("string"), (x["i"] - F.coalesce(F.get(e, k - 1)["i"] + 1, F.lit(0))).cast("int")), F.array(x["v"])))))
    # The only member of an array is worked out once: status texts are parsed once a cube, not once a cell.
    marked = lambda s: F.transform(cells("value", False), lambda c: F.struct(c["i"].alias("linear_index"), c["v"].alias("v"), F.get(s, c["i"].cast("int")).alias("status")))
    both = F.get(F.transform(F.array(F.get(F.transform(F.array(cells("status", True)), full), F.lit(0))), marked), F.lit(0))
    sound = cubes.withColumn("_n", F.when(right(codes_fit, "a dimension has another number of codes").isNull(), total))
    rows = sound.select("cube", "id", "size", "codes", "_n", F.inline(both))
    stride = lambda k: F.aggregate(F.slice("size", k + 2, F.size("size")), F.lit(1).cast("long"), lambda a, s: a * s)
    code = F.transform("id", lambda d, k: F.element_at(F.element_at("codes", d), (F.floor(F.col("linear_index") / stride(k)) % F.get("size", k) + 1).cast("int")))
    number = F.when(F.col("v").rlike(r"^-?[0-9]"), F.col("v").try_cast("double"))
    return rows.where("_n IS NOT NULL").select("cube", "linear_index", F.array_join(code, "|").alias("codes"), number.alias("value"), F.when(number.isNull(), F.col("v")).alias("text"), "status")


def flatten_period_map(responses: DataFrame) -> DataFrame:
    """(response, outcome, period, geocod, valor, sinal_conv): one row for each observation of {period: [rows]}.

    ``outcome``: ok, row_limit (code 7, or 3 with a word on the limit) or failed; only ok responses have observations. A row
    without value and sign is left out and counted by the gate of the caller.
    """
    code, message = F.get_json_object("body", "$.Sucesso.Falso[0].Cod"), F.get_json_object("body", "$.Sucesso.Falso[0].Msg")
    good = F.get_json_object("body", "$.Dados").isNotNull() & code.isNull()
    outcome = F.when(good, "ok").when((code == "7") | ((code == "3") & fold(message).contains("buffer")), "row_limit").otherwise("failed")
    periods = F.from_json(F.get_json_object("body", "$.Dados"), "map<string,array<map<string,string>>>")
    rows = responses.select("response", outcome.alias("outcome"), F.explode_outer(F.when(good, periods)).alias("period", "_rows"))
    obs = rows.select("response", "outcome", "period", F.explode_outer("_rows").alias("_o"))
    pick = lambda *keys: F.coalesce(*[F.try_element_at("_o", F.lit(k)) for k in keys])
    out = obs.select("response", "outcome", "period", pick("geocod", "GeoCod").alias("geocod"), pick("valor", "Valor").alias("valor"), pick("sinal_conv", "Sinal_Conv").alias("sinal_conv"))
    return out.where((F.col("outcome") != "ok") | F.col("valor").isNotNull() | F.col("sinal_conv").isNotNull())


#: The keys that may hold a member's label, the first filled one counts.
LABEL_KEYS = ["categ_dsg", "Designacao", "Descricao", "label", "dsg"]


def _members(groups: DataFrame) -> DataFrame:
    """(indicator, dim, code, label) of both shapes of metadata."""
    labels = ",".join(f"{k}:string" for k in LABEL_KEYS)
    shape = f"array<struct<dim_num:int,cat_id:string,categ_cod:string,Dim:int,Membros:array<struct<cod:string,{labels}>>,{labels}>>"
    label = lambda at: F.coalesce(*[F.nullif(F.col(f"{at}.{k}"), F.lit("")) for k in LABEL_KEYS])
    rows = groups.select("indicator", F.explode(F.from_json("meta", shape)).alias("g"))
    flat = rows.where("g.Membros IS NULL").select("indicator", F.col("g.dim_num").alias("dim"), F.coalesce("g.cat_id", "g.categ_cod").alias("code"), label("g").alias("label"))
    nested = rows.where("g.Membros IS NOT NULL").select("indicator", F.col("g.Dim").alias("dim"), F.explode("g.Membros").alias("m"))
    return flat.unionByName(nested.select("indicator", "dim", F.col("m.cod").alias("code"), label("m").alias("label")))


def dimension_members(groups: DataFrame) -> DataFrame:
    """(indicator, dim, code, label) from a JSON list of groups in either shape, dimensions 1 to 9.

    Dimension 1 must be there. Dimensions 2 to 4 may be missing; from 5 on the first one missing ends the list.
    """
    both = _members(groups)
    first = both.groupBy(F.col("indicator").alias("_i")).agg(F.collect_set(F.when(F.col("dim").between(1, 9), F.col("dim"))).alias("_dims"))
    before = F.size(F.filter("_dims", lambda d: (d >= 5) & (d < F.col("dim"))))
    met = both.join(first, F.col("indicator") == F.col("_i")).where(F.col("dim").between(1, 9) & ((F.col("dim") <= 5) | (before == F.col("dim") - 5)) | ~F.array_contains("_dims", 1))
    return met.where(F.when(F.array_contains("_dims", 1), F.lit(True)).otherwise(F.raise_error(F.lit("an indicator has no dimension 1")))).select("indicator", "dim", "code", "label")


def period_labels(groups: DataFrame) -> DataFrame:
    """(indicator, code, label) of the periods, dimension 1; a period without any label makes no row."""
    return _members(groups).where("dim = 1 AND label IS NOT NULL").select("indicator", "code", "label")


def zip_variables(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows as maps of ``variables`` to values, and a QA table; rows of another length are only counted, never padded."""
    fits = F.size("row") == F.size("variables")
    unique = F.size(F.array_distinct("variables")) == F.size("variables")
    rows = table.where(fits & unique).select("table_id", "row_no", F.map_from_arrays("variables", "row").alias("fields"))
    marks = F.size(F.filter("row", lambda v: v.isin("*", "..", "-")))
    qa = table.groupBy("table_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~fits).alias("bad_length"), F.sum(marks).cast("long").alias("markers"), F.bool_and(unique).alias("unique_names"),
    )
    return rows, qa


def walk_rows(docs: DataFrame, keys: tuple[str, ...] = ("value", "valor")) -> DataFrame:
    """Objects of nested JSON that hold one of ``keys``, with their pointer; equal (pointer, content) once.

    A list or object under ``Data``, ``data`` or ``DATA``, or else the list ``records`` beside ``metadata``, is the content:
    what lies beside it makes no rows. Each level is one step over keys of objects and places of lists, until a level is empty.
    """
    whole = docs.select("doc", F.parse_json("body").alias("node"))
    at = lambda k: F.try_variant_get("node", f"$.{k}", "variant")
    holds = lambda k: F.coalesce(F.schema_of_variant(at(k)).rlike("^(OBJECT|ARRAY)"), F.lit(False))
    top = F.lit(None).cast("string")
    for k in ("DATA", "data", "Data"):
        top = F.when(holds(k), k).otherwise(top)
    top = F.coalesce(top, F.when(at("metadata").isNotNull() & F.coalesce(F.schema_of_variant(at("records")).startswith("ARRAY"), F.lit(False)), "records"))
    node = F.col("node")
    for k in ("records", "DATA", "data", "Data"):
        node = F.when(top == k, at(k)).otherwise(node)
    here = checkpointed(whole.select("doc", F.coalesce(F.concat(F.lit("/"), top), F.lit("")).alias("pointer"), node.alias("node")))
    found = [here]
    while True:
        here = checkpointed(_children(here))
        found.append(here)
        if not here.limit(1).count():
            break
    rows = reduce(lambda a, b: a.unionByName(b), found)
    is_row = F.schema_of_variant("node").startswith("OBJECT") & reduce(lambda a, b: a | b, [F.try_variant_get("node", f"$.{k}", "string").isNotNull() for k in keys])
    return rows.where(is_row).select("doc", "pointer", F.to_json("node").alias("row")).distinct()


def _children(level: DataFrame) -> DataFrame:
    """The members of each object and list one level down."""
    return level.sparkSession.sql(
        """SELECT doc, concat(pointer, '/', coalesce(replace(replace(m.key, '~', '~0'), '/', '~1'), CAST(m.pos AS STRING))) AS pointer, m.value AS node
        FROM {level}, LATERAL variant_explode(node) AS m""",
        level=level,
    )


def json_path(df: DataFrame, body: str, path: str, min_records: int, top: str | None = None) -> DataFrame:
    """Add ``records`` at a dotted path (list length; 1 for an object; null if absent) and ``enough``. With ``top`` (array or object) a body of
    another kind, or no JSON, is an error."""
    if top:
        kind = F.regexp_extract(F.regexp_extract(F.schema_of_variant(F.try_parse_json(body)), "^[A-Z]+", 0), "ARRAY|OBJECT", 0)
        wrong = F.raise_error(F.concat(F.lit(f"a body is no {top}: "), F.coalesce(F.substring(body, 1, 40), F.lit("null"))))
        df = df.withColumn(body, F.when(F.lower(kind) == top, F.col(body)).otherwise(wrong))
    at = F.get_json_object(body, "$." + path)
    n = F.when(at.startswith("["), F.json_array_length(at)).when(at.startswith("{"), 1)
    return df.withColumns({"records": n, "enough": F.coalesce(n >= min_records, F.lit(False))})


def _no_scripts(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")


def _cell_text(cell: Column) -> Column:
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(cell, r"""(?s)<[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>|<[^>]*>""", " ")), r"[\s\u00a0]+", " "))


def _holds(word: str):
    return lambda c: F.contains(c, F.lit(word))


def html_tables(pages: DataFrame, key: str = "page_id", headers: list[str] | None = None, min_rows: int = 1, index: int | None = None) -> DataFrame:
    """(key, table_no, row_no, cells) of page tables: the rows below the header of tables with at least ``min_rows`` of them.

    Rows without any text are dropped, and tables without any row are not counted. The first row left is the header, 0, whatever its elements;
    ``headers`` (folded) asks for tables whose header has them all, ``index`` for the page's table of that number. Character references
    are decoded. Nested tables are out of scope.
    """
    tables = pages.select(key, F.posexplode(F.regexp_extract_all(_no_scripts(F.col("html")), F.lit(r"(?is)<table\b[^>]*>(.*?)</table\s*>"), 1)).alias("_at", "_t"))
    rows = F.regexp_extract_all("_t", F.lit(r"(?is)<tr\b[^>]*>(.*?)(?:</tr\s*>|(?=<tr\b)|$)"), 1)
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)(?:</t[hd]\s*>|(?=<t[hd]\b)|$)"), 1), _cell_text)
    filled = tables.withColumn("_rows", F.filter(F.transform(rows, cells), lambda r: F.exists(r, lambda c: c != ""))).where(F.size("_rows") > 0).drop("_t")
    numbered = filled.withColumn("table_no", F.row_number().over(Window.partitionBy(key).orderBy("_at")) - 1)
    if index is not None:
        numbered = numbered.where(F.col("table_no") == index)
    if headers:
        head = F.transform(F.get("_rows", F.lit(0)), lambda c: fold(c))
        numbered = numbered.where(reduce(lambda a, b: a & b, [F.exists(head, _holds(h.lower())) for h in headers]))
    body = numbered.where(F.size("_rows") > min_rows).select(key, "table_no", F.posexplode("_rows").alias("row_no", "cells"))
    return body.where("row_no > 0")


def _absolute(href: Column, base: Column) -> Column:
    """An address resolved against its page's, as by RFC 3986; null for schemes other than http and https."""
    root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    scheme = F.coalesce(F.nullif(F.regexp_extract(base, r"^(https?:)//", 1), F.lit("")), F.lit("https:"))
    page = F.regexp_extract(base, r"^(https?://[^?#]+)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(page, r"^(https?://[^/]+/(?:.*/)?)", 1), F.lit("")), F.concat(root, F.lit("/")))
    joined = F.when(href.startswith("/"), F.concat(root, href)).when(href.startswith("?"), F.concat(page, href)).when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href)).otherwise(F.concat(folder, href))
    path = F.regexp_extract(joined, r"^https?://[^/?#]+/([^?#]*)", 1)
    parts = F.split(F.regexp_replace(path, r"(^|/)(\.\.?)$", "$1$2/"), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, c: F.when(c == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(c == ".", done).otherwise(F.concat(done, F.array(c))))
    plain = F.concat(root, F.lit("/"), F.array_join(kept, "/"), F.regexp_extract(joined, r"^[^?#]*(.*)$", 1))
    local = F.when(root != "", F.when(path.rlike(r"(^|/)\.\.?(/|$)"), plain).otherwise(joined)).when((root == "") & href.startswith("/"), href)
    return F.when(href.rlike(r"(?i)^https?://"), href).when(href.startswith("//"), F.concat(scheme, href)).when((href != "") & ~href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), local)


def links(
    pages: DataFrame, key: str = "page_id", base: str = "url", pattern: str | None = None, most: int | None = None,
    label: str | None = None, hosts: list[str] | None = None, extensions: list[str] | None = None,
) -> DataFrame:
    """(key, href, label, position): absolute links, the first of each address, those that match, at most ``most`` a page.

    A page is read as HTML, by its ``a`` elements, or, where its root is ``feed``, as Atom, by its ``link`` elements, whose label is
    their title. Character references are decoded; an address in quotes is read to its closing one. Rules: ``pattern`` of the address, ``label`` of the label, ends of the host's name, extensions of the path.
    """
    html, start = _no_scripts(F.col("html")), r"(?is)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*)*<(?:\w+:)?feed\b"
    atom = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:\w+:)?link\b[^>]*>)"), 1)
    found = pages.select(key, base, F.posexplode(F.when(F.col("html").rlike(start), atom).otherwise(F.regexp_extract_all(html, F.lit(r"(?is)(<a\b[^>]*>.*?</a\s*>)"), 1))).alias("position", "_a"))
    value = r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
    attribute = lambda name: F.btrim(F.regexp_extract("_a", rf"(?is)^<[\w:]+(?:[^>\"'\s]++|\s(?!{name}\s*=)|\"[^\"]*+\"|'[^']*+')*+\s{name}\s*=\s*{value}", 1), F.lit("\"'"))
    is_link = F.col("_a").rlike(r"(?i)^<(\w+:)?link\b")
    # Each step is a column of its own, so that it is worked out once.
    found = found.withColumns({"_h": attribute("href"), "_l": F.when(is_link, attribute("title"))})
    found = found.withColumns({"_h": F.trim(unescape(F.col("_h"))), "_l": F.when(F.col("_l").isNull(), _cell_text(F.col("_a"))).otherwise(F.trim(unescape(F.col("_l"))))})
    rows = found.select(key, _absolute(F.col("_h"), F.col(base)).alias("href"), F.col("_l").alias("label"), "position").where("href IS NOT NULL")
    if pattern:
        rows = rows.where(F.col("href").rlike(pattern))
    if label:
        rows = rows.where(F.col("label").rlike(label))
    if hosts:
        name = F.lower(F.regexp_extract("href", r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:]+)", 1))
        rows = rows.where(reduce(lambda a, b: a | b, [name.endswith(h.lower()) for h in hosts]))
    if extensions:
        rows = rows.where(F.lower(F.regexp_extract("href", r"^https?://[^/?#]+/(?:[^?#]*/)?[^/?#]+\.([^./?#]+)(?:[?#]|$)", 1)).isin([e.lower().lstrip(".") for e in extensions]))
    first = rows.groupBy(key, "href").agg(F.min(F.struct("position", "label")).alias("_m")).select(key, "href", "_m.label", "_m.position")
    if most is None:
        return first
    return first.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy("position"))).where(F.col("_i") <= most).drop("_i")


_TOKEN = re.compile(r"""\"(?:\\.|[^\"\\])*\"|'(?:\\.|[^'\\])*'|[()\[\]{}"']""", re.S)


def _close(script: str, at: int) -> int | None:
    """Where the bracket opened before ``at`` closes; strings are skipped over; None if it or a string stays open."""
    depth = 1
    for m in _TOKEN.finditer(script, at):
        c = m.group()
        if len(c) > 1:
            continue
        if c in "\"'":
            return None
        depth += 1 if c in "([{" else -1
        if not depth:
            return m.start()
    return None


def _balanced(script: str) -> list[str]:
    """Arguments of calls of ``track`` or ``chart``, up to the bracket that closes them."""
    out, at = [], 0
    while m := re.compile(r"(?:track|chart)\(").search(script, at):
        end = _close(script, m.end())
        if end is None:
            break
        out.append(script[m.end() : end])
        at = end + 1
    return out


def embedded_charts(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, script_no, call_no, payload) of chart calls in inline scripts."""
    scripts = pages.select(key, F.posexplode(F.regexp_extract_all("html", F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), 1)).alias("script_no", "_s"))

    @F.pandas_udf("array<string>")
    def calls(s: pd.Series) -> pd.Series:
        return s.map(_balanced)

    return scripts.select(key, "script_no", F.posexplode(calls("_s")).alias("call_no", "payload"))


def _argument(script: str, name: str) -> str | None:
    """The argument of the first call of a function; an open call is an error; a quoted string is unquoted."""
    m = re.search(rf"\b{name}\s*\(", script)
    if m is None:
        return None
    end = _close(script, m.end())
    if end is None:
        raise ValueError(f"a call of {name} does not end")
    text = script[m.end() : end].strip()
    return ast.literal_eval(text) if text[:1] in ("'", '"') else text


#: The container's name in its script, and the calls that carry configuration, rows and the address of rows.
CHART_CONTAINER = r"(?i)getElementById\s*\(\s*['\"](easychart-chart-[^'\"]+)['\"]\s*\)"
CHART_CALLS = {"stringified": "setConfigStringified", "config": "setConfig", "data": "setData", "data_url": "setDataUrl"}


def chart_rows(pages: DataFrame, key: str = "page_id", fewest: int = 0, most: int = 100) -> DataFrame:
    """(key, chart, config, data_url, row_no, cells) of the charts that inline scripts fill, one row for each row of their data.

    ``config`` is JSON text; a chart without data has null ``row_no`` and ``cells``; nested cells are JSON text. Errors: two
    containers in one script, a container filled twice, text that is not JSON, charts of a page beyond ``fewest`` and ``most``.
    """
    scripts = F.regexp_extract_all("html", F.lit(r"(?is)<script\b(?![^>]*\bsrc\s*=)[^>]*>(.*?)</script\s*>"), 1)
    named = F.filter(F.transform(scripts, lambda s: F.struct(F.array_distinct(F.regexp_extract_all(s, F.lit(CHART_CONTAINER), 1)).alias("ids"), s.alias("script"))), lambda e: F.size(e["ids"]) > 0)
    rows = pages.select(key, named.alias("_c"))
    fault = (
        F.when(F.exists("_c", lambda e: F.size(e["ids"]) > 1), "a script names several charts")
        .when(F.size(F.array_distinct(F.transform("_c", lambda e: e["ids"][0]))) < F.size("_c"), "a chart is filled twice")
        .when(~F.size("_c").between(fewest, most), "a page has too few or too many charts")
    )
    rows = rows.select(key, F.explode(F.when(fault.isNotNull(), F.raise_error(F.concat_ws(" ", fault, F.col(key).cast("string")))).otherwise(F.col("_c"))).alias("_e"))

    @F.pandas_udf(", ".join(f"{k} string" for k in CHART_CALLS))
    def calls(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({k: s.map(lambda script, n=name: _argument(script, n)) for k, name in CHART_CALLS.items()}, dtype=object)

    rows = rows.select(key, F.col("_e.ids")[0].alias("chart"), calls("_e.script").alias("_a"))
    config, data = F.coalesce("_a.stringified", "_a.config"), F.from_json("_a.data", "array<array<string>>")
    wrong = (config.isNotNull() & F.try_parse_json(config).isNull()) | (F.col("_a.data").isNotNull() & data.isNull())
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("a payload is not JSON: "), F.col("chart")))).otherwise(data)
    return rows.select(key, "chart", config.alias("config"), "_a.data_url", F.posexplode_outer(checked).alias("row_no", "cells"))


def select_resources(resources: DataFrame, pattern: str, formats: list[str], latest: int | None = None) -> DataFrame:
    """Resources whose name or address matches and whose format is listed, newest first per package, the first ``latest``."""
    rows = resources.where((F.col("name").rlike(pattern) | F.col("url").rlike(pattern)) & F.upper("format").isin(formats))
    w = Window.partitionBy("package").orderBy(F.coalesce("last_modified", "created").desc(), F.col("name").desc(), F.col("url").desc())
    rows = rows.withColumn("rank", F.row_number().over(w))
    return rows if latest is None else rows.where(F.col("rank") <= latest)


def bbox_scan(features: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Features whose envelope meets the box; a filter on four columns, so Parquet can skip row groups."""
    return features.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def raster_cells(cells: DataFrame) -> DataFrame:
    """NaN and the marker -9999 as null; voids are never filled."""
    return cells.withColumn("z", F.when(~F.isnan("z") & (F.col("z") != -9999), F.col("z")))


def profile_payload(lines: DataFrame, key: str, text: str, separator: str = ",") -> DataFrame:
    """Per payload its filled lines, most columns, and whether its first character opens JSON or a tag."""
    first = F.min_by(F.substring(F.ltrim(text), 1, 1), "line_no")
    kind = F.when(first.isin("{", "["), "json").when(first == "<", "markup").otherwise("delimited")
    return lines.where(F.trim(text) != "").groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.max(F.size(F.split(text, separator))).alias("max_columns"), kind.alias("kind"))


def profile_json(files: DataFrame, key: str, body: str) -> DataFrame:
    """Per JSON payload its ``top_keys`` in order, the ``objects`` of a list, how many ``value_slots``, ``status_slots`` and
    ``charts`` it has, and its ``dimension_ids`` and ``dimension_sizes``; what is absent is null; other payloads have null throughout."""
    at = lambda k: F.get_json_object(body, f"$.{k}")
    listed = lambda c: F.when(c.startswith("["), F.json_array_length(c))
    slots = lambda k: F.coalesce(listed(at(k)), F.when(at(k).startswith("{"), F.size(F.json_object_keys(at(k)))))
    return files.select(
        key, F.array_sort(F.json_object_keys(body)).alias("top_keys"), F.json_array_length(body).alias("objects"), slots("value").alias("value_slots"), slots("status").alias("status_slots"),
        F.from_json(at("id"), "array<string>").alias("dimension_ids"), F.from_json(at("size"), "array<int>").alias("dimension_sizes"), listed(at("charts")).alias("charts"),
    )


def _spread(members: DataFrame, profiles: int, pairs: int = 1_000_000) -> DataFrame:
    """Members dealt to as many tasks that each makes some ``pairs`` with profiles: files of few bytes hold many members."""
    tasks = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-members.count() * profiles // pairs))
    return members.repartition(tasks)


def _best_two(scores: DataFrame, *more: Column) -> DataFrame:
    """(profile, _top, _next, ...) of rows (profile, score, _n, _first), one for each score that members of a profile have, how many and the first of
    them: the best member's struct with ``score``, and the second's score, null without one. Scores are few, so no window orders the members."""
    top = F.max_by(F.struct("score", "_n", "_first.*"), "score")
    found = scores.groupBy("profile").agg(top.alias("_top"), F.sort_array(F.collect_list("score"), asc=False).alias("_scores"), *more)
    return found.withColumn("_next", F.when(F.col("_top._n") > 1, F.col("_top.score")).otherwise(F.get("_scores", F.lit(1)))).drop("_scores")


def map_members(members: DataFrame, profiles: DataFrame, margin: int = 2) -> DataFrame:
    """Per profile the member with the most weighted hits if it leads by ``margin``: (profile, path, score, status).

    Profiles are few: (profile, literal, tokens); their literal weighs 5, each token 1. Only pairs with a hit are kept.
    """
    n = profiles.limit(1001).count()
    few = F.broadcast(profiles) if n <= 1000 else profiles
    hits = F.size(F.filter("tokens", lambda t: F.contains(F.col("folded_text"), t)))
    score = F.when(F.contains("folded_text", F.col("literal")), 5).otherwise(0) + hits
    rows = _spread(members, n).join(few, score > 0).select("profile", "path", score.alias("score"))
    best = _best_two(rows.groupBy("profile", "score").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("path")).alias("_first")))
    best = best.select("profile", "_top.path", "_top.score", "_next")
    status = F.when(F.col("score").isNull(), "absent").when(F.col("_next").isNull() | (F.col("score") - F.col("_next") >= margin), "unique").otherwise("ambiguous")
    met = profiles.select("profile").join(best, "profile", "left")
    return met.select("profile", F.when(status == "unique", F.col("path")).alias("path"), "score", status.alias("status"))


#: Weights of a member's evidence, the least total without a literal name, and the leads over the second member.
EVIDENCE = {"stem": 500, "literal": 100, "producers": 20, "products": 10, "places": 5, "extension": 3}
LEAST_TOTAL, LEAD, LITERAL_LEAD = 43, 15, 25


def identify_members(members: DataFrame, profiles: DataFrame, most_profiles: int = 1000) -> DataFrame:
    """(profile, path, score, status, basis): the archive member that a source's profile names.

    Members: (path, folded_text), text without marks and case. Profiles, a declared list of at most ``most_profiles``: (profile,
    producers, products, places, extension) with folded tokens. Evidence: the file's stem or its text is or holds the profile's
    name, tokens in path or text, the extension. One member with the name as stem wins; several are ambiguous; else one whose
    text holds the name; where several do, or none, the best wins if producer and product speak for it and it leads clearly.
    """
    n = profiles.limit(most_profiles + 1).count()
    if n > most_profiles:
        raise ValueError(f"over {most_profiles} profiles")
    name, path, both = F.lower("profile"), fold(F.col("path")), F.concat_ws(" ", fold(F.col("path")), F.col("folded_text"))
    hits = lambda c: F.size(F.array_distinct(F.filter(c, lambda t: (t != "") & F.contains(F.col("_both"), t))))
    rows = _spread(members, n).select("path", "folded_text", path.alias("_path"), both.alias("_both")).join(F.broadcast(profiles))
    stem = F.regexp_extract("_path", r"([^/]*?)(\.[^./]*)?$", 1) == name
    rows = rows.withColumns({
        "stem": stem, "literal": F.coalesce(F.contains("folded_text", name), F.lit(False)),
        **{k: F.coalesce(hits(k), F.lit(0)) for k in ("producers", "products", "places")},
        "extension": F.coalesce((F.col("extension") != "") & F.col("_path").endswith(F.lower("extension")), F.lit(False)),
    })
    score = reduce(lambda a, b: a + b, [F.col(k).cast("int") * v for k, v in EVIDENCE.items()])
    rows = rows.withColumn("score", score).where("score > 0")
    rows = rows.withColumn("named", (F.col("producers") > 0) & (F.col("products") > 0)).select("profile", "path", "score", "stem", "literal", "named")
    scores = rows.groupBy("profile", "score").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("path", "named")).alias("_first"), F.count_if("stem").alias("_s"), F.count_if("literal").alias("_l"),
        F.min(F.when(F.col("stem"), F.struct("path", "score"))).alias("_stem"), F.min(F.when(F.col("literal"), F.struct("path", "score"))).alias("_literal"),
    )
    best = _best_two(scores, F.sum("_s").alias("_stems"), F.sum("_l").alias("_literals"), F.min("_stem").alias("_stem"), F.min("_literal").alias("_literal"))
    best = best.withColumn("_next", F.coalesce("_next", F.lit(-1)))
    lead = F.col("_top.score") - F.col("_next")
    basis = (
        F.when(F.col("_stems") == 1, "stem").when(F.col("_stems") > 1, "several stems").when(F.col("_literals") == 1, "text")
        .when(F.col("_top.named") & (F.col("_literals") > 1) & (lead >= LITERAL_LEAD), "tokens")
        .when(F.col("_top.named") & (F.col("_literals") == 0) & (F.col("_top.score") >= LEAST_TOTAL) & (lead >= LEAD), "tokens")
    )
    met = profiles.select("profile").join(best.withColumn("basis", basis), "profile", "left")
    won = F.when(F.col("basis") == "stem", F.col("_stem")).when(F.col("basis") == "text", F.col("_literal")).when(F.col("basis") == "tokens", F.struct("_top.path", "_top.score"))
    status = F.when(F.col("_top").isNull(), "absent").when(won.isNull(), "ambiguous").otherwise("unique")
    return met.select("profile", won["path"].alias("path"), won["score"].alias("score"), status.alias("status"), "basis")


def resolve_members(names: DataFrame, logical: DataFrame) -> DataFrame:
    """(logical, name, status): the member of that very name, else the only one that ends in it after a slash; otherwise
    ``name`` is null and ``status`` missing or ambiguous. Names go to a join under each of their ends."""
    parts = F.split("name", "/")
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
    by_end = names.select("name").distinct().select("name", F.explode(F.array_distinct(F.concat(F.array("name"), ends))).alias("_end"))
    wanted = logical.select("logical").distinct().withColumn("_end", F.regexp_replace("logical", "^/+", ""))
    wanted = wanted.select("logical", F.explode(F.array_distinct(F.array("logical", "_end"))).alias("_end"))
    met = wanted.join(by_end, "_end", "left").groupBy("logical").agg(F.max(F.when(F.col("name") == F.col("logical"), F.col("name"))).alias("_exact"), F.count_distinct("name").alias("_n"), F.max("name").alias("_any"))
    name = F.coalesce("_exact", F.when(F.col("_n") == 1, F.col("_any")))
    status = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_n") == 1, "suffix").when(F.col("_n") == 0, "missing").otherwise("ambiguous")
    return met.select("logical", name.alias("name"), status.alias("status"))


def _header(cells: DataFrame, tokens: dict[str, int], first_rows: int, filled: float = 0.0) -> DataFrame:
    """(sheet, _head): the row among the first ones that weighs most by tokens, each once a row, and by filled cells, up to ten; ties to the top."""
    text = fold(F.col("value"))
    weight = reduce(lambda a, b: a + b, [F.max(F.when(F.contains(text, F.lit(k)), v).otherwise(0)) for k, v in tokens.items()])
    full = F.least(F.count_if(F.trim("value") != ""), F.lit(10)) * filled
    scored = cells.where(F.col("row") < first_rows).groupBy("sheet", "row").agg((weight + full).alias("_w")).where("_w > 0")
    return scored.groupBy("sheet").agg(F.max_by("row", F.struct("_w", -F.col("row"))).alias("_head"))


def workbook_rows(cells: DataFrame, tokens: dict[str, int], first_rows: int = 80) -> DataFrame:
    """(sheet, row, col, label, value) below the row of the first ``first_rows`` that weighs most by tokens; ties to the top."""
    head = _header(cells, tokens, first_rows)
    labels = cells.join(head, "sheet").where(F.col("row") == F.col("_head")).select("sheet", "col", F.col("value").alias("label"))
    return cells.join(head, "sheet").where(F.col("row") > F.col("_head")).join(labels, ["sheet", "col"], "left").select("sheet", "row", "col", "label", "value")


def workbook_columns(
    cells: DataFrame, tokens: dict[str, int], roles: dict[str, str], months: dict[str, int], first_rows: int = 80, before: int = 2, after: int = 1, filled: float = 0.15,
) -> DataFrame:
    """(sheet, col, label, role, month) of each column: its distinct filled cells from ``before`` rows above the header row
    to ``after`` below, joined by `` | ``, or ``col_NNN`` (from 1) without any. ``role`` is that of the first pattern that the
    folded label meets, for the first such column of a sheet only; ``month`` that of a whole word of the label."""
    met = cells.join(_header(cells, tokens, first_rows, filled), "sheet")
    window = F.when(F.col("row").between(F.col("_head") - before, F.col("_head") + after) & (F.trim("value") != ""), F.struct("row", F.trim("value").alias("v")))
    parts = F.array_distinct(F.transform(F.array_sort(F.collect_list(window)), lambda p: p["v"]))
    rows = met.groupBy("sheet", "col").agg(parts.alias("_p"))
    rows = rows.select("sheet", "col", F.when(F.size("_p") > 0, F.array_join("_p", " | ")).otherwise(F.format_string("col_%03d", F.col("col") + 1)).alias("label"))
    folded = fold(F.col("label"))
    role = F.coalesce(*[F.when(folded.rlike(pattern), name) for name, pattern in roles.items()], F.lit(None).cast("string"))
    month = F.coalesce(*[F.when(folded.rlike(rf"(^|[^a-z]){re.escape(k)}([^a-z]|$)"), v) for k, v in months.items()], F.lit(None).cast("int"))
    rows = rows.withColumns({"_role": role, "month": month})
    first = F.col("col") == F.min("col").over(Window.partitionBy("sheet", "_role"))
    return rows.select("sheet", "col", "label", F.when(first, F.col("_role")).alias("role"), "month")


def footprints(items: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """The item's bbox if it is a valid one in degrees, else the bounds of its corners; ``status`` kept, outside or invalid."""
    box = F.col("bbox")
    valid = (F.size(box) == 4) & box[0].between(-180, 180) & box[2].between(-180, 180) & box[1].between(-90, 90) & box[3].between(-90, 90) & (box[0] < box[2]) & (box[1] < box[3])
    x, y = F.col("corners.x"), F.col("corners.y")
    use = F.when(valid, box).when(F.size("corners") >= 3, F.array(F.array_min(x), F.array_min(y), F.array_max(x), F.array_max(y)))
    rows = items.withColumn("_u", use)
    names = ["xmin", "ymin", "xmax", "ymax"]
    rows = rows.withColumns({n: F.col("_u")[i] for i, n in enumerate(names)})
    meets = (F.col("xmin") <= window[2]) & (F.col("xmax") >= window[0]) & (F.col("ymin") <= window[3]) & (F.col("ymax") >= window[1])
    return rows.select("tile_id", *names, F.when(F.col("_u").isNull(), "invalid").when(meets, "kept").otherwise("outside").alias("status"))


def survey_marks(marks: DataFrame, box: tuple[float, float, float, float], official: str | None = None, hash_of: list[str] | None = None) -> DataFrame:
    """Add ``height`` from its raw text with a strict comma decimal, and ``reason``, null for a valid mark. With ``hash_of`` also ``mark_key``: the
    ``official`` id, or where that is null or blank "local:" and the first 16 digits of a hash of these columns."""
    height = F.when(F.col("height_raw").rlike(r"^-?\d{1,4}(,\d{1,4})?$"), F.replace("height_raw", F.lit(","), F.lit(".")).try_cast("double"))
    rows = marks.withColumn("height", height)
    inside = F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])
    apart = F.greatest(F.abs(F.col("x") - F.col("attr_x")), F.abs(F.col("y") - F.col("attr_y")))
    undulation = F.col("h_ellipsoidal") - F.col("height")
    reason = (
        F.when(~F.coalesce(inside, F.lit(False)), "outside").when(apart > 0.002, "geometry_differs").when(F.col("height").isNull(), "height_unreadable")
        .when(~F.col("height").between(-10, 2500), "height_range").when(~undulation.between(30, 80), "undulation")
    )
    rows = rows.withColumn("reason", reason)
    if not hash_of:
        return rows
    named = F.nullif(F.trim(F.col(official).cast("string")), F.lit("")) if official else F.lit(None).cast("string")
    return rows.withColumn("mark_key", F.coalesce(named, F.concat(F.lit("local:"), F.substring(canon_hash(*[F.col(c) for c in hash_of]), 1, 16))))


def sparql_rows(responses: DataFrame, most: int) -> DataFrame:
    """(response, row_no, binding, value) of a result's bindings; more than ``most`` rows is an error; a boolean is one row."""
    b = F.from_json(F.get_json_object("body", "$.results.bindings"), "array<map<string,struct<type:string,value:string>>>")
    guard = F.when(F.size(b) > most, F.raise_error(F.lit("too many result rows"))).otherwise(b)
    rows = responses.select("response", F.posexplode(guard).alias("row_no", "_b")).select("response", "row_no", F.explode("_b").alias("binding", "_v")).select("response", "row_no", "binding", "_v.value")
    flag = responses.select("response", F.lit(0).alias("row_no"), F.lit("boolean").alias("binding"), F.get_json_object("body", "$.boolean").alias("value")).where("value IS NOT NULL")
    return rows.unionByName(flag)


def xml_scan(files: DataFrame, tag: str) -> DataFrame:
    """(file, root, members, names): local name of the root, how many ``tag`` elements, and their name attributes."""
    root = F.regexp_extract("body", r"<(?:\w+:)?([A-Za-z]\w*)[\s>/]", 1)
    names = F.xpath("body", F.lit(f"//{tag}/@name"))
    return files.select("file", root.alias("root"), F.xpath_int("body", F.lit(f"count(//{tag})")).alias("members"), F.array_join(F.array_sort(names), ",").alias("names"))


def check_statistics(responses: DataFrame) -> DataFrame:
    """Add ``fault``, null for a sound response of SDMX kind by ``format``: JSON with a data container, CSV whose first 1,000
    characters hold a delimiter and no page, XML with a root element."""
    head, keys = F.lower(F.substring("body", 1, 1000)), F.json_object_keys("body")
    contained = F.arrays_overlap(keys, F.array(*[F.lit(k) for k in ("dataSets", "value", "data", "structure")]))
    fault = (
        F.when(F.col("format") == "json", F.when(~F.coalesce(contained, F.lit(False)), "no data container"))
        .when(F.col("format") == "csv", F.when(head.rlike("<html|<!doctype"), "a page").when(~F.coalesce(head.rlike("[,;\t]"), F.lit(False)), "no delimiter"))
        .when(F.col("format") == "xml", F.when(F.coalesce(_root(F.col("body")), F.lit("")) == "", "no root element"))
        .otherwise("unknown format")
    )
    return responses.withColumn("fault", fault)


def _root(body: Column) -> Column:
    """The root's tag, as it is written."""
    return F.regexp_extract(body, r"(?s)^\ufeff?\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<([A-Za-z_][\w:.-]*(?:\s[^>]*)?)/?>", 1)


def check_xml(files: DataFrame, root: str | None = None, namespace: str | None = None, fewest_bytes: int = 1) -> DataFrame:
    """Add ``namespace`` of the root, ``matched`` and ``returned`` as it counts its members (null: not told), and ``fault``, null
    for a file of ``fewest_bytes`` with that root (by local name, any case) whose namespace holds the text."""
    tag = _root(F.col("body"))
    name = F.regexp_extract(tag, r"^([\w:.-]+)", 1)
    prefix = F.when(F.contains(name, F.lit(":")), F.concat(F.lit("xmlns:"), F.substring_index(name, ":", 1))).otherwise("xmlns")
    attributes = F.regexp_extract_all(tag, F.lit(r"([\w:.-]+)\s*=\s*[\"'][^\"']*[\"']"), 1)
    values = F.regexp_extract_all(tag, F.lit(r"[\w:.-]+\s*=\s*[\"']([^\"']*)[\"']"), 1)
    value = lambda k: F.try_element_at(values, F.nullif(F.array_position(attributes, k), F.lit(0)).cast("int"))
    space = value(prefix)
    fault = F.when(F.octet_length("body") < fewest_bytes, "too small").when(name == "", "no root element")
    if root:
        fault = fault.when(F.lower(F.substring_index(name, ":", -1)) != root.lower(), "another root")
    if namespace:
        fault = fault.when(~F.coalesce(F.contains(space, F.lit(namespace)), F.lit(False)), "another namespace")
    fault = F.when(F.col("body").isNull(), "too small").otherwise(fault)
    count = lambda *keys: F.coalesce(*[value(F.lit(k)).try_cast("long") for k in keys])
    return files.withColumns({"namespace": space, "matched": count("numberMatched"), "returned": count("numberReturned", "numberOfFeatures"), "fault": fault})


def _elements(name: str) -> str:
    return f"//*[name()='{name}' or substring-after(name(), ':')='{name}']"


def feature_types(files: DataFrame) -> DataFrame:
    """(file, name) of the feature types that capabilities list, each once."""
    at = f"{_elements('FeatureType')}/*[name()='Name' or substring-after(name(), ':')='Name']/text()"
    return files.select("file", F.explode(F.array_distinct(F.transform(F.xpath("body", F.lit(at)), lambda n: F.trim(n)))).alias("name")).where("name <> ''")


def schema_fields(files: DataFrame, height: str = "alt|cota|ort|nivel|height|z_") -> DataFrame:
    """(file, position, field, is_height) of the elements that a schema names, each once, in order; heights by name."""
    names = F.array_distinct(F.xpath("body", F.lit(f"{_elements('element')}/@name")))
    return files.select("file", F.posexplode(names).alias("position", "field")).where("field <> ''").withColumn("is_height", F.lower("field").rlike(height))


def tile_index(boxes: DataFrame, available: DataFrame, verified: DataFrame | None = None) -> DataFrame:
    """One-degree cells of each box with their name and status listed or not_listed; given the tiles that a listing was read for (``verified``),
    a tile that is neither among them nor listed is unverified."""
    rows = boxes.withColumn("lon", F.explode(F.sequence(F.floor("xmin"), F.ceil("xmax") - 1))).withColumn("lat", F.explode(F.sequence(F.floor("ymin"), F.ceil("ymax") - 1)))
    name = F.concat(F.when(F.col("lat") >= 0, "N").otherwise("S"), F.lpad(F.abs("lat").cast("string"), 2, "0"), F.when(F.col("lon") >= 0, "E").otherwise("W"), F.lpad(F.abs("lon").cast("string"), 3, "0"))
    rows = rows.withColumn("tile", name)
    met = rows.join(available.select("tile", F.lit(1).alias("_l")).distinct(), "tile", "left")
    if verified is not None:
        met = met.join(verified.select("tile", F.lit(1).alias("_v")).distinct(), "tile", "left")
    known = F.col("_v").isNotNull() if verified is not None else F.lit(True)
    return met.select("box", "tile", F.when(F.col("_l") == 1, "listed").when(known, "not_listed").otherwise("unverified").alias("status"))


def road_ways(ways: DataFrame, classes: list[str]) -> DataFrame:
    """Ways of the classes with 2 to 5000 points."""
    return ways.where(F.col("highway").isin(classes) & F.size("points").between(2, 5000))


def bbox_polygons(receipts: DataFrame) -> DataFrame:
    """(tile_id, ring) of each tile's box as WKT with all its digits; tiles with different boxes are an error."""
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    once = receipts.groupBy("tile_id").agg(F.min(box).alias("b"), F.max(box).alias("_c"))
    ok = F.when(F.col("b") == F.col("_c"), F.lit(True)).otherwise(F.raise_error(F.lit("a tile has two boxes")))

    def n(c: str) -> Column:
        """The shortest text that is read as the same number, without exponent."""
        said = F.col(f"b.{c}").cast("double").cast("string")
        return F.regexp_replace(F.when(F.contains(said, F.lit("E")), F.regexp_replace(said.cast("decimal(38,18)").cast("string"), r"0+$", "")).otherwise(said), r"\.0?$", "")

    corner = lambda x, y: F.concat_ws(" ", n(x), n(y))
    ring = F.concat(F.lit("POLYGON(("), F.concat_ws(",", corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmax", "ymax"), corner("xmin", "ymax"), corner("xmin", "ymin")), F.lit("))"))
    return once.where(ok).select("tile_id", ring.alias("ring"))
