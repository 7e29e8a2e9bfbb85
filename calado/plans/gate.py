"""Queries of projections, filters and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.operators import gates as P
from calado.plans._query import query
from calado.plans.sequence import LINES, OPTIONS

DOC_LINES = "SELECT doc_id, text FROM {documents}"


@query("P01_signature", "SELECT page_id, CASE WHEN lower(ltrim(left(html, 256))) LIKE '<!doctype html%' OR lower(ltrim(left(html, 256))) LIKE '<html%' THEN 'html' END AS format FROM pages")
def _(t):
    return t("pages").select("page_id", P.signature(F.encode("html", "UTF-8")).alias("format"))


@query(
    "P02_verify_assets",
    "SELECT source, count(*) AS assets, count(*) FILTER (doc_id % 17 <> 0) AS verified, bool_and(doc_id % 17 <> 0) AS all_ok FROM documents GROUP BY source",
)
def _(t):
    docs = t("documents")
    files = docs.select(F.col("doc_id").alias("name"), F.encode("text", "UTF-8").alias("content"))
    wrong = F.when(F.col("doc_id") % 17 == 0, F.lit("0")).otherwise(F.sha2("text", 256))
    return P.verify_assets(files, docs.select("source", F.col("doc_id").alias("name"), wrong.alias("sha256"), F.octet_length("text").alias("bytes")))


@query("P03_require", "SELECT n_nationkey, n_name FROM nation")
def _(t):
    checks = {"rows": F.count(F.lit(1)) == F.count_distinct("n_nationkey"), "regions": F.count_distinct("n_regionkey") == 5}
    return P.require(t("nation"), checks).select("n_nationkey", "n_name")


@query(
    "P04_resolve_label",
    """WITH m AS (SELECT CAST(p_partkey AS VARCHAR) AS code, lower(p_name || ' ' || p_size) AS l FROM part), w AS (SELECT DISTINCT p_name AS wanted, lower(p_name) AS w FROM part WHERE p_size < 25 UNION SELECT DISTINCT p_name || ' ' || p_size, lower(p_name || ' ' || p_size) FROM part),
    e AS (SELECT wanted, count(*) AS ne, min(code) AS ce FROM w JOIN m ON w.w = m.l GROUP BY 1), p AS (SELECT wanted, count(*) AS np, min(code) AS cp FROM w JOIN m ON contains(m.l, w.w) GROUP BY 1)
    SELECT w.wanted, CASE WHEN ne = 1 THEN ce WHEN ne IS NULL AND np = 1 THEN cp END AS code, CASE WHEN ne = 1 THEN 'exact' WHEN ne > 1 THEN 'ambiguous' WHEN np = 1 THEN 'within' WHEN np > 1 THEN 'ambiguous' ELSE 'absent' END AS status FROM w LEFT JOIN e USING (wanted) LEFT JOIN p USING (wanted)""",
)
def _(t):
    parts = t("part")
    label = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))
    wanted = parts.where("p_size < 25").select(F.col("p_name").alias("wanted")).union(parts.select(label)).distinct()
    return P.resolve_label(parts.select(F.col("p_partkey").cast("string").alias("code"), label.alias("label")), wanted)


@query("P05_select_members", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS VARCHAR) LIKE '%1998%' AND o_orderstatus = 'F' AND contains(lower(o_orderpriority), 'low')")
def _(t):
    members = t("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("code"), F.col("o_orderpriority").alias("label"), F.col("o_orderstatus").alias("level"))
    return P.select_members(members, year="1998", contains="low", level="F").select("o_orderkey")


#: Keyword families for the synthetic prose.
VOCABULARY = {"rail": ["tion", "stat"], "road": ["route", "verb"], "water": ["eau", "agua"]}


def _sql_tags(text: str) -> str:
    cases = ", ".join(f"CASE WHEN {' OR '.join(f'contains({text}, {w!r})' for w in words)} THEN '{name}' END" for name, words in sorted(VOCABULARY.items()))
    return f"concat_ws('|', {cases})"


_FOLD = "strip_accents(lower(text))"


@query(
    "P06_admit_rows",
    f"""WITH l AS (SELECT doc_id, generate_subscripts(p, 1) - 1 AS pos, unnest(p) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)), g AS (SELECT doc_id, pos, {_sql_tags(_FOLD)} AS tags, regexp_matches(text, '[0-9]') AS num FROM l)
    SELECT doc_id, pos, tags, CASE WHEN num AND tags <> '' THEN 'admitted' WHEN num OR tags <> '' THEN 'candidate' ELSE 'rejected' END AS status FROM g""",
)
def _(t):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    return P.admit_rows(lines, "text", VOCABULARY).select("doc_id", "pos", "tags", "status")


@query(
    "P06_admit_table_rows",
    f"""WITH l AS (SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM said), h AS (SELECT conv_id, string_agg(text, ' | ' ORDER BY i) AS context FROM l WHERE i <= 2 GROUP BY conv_id),
    g AS (SELECT conv_id, turn, {_sql_tags("strip_accents(lower(replace(context || ' ' || text, 'ß', 'ss')))")} AS tags, regexp_matches(text, '[0-9]') AS num FROM l JOIN h USING (conv_id) WHERE i > 2)
    SELECT conv_id, turn, tags, CASE WHEN num AND tags <> '' THEN 'admitted' WHEN num OR tags <> '' THEN 'candidate' ELSE 'rejected' END AS status FROM g""",
    said=LINES,
)
def _(t, said):
    return P.admit_rows(P.header_context(said, ["conv_id"], "turn", "text"), "text", VOCABULARY, "context").select("conv_id", "turn", "tags", "status")


# An order's lines as the lines of a page: two numbers each, or a heading.
PRINTED = "SELECT l_orderkey AS page, l_linenumber AS line_no, CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN concat(' Tabela ', l_orderkey) WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'no number here' ELSE concat(CAST(l_quantity AS BIGINT), ' of ', l_partkey, CASE WHEN l_linestatus = 'F' THEN ' by truck' ELSE ' by rail' END) END AS text FROM {lineitem}"


@query(
    "P07_table_candidate_pages",
    r"""WITH c AS (SELECT page, count(*) FILTER (len(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*')) >= 2) AS number_lines, count(*) FILTER (regexp_matches(text, '(?i)^\s*(tab(le|ela|la)|fig(ure|ura)?)\b')) AS headings FROM printed GROUP BY page)
    SELECT * FROM c WHERE number_lines >= 4 OR headings > 0""",
    printed=PRINTED,
)
def _(t, printed):
    return P.table_candidate_pages(printed, ["page"])


# An order's lines as printed columns, some of them empty, and lines of prose between.
LAID_OUT = """SELECT page, line_no, flag, supplier, part, amount, CASE WHEN line_no % 5 = 4 THEN 'shipped by rail and by truck' ELSE concat(rpad(flag, 6, ' '), lpad(coalesce(supplier, ''), 9, ' '), lpad(part, 10, ' '), '  |', lpad(amount, 4, ' ')) END AS text FROM
  (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line_no, concat(l_returnflag, l_linestatus) AS flag, CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_suppkey AS VARCHAR(9)) END AS supplier,
  CAST(l_partkey AS VARCHAR(9)) AS part, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(9)) AS amount FROM {lineitem}) AS l"""


@query(
    "P07_tables_from_lines",
    """WITH r AS (SELECT *, line_no - row_number() OVER (PARTITION BY page ORDER BY line_no) AS island FROM laid_out WHERE line_no % 5 <> 4), c AS (SELECT *, count(*) OVER w AS n, count(supplier) OVER w > 0.25 * count(*) OVER w AS has, row_number() OVER (PARTITION BY page, island ORDER BY line_no) - 1 AS row_no FROM r WINDOW w AS (PARTITION BY page, island)),
    g AS (SELECT page, dense_rank() OVER (PARTITION BY page ORDER BY island) - 1 AS table_no, row_no, CASE WHEN has THEN [flag, coalesce(supplier, ''), part, amount] ELSE [flag, concat_ws(' ', supplier, part), amount] END AS cells FROM c WHERE n >= 2)
    SELECT page, CAST(table_no AS INTEGER) AS table_no, CAST(row_no AS INTEGER) AS row_no, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS column_no, unnest(cells) AS text FROM g""",
    laid_out=LAID_OUT,
)
def _(t, laid_out):
    return P.tables_from_lines(laid_out, ["page"])


@query("P08_scope_rows", f"SELECT page, line_no FROM printed WHERE (contains({_FOLD}, 'truck') OR contains({_FOLD}, 'tabela')) AND (contains({_FOLD}, '7') OR contains({_FOLD}, 'by')) AND regexp_matches(text, '[0-9]')", printed=PRINTED)
def _(t, printed):
    return P.scope_rows(printed, "text", ["truck", "tabela"], ["7", "by"]).select("page", "line_no")


@query(
    "P08_scope_by_profile",
    f"""WITH s AS (SELECT doc_id, source, generate_subscripts(p, 1) - 1 AS sentence_no, unnest(p) AS text FROM (SELECT doc_id, source, string_split(regexp_replace(text, '([.!?])[ \t\n\r\f]+', '\1' || chr(7), 'g'), chr(7)) AS p FROM documents))
    SELECT doc_id, CAST(sentence_no AS INTEGER) AS sentence_no FROM s WHERE regexp_matches(text, '[0-9]') AND (source = 'src1' AND contains({_FOLD}, 'an') OR source = 'src2' AND contains({_FOLD}, 'th') AND (contains({_FOLD}, 'ion') OR contains({_FOLD}, 'eau')))""",
)
def _(t):
    return P.scope_by_profile(P.sentences(t("documents"), "text"), "source", "text", {"src1": (["an"], None), "src2": (["th"], ["ion", "eau"])}).select("doc_id", "sentence_no")


@query("P09_classify_metric_unit", f"SELECT conv_id, turn, CASE WHEN contains({_FOLD}, 'tion') THEN 'movement' WHEN contains({_FOLD}, 'eau') THEN 'water' END AS metric, CASE WHEN contains({_FOLD}, ' km') THEN 'km' WHEN contains({_FOLD}, 'the') THEN 'count' END AS unit FROM lines", lines=LINES)
def _(t, lines):
    return lines.select("conv_id", "turn", P.classify_first(F.col("text"), [("movement", "tion"), ("water", "eau")]).alias("metric"), P.classify_first(F.col("text"), [("km", " km"), ("count", "the")]).alias("unit"))


_XY = "SELECT c_custkey, CAST((c_custkey * 5303) % 100003 AS DOUBLE) AS x, CAST((c_custkey * 9711) % 100019 AS DOUBLE) AS y FROM {customer}"


@query(
    "P10_in_corridor",
    """WITH t AS (SELECT *, least(1.0, greatest(0.0, ((x - 20000) * 50000 + (y - 30000) * 40000) / (50000.0 * 50000 + 40000.0 * 40000))) AS u FROM xy)
    SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN x BETWEEN 14000 AND 76000 AND y BETWEEN 24000 AND 76000 ELSE sqrt(power(x - 20000 - u * 50000, 2) + power(y - 30000 - u * 40000, 2)) <= 14000 END AS inside FROM t""",
    xy=_XY,
)
def _(t, xy):
    ends = [F.lit(v) for v in (20000.0, 30000.0, 70000.0, 70000.0)]
    return xy.select("c_custkey", P.in_corridor(F.col("x"), F.col("y"), *ends, F.col("c_custkey") % 2 == 0).alias("inside"))


@query("P11_valid_travel", "SELECT option_id, CASE WHEN residents <= 700 AND length_km <= 300 THEN minutes END AS minutes FROM options", options=OPTIONS)
def _(t, options):
    return options.select("option_id", P.valid_travel(F.col("minutes"), F.col("residents"), F.col("length_km"), 700.0).alias("m"), "length_km", "minutes").select("option_id", F.when(F.col("length_km") <= 300, F.col("m")).alias("minutes"))


@query("P12_classify", "SELECT option_id, CASE WHEN length_km <= 3 THEN 'near' WHEN length_km <= 20 THEN 'middle' ELSE 'far' END AS distance_class FROM options", options=OPTIONS)
def _(t, options):
    return options.select("option_id", P.classify(F.col("length_km"), [(3, "near"), (20, "middle")], "far").alias("distance_class"))


@query(
    "P13_coverage_status",
    """SELECT o_orderkey, CASE WHEN s IS NULL OR s >= 400 THEN 'unavailable' WHEN tr THEN 'truncated' WHEN f IS NULL THEN 'unknown' WHEN f = 0 THEN 'no_feature' ELSE 'hit' END AS status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN 200 + (o_orderkey % 3) * 150 END AS s, o_custkey % 11 = 0 AS tr, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 5 END AS f FROM orders)""",
)
def _(t):
    o = t("orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 13 <> 0 THEN 200 + (o_orderkey % 3) * 150 END AS s", "o_custkey % 11 = 0 AS tr", "CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 5 END AS f")
    return o.select("o_orderkey", P.coverage_status(F.col("s"), F.col("tr"), F.col("f")).alias("status"))


@query("P14_clean_count", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS people FROM customer")
def _(t):
    return t("customer").select("c_custkey", P.clean_count(F.col("c_acctbal")).alias("people"))


@query("P15_interest_cells", "SELECT option_id, minutes <= 1200 AND residents <= 4000 AND speed BETWEEN 2 AND 12 AS interest FROM options", options=OPTIONS)
def _(t, options):
    return options.select("option_id", P.interest_cells(F.col("minutes"), F.col("residents"), F.col("speed")).alias("interest"))


@query("P16_flatten_metrics", "SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS \"A\", sum(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS \"N\", sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS \"R\" FROM lineitem GROUP BY 1")
def _(t):
    return P.flatten_metrics(t("lineitem"), ["l_suppkey"], "l_returnflag", "l_quantity", ["A", "N", "R"])
