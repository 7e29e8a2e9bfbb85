"""Queries of the sources (S01 to S26). Payloads are made by Spark from the tables, as producers would send them."""

from __future__ import annotations

from pyspark.sql import functions as F

from calado.plans._query import query
from calado.plans.aggregate import CELLS
from calado.plans.sequence import RECTS
from calado.sources import payloads as S


@query(
    "S01_validate_specs",
    """SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 5 = 4 THEN 'id' END, CASE WHEN c_nationkey = 3 THEN 'title' END, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'access' END, CASE WHEN c_acctbal > 0 AND c_nationkey % 2 = 0 THEN 'release_reuse' END, CASE WHEN c_acctbal > 0 AND c_nationkey % 4 = 1 THEN 'release_gate' END) AS errors FROM customer""",
)
def _(t):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    specs = t("customer").select(
        "c_custkey", F.when(k % 5 == 4, "X1").otherwise(F.concat(F.lit("F"), F.lpad((k % 100).cast("string"), 2, "0"))).alias("source_set_id"), F.when(n == 3, " ").otherwise(F.col("c_name")).alias("title"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "private").otherwise("public").alias("access"), F.when(F.col("c_acctbal") > 0, "public_release").otherwise("receipt_only").alias("sink"), F.lit("yearly").alias("cadence"),
        F.when(n % 2 == 0, "open").otherwise("verified").alias("reuse"), F.when(n % 4 == 1, "none").otherwise("asset_check_required").alias("gate"),
    )
    return S.validate_specs(specs).select("c_custkey", F.array_join("errors", ",").alias("errors"))


def _pages(t):
    """Orders of a status as pages of JSON records."""
    rows = t("orders").select(F.col("o_orderstatus").alias("dataset"), F.floor(F.col("o_orderkey") / 100).alias("page_offset"), F.struct("o_orderkey", "o_custkey").alias("r"))
    body = F.to_json(F.struct(F.array_sort(F.collect_list("r")).alias("results"), F.count(F.lit(1)).alias("n")))
    return rows.groupBy("dataset", "page_offset").agg(body.alias("body"), F.count(F.lit(1)).alias("n"))


_PAGE_SQL = "SELECT o_orderstatus AS dataset, CAST(floor(o_orderkey / 100) AS BIGINT) AS page_offset, o_orderkey, o_custkey, CAST(row_number() OVER (PARTITION BY o_orderstatus, floor(o_orderkey / 100) ORDER BY o_orderkey) - 1 AS INTEGER) AS pos FROM orders"


@query("S02_compose_record_pages", f"SELECT dataset, page_offset, pos, '{{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || '}}' AS record FROM ({_PAGE_SQL})")
def _(t):
    return S.compose_record_pages(_pages(t))


@query("S03_compose_feature_pages", f"SELECT dataset, page_offset, pos, '{{\"x\":' || o_custkey || '}}' AS geometry, '{{\"k\":' || o_orderkey || '}}' AS properties FROM ({_PAGE_SQL})")
def _(t):
    feature = F.struct(F.struct(F.col("o_custkey").alias("x")).alias("geometry"), F.struct(F.col("o_orderkey").alias("k")).alias("properties"))
    rows = t("orders").select(F.col("o_orderstatus").alias("dataset"), F.floor(F.col("o_orderkey") / 100).alias("page_offset"), F.struct("o_orderkey", feature.alias("f")).alias("r"))
    listed = F.transform(F.array_sort(F.collect_list("r")), lambda r: r["f"])
    return S.compose_feature_pages(rows.groupBy("dataset", "page_offset").agg(F.to_json(F.struct(listed.alias("features"))).alias("body")))


@query(
    "S04_check_pages",
    """WITH p AS (SELECT l_suppkey AS dataset, CAST(floor(l_orderkey / 500) AS BIGINT) AS page_offset, count(*) AS n FROM lineitem GROUP BY 1, 2), a AS (SELECT dataset, sum(n) AS observed, CAST(sum(n) + dataset % 2 AS BIGINT) AS declared, count(*) AS pages, true AS stable, count(*) < 2 OR dataset % 3 <> 0 AS distinct_urls, count(*) FILTER (n < 3) AS short, last(n ORDER BY page_offset) AS last_n FROM p GROUP BY dataset)
    SELECT dataset, observed, declared, pages, stable, distinct_urls, short = 0 OR (short = 1 AND last_n < 3) AS full, observed = declared AND distinct_urls AND (short = 0 OR (short = 1 AND last_n < 3)) AS complete FROM a""",
)
def _(t):
    from pyspark.sql import Window

    # One shuffle of the two keys serves all that follows; its tasks grow with the lines, as few bytes hold many.
    lines = t("lineitem")
    tasks = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), lines.count() // 1_000_000 + 1)
    dealt = lines.select(F.col("l_suppkey").alias("dataset"), F.floor(F.col("l_orderkey") / 500).alias("page_offset")).repartition(tasks, "dataset")
    rows = dealt.groupBy("dataset", "page_offset").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("dataset")
    rows = rows.withColumn("total", F.sum("n").over(w) + F.col("dataset") % 2)
    rows = rows.withColumn("source_url", F.when(F.col("dataset") % 3 == 0, "same").otherwise(F.concat(F.lit("p"), F.col("page_offset"))))
    return S.check_pages(rows, 3)


@query(
    "S05_jsonstat_to_rows",
    """WITH v AS (SELECT l_suppkey AS cube, (l_linenumber - 1) * 3 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS i, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2)
    SELECT cube, CAST(i AS BIGINT) AS linear_index, (CAST(floor(i / 3) AS BIGINT) + 1) || '|' || ['A', 'N', 'R'][i % 3 + 1] AS codes, CASE WHEN value % 5 <> 0 THEN value END AS value, CASE WHEN value % 5 = 0 THEN '..' END AS text,
    CASE WHEN cube % 2 = 0 THEN 's' || i WHEN i % 4 = 1 THEN 'e' || i END AS status FROM v""",
)
def _(t):
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    cells = t("lineitem").groupBy(F.col("l_suppkey").alias("cube"), ((F.col("l_linenumber") - 1) * 3 + flag).alias("i")).agg(F.sum("l_quantity").alias("v"))
    said = F.when(F.col("v") % 5 == 0, '".."').otherwise(F.col("v").cast("string"))
    cubes = cells.groupBy("cube").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "i", F.lit('":'), said)), ","), F.lit("}")).alias("value"))
    members = F.create_map(F.lit("line"), F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: i.cast("string")), F.lit("flag"), F.array(F.lit("A"), F.lit("N"), F.lit("R")))
    listed = F.to_json(F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.concat(F.lit("s"), i)))
    keyed = F.to_json(F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(20), F.lit(4)), lambda i: F.struct(i.cast("string"), F.concat(F.lit("e"), i)))))
    status = F.when(F.col("cube") % 2 == 0, listed).otherwise(keyed)
    return S.jsonstat_to_rows(cubes.select("cube", F.array(F.lit("line"), F.lit("flag")).alias("id"), F.array(F.lit(7), F.lit(3)).alias("size"), members.alias("codes"), "value", status.alias("status")))


@query(
    "S06_flatten_period_map",
    """SELECT s_nationkey % 5 AS response, 'ok' AS outcome, 'P' || s_suppkey % 3 AS period, CAST(s_suppkey AS VARCHAR) AS geocod, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey * 2 AS VARCHAR) END AS valor, CASE WHEN s_suppkey % 4 = 0 THEN 'x' END AS sinal_conv FROM supplier UNION ALL SELECT 99, 'row_limit', NULL, NULL, NULL, NULL FROM region WHERE r_regionkey = 0""",
)
def _(t):
    s = t("supplier")
    obs = F.create_map(F.lit("geocod"), F.col("s_suppkey").cast("string"), F.lit("valor"), F.when(F.col("s_suppkey") % 4 != 0, (F.col("s_suppkey") * 2).cast("string")), F.lit("sinal_conv"), F.when(F.col("s_suppkey") % 4 == 0, "x"))
    rows = s.groupBy((F.col("s_nationkey") % 5).alias("response"), F.concat(F.lit("P"), F.col("s_suppkey") % 3).alias("p")).agg(F.collect_list(obs).alias("o"))
    good = rows.groupBy("response").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("p", "o"))).alias("Dados"))).alias("body"))
    bad = t("region").where("r_regionkey = 0").select(F.lit(99).alias("response"), F.lit('{"Sucesso":{"Falso":[{"Cod":"7","Msg":"limit"}]}}').alias("body"))
    return S.flatten_period_map(good.unionByName(bad))


@query("S07_dimension_members", "SELECT n_regionkey AS indicator, 1 AS dim, 'c' || n_nationkey AS code, n_name AS label FROM nation UNION ALL SELECT n_regionkey, 2, 'd' || n_nationkey, n_name FROM nation")
def _(t):
    n = t("nation")
    flat = F.struct(F.lit(1).alias("dim_num"), F.concat(F.lit("c"), "n_nationkey").alias("cat_id"), F.col("n_name").alias("categ_dsg"))
    member = F.struct(F.concat(F.lit("d"), "n_nationkey").alias("cod"), F.col("n_name").alias("dsg"))
    one = n.groupBy(F.col("n_regionkey").alias("indicator")).agg(F.to_json(F.collect_list(flat)).alias("a"), F.to_json(F.array(F.struct(F.lit(2).alias("Dim"), F.collect_list(member).alias("Membros")))).alias("b"))
    both = one.select("indicator", F.explode(F.array("a", "b")).alias("meta"))
    groups = both.groupBy("indicator").agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.regexp_replace("meta", r"^\[|\]$", "")), ","), F.lit("]")).alias("meta"))
    return S.dimension_members(groups)


@query("S07_period_labels", "SELECT n_regionkey AS indicator, 'c' || n_nationkey AS code, n_name AS label FROM nation WHERE n_nationkey % 4 <> 3")
def _(t):
    k, n = F.col("n_nationkey") % 4, F.col("n_name")
    item = F.struct(F.lit(1).alias("dim_num"), F.concat(F.lit("c"), "n_nationkey").alias("cat_id"), F.when(k == 0, n).otherwise("").alias("categ_dsg"), F.when(k == 1, n).alias("Designacao"), F.when(k == 2, n).alias("label"))
    return S.period_labels(t("nation").groupBy(F.col("n_regionkey").alias("indicator")).agg(F.to_json(F.collect_list(item)).alias("meta")))


@query("S08_zip_variables", "SELECT l_suppkey AS table_id, count(*) AS rows, count(*) FILTER (l_linenumber = 7) AS bad_length, sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS markers, true AS unique_names FROM lineitem GROUP BY 1")
def _(t):
    flag = F.when(F.col("l_returnflag") == "N", "..").otherwise(F.col("l_returnflag"))
    row = F.when(F.col("l_linenumber") == 7, F.array(flag)).otherwise(F.array(flag, F.col("l_quantity").cast("string")))
    table = t("lineitem").select(F.col("l_suppkey").alias("table_id"), F.col("l_orderkey").alias("row_no"), F.array(F.lit("flag"), F.lit("quantity")).alias("variables"), row.alias("row"))
    return S.zip_variables(table)[1]


@query("S09_walk_rows", "SELECT DISTINCT event_id AS doc, '/data/0/inner' AS pointer, '{\"value\":' || CAST(json_extract(props, '$.k') AS INTEGER) || '}' AS \"row\" FROM events")
def _(t):
    body = F.concat(F.lit('{"meta":{"a":1},"data":[{"inner":{"value":'), F.get_json_object("props", "$.k"), F.lit("}}]}"))
    return S.walk_rows(t("events").select(F.col("event_id").alias("doc"), body.alias("body")))


@query("S10_json_path", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 3 WHEN event_id % 3 = 1 THEN 1 END AS records, event_id % 3 = 0 AS enough FROM events")
def _(t):
    k = F.col("event_id") % 3
    body = F.when(k == 0, '{"a":{"b":[1,2,3]}}').when(k == 1, '{"a":{"b":{"c":1}}}').otherwise('{"a":{}}')
    return S.json_path(t("events").select("event_id", body.alias("body")), "body", "a.b", 2, top="object").select("event_id", "records", "enough")


@query("S11_html_tables", "SELECT n_regionkey AS page_id, CAST(n_regionkey % 2 AS INTEGER) AS table_no, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INTEGER) AS row_no, n_name || ' & <co>|' || n_nationkey AS cells FROM nation")
def _(t):
    row = F.struct("n_nationkey", F.concat(F.lit("<tr><td> <b>"), "n_name", F.lit("</b>\n&#38;&nbsp;&lt;co&gt;</td><td>"), "n_nationkey", F.lit("</td></tr>")).alias("h"))
    rows = t("nation").groupBy(F.col("n_regionkey").alias("page_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["h"]), "").alias("h"))
    head = F.when(F.col("page_id") % 2 == 0, "").otherwise("<table><tr><td>&nbsp;</td></tr></table><TABLE><tr><td>other</td></tr></TABLE>")
    html = F.concat(F.lit('<script>var a="</table>"</script>'), head, F.lit("<table><tr><td> </td></tr><tr><td>Nati&oacute;n</td><td>Key</td></tr>"), "h", F.lit("<tr><td> </td></tr></table>"))
    return S.html_tables(rows.select("page_id", html.alias("html")), headers=["nation"]).withColumn("cells", F.array_join("cells", "|"))


@query(
    "S12_links",
    r"""WITH clean AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS root, regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g') AS h FROM pages),
    a AS (SELECT page_id, root, generate_subscripts(l, 1) - 1 AS position, unnest(l) AS tag FROM (SELECT page_id, root, regexp_extract_all(h, '(?is)(<a\b[^>]*>.*?</a\s*>)', 1) AS l FROM clean)),
    b AS (SELECT page_id, root || regexp_extract(tag, '(?is)href="([^"]+)"', 1) AS href, position FROM a) SELECT page_id, href, CAST(min(position) AS INTEGER) AS position FROM b GROUP BY 1, 2""",
)
def _(t):
    return S.links(t("pages")).select("page_id", "href", "position")


@query("S13_embedded_charts", "SELECT page_id, 0 AS script_no, 0 AS call_no, regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS payload FROM pages")
def _(t):
    return S.embedded_charts(t("pages"))


@query(
    "S13_chart_rows",
    """SELECT c_nationkey AS page_id, 'easychart-chart-' || c_nationkey AS chart, json_object('n', c_nationkey) AS config, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS row_no, c_name || '|' || c_custkey AS cells FROM customer""",
)
def _(t):
    """A page of each nation, with a chart of its customers."""
    row = F.struct("c_custkey", F.array("c_name", F.col("c_custkey").cast("string")).alias("r"))
    data = F.to_json(F.transform(F.array_sort(F.collect_list(row)), lambda e: e["r"]))
    html = F.concat(F.lit("<html><script>var c = document.getElementById('easychart-chart-"), "page_id", F.lit("'); c.setConfigStringified('{\"n\":"), "page_id", F.lit("}'); c.setData("), "d", F.lit(");</script></html>"))
    pages = t("customer").groupBy(F.col("c_nationkey").alias("page_id")).agg(data.alias("d")).select("page_id", html.alias("html"))
    return S.chart_rows(pages, fewest=1).select("page_id", "chart", "config", "row_no", F.array_join("cells", "|").alias("cells"))


@query("S14_select_resources", "SELECT package, name, rank FROM (SELECT p_brand AS package, p_name || '-' || p_partkey AS name, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_name || '-' || p_partkey DESC) AS rank FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_name LIKE '%r%') WHERE rank <= 3")
def _(t):
    r = t("part").select(F.col("p_brand").alias("package"), F.concat_ws("-", "p_name", F.col("p_partkey").cast("string")).alias("name"), F.lit("u").alias("url"), F.lower("p_type").alias("format"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("created"), F.lit(None).cast("string").alias("last_modified"))
    return S.select_resources(r, "r", ["ECONOMY", "PROMO"], 3).select("package", "name", "rank")


@query("S15_bbox_scan", "SELECT tile_id FROM rects WHERE xmin <= 400 AND xmax >= 200 AND ymin <= 500 AND ymax >= 300", rects=RECTS)
def _(t, rects):
    return S.bbox_scan(rects, 200, 300, 400, 500).select("tile_id")


@query("S16_raster_cells", "SELECT row, col, CASE WHEN z > 0 THEN z END AS z FROM cells", cells=CELLS)
def _(t, cells):
    marked = cells.withColumn("z", F.when(F.col("z") > 0, F.col("z")).when(F.col("col") % 2 == 0, F.lit(-9999.0)).otherwise(F.lit(float("nan"))))
    return S.raster_cells(marked).select("row", "col", "z")


@query("S17_profile_payload", r"SELECT doc_id, count(*) AS rows, max(len(string_split(l, ','))) AS max_columns, 'delimited' AS kind FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l) <> '' GROUP BY doc_id")
def _(t):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    return S.profile_payload(lines, "doc_id", "text")


@query("S17_profile_json", "SELECT o_custkey AS k, 'status|value' AS top_keys, count(*) AS value_slots, count(DISTINCT o_orderstatus) AS status_slots FROM orders GROUP BY 1")
def _(t):
    files = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_list("o_orderkey").alias("value"), F.collect_set(F.struct("o_orderstatus", F.lit(1))).alias("s"))
    files = files.select("k", F.to_json(F.struct("value", F.map_from_entries("s").alias("status"))).alias("body"))
    return S.profile_json(files, "k", "body").select("k", F.array_join("top_keys", "|").alias("top_keys"), F.col("value_slots").cast("long").alias("value_slots"), F.col("status_slots").cast("long").alias("status_slots"))


@query(
    "S18_resolve_members",
    """WITH n AS (SELECT DISTINCT c_mktsegment || '/' || c_nationkey || '/' || (c_custkey % 97) || '.csv' AS name FROM customer), w AS (SELECT DISTINCT c_nationkey || '/' || (c_custkey % 97) || '.csv' AS logical FROM customer),
    m AS (SELECT logical, count(name) AS k, max(name) AS name FROM w LEFT JOIN n ON substr(name, strpos(name, '/') + 1) = logical GROUP BY logical)
    SELECT logical, CASE WHEN k = 1 THEN name END AS name, CASE k WHEN 1 THEN 'suffix' WHEN 0 THEN 'missing' ELSE 'ambiguous' END AS status FROM m""",
)
def _(t):
    tail = F.concat(F.col("c_nationkey"), F.lit("/"), F.col("c_custkey") % 97, F.lit(".csv"))
    return S.resolve_members(t("customer").select(F.concat("c_mktsegment", F.lit("/"), tail).alias("name")), t("customer").select(tail.alias("logical")))


@query(
    "S18_map_members",
    """WITH s AS (SELECT r_name AS profile, o_orderkey AS path, CASE WHEN contains(t, lower(substr(r_name, 1, 2))) THEN 5 ELSE 0 END + CASE WHEN contains(t, 'low') THEN 1 ELSE 0 END + CASE WHEN contains(t, lower(r_name)) THEN 1 ELSE 0 END AS score FROM region, (SELECT o_orderkey, lower(o_orderpriority) AS t FROM orders)),
    k AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY score DESC, path) AS i FROM s WHERE score > 0), b AS (SELECT profile, first(path ORDER BY i) AS path, max(score) AS score, min(score) AS lo, count(*) AS n FROM k WHERE i <= 2 GROUP BY profile)
    SELECT r_name AS profile, CASE WHEN n = 1 OR score - lo >= 2 THEN path END AS path, score, CASE WHEN score IS NULL THEN 'absent' WHEN n = 1 OR score - lo >= 2 THEN 'unique' ELSE 'ambiguous' END AS status FROM region LEFT JOIN b ON r_name = profile""",
)
def _(t):
    profiles = t("region").select(F.col("r_name").alias("profile"), F.lower(F.substring("r_name", 1, 2)).alias("literal"), F.array(F.lit("low"), F.lower("r_name")).alias("tokens"))
    return S.map_members(t("orders").select(F.col("o_orderkey").alias("path"), F.lower("o_orderpriority").alias("folded_text")), profiles)


@query(
    "S18_identify_members",
    """WITH p AS (SELECT n_nationkey, lower(n_name) AS name, n_name AS profile FROM nation),
    m AS (SELECT CASE WHEN c_custkey % 149 = c_nationkey AND c_nationkey % 4 = 0 THEN lower(n_name) || '/' || c_custkey || '.csv' WHEN c_custkey = c_nationkey + 1 AND c_nationkey % 3 = 0 THEN 'z/' || lower(n_name) || '.pdf' ELSE 'z/' || c_custkey || '.csv' END AS path,
      CASE WHEN c_custkey % 401 = c_nationkey THEN 'yearly ' || lower(n_name) || ' counts' ELSE lower(c_mktsegment) END AS txt FROM customer JOIN nation ON c_nationkey = n_nationkey),
    s AS (SELECT profile, path, split_part(split_part(path, '/', 2), '.', 1) = name AS stem, contains(txt, name) AS literal, contains(path || ' ' || txt, substr(name, 1, 4)) AS producer,
      CAST(contains(path || ' ' || txt, 'count') AS INTEGER) + CAST(contains(path || ' ' || txt, 'build') AS INTEGER) AS products, contains(path || ' ' || txt, 'auto') AS place, ends_with(path, '.csv') AS ext FROM p, m),
    v AS (SELECT *, 500 * CAST(stem AS INTEGER) + 100 * CAST(literal AS INTEGER) + 20 * CAST(producer AS INTEGER) + 10 * products + 5 * CAST(place AS INTEGER) + 3 * CAST(ext AS INTEGER) AS score FROM s),
    k AS (SELECT *, row_number() OVER (PARTITION BY profile ORDER BY score DESC, path) AS i FROM v WHERE score > 0),
    b AS (SELECT profile, count(*) FILTER (stem) AS stems, count(*) FILTER (literal) AS literals, min(path) FILTER (stem) AS sp, min_by(score, path) FILTER (stem) AS ss, min(path) FILTER (literal) AS lp, min_by(score, path) FILTER (literal) AS ls,
      max(path) FILTER (i = 1) AS tp, max(score) FILTER (i = 1) AS ts, coalesce(max(score) FILTER (i = 2), -1) AS nx, bool_or(producer AND products > 0) FILTER (i = 1) AS named FROM k GROUP BY profile),
    w AS (SELECT *, CASE WHEN stems = 1 THEN 'stem' WHEN stems > 1 THEN 'several stems' WHEN literals = 1 THEN 'text' WHEN named AND literals > 1 AND ts - nx >= 25 THEN 'tokens' WHEN named AND literals = 0 AND ts >= 43 AND ts - nx >= 15 THEN 'tokens' END AS basis FROM b)
    SELECT profile, CASE basis WHEN 'stem' THEN sp WHEN 'text' THEN lp WHEN 'tokens' THEN tp END AS path, CASE basis WHEN 'stem' THEN ss WHEN 'text' THEN ls WHEN 'tokens' THEN ts END AS score,
      CASE WHEN ts IS NULL THEN 'absent' WHEN basis IN ('stem', 'text', 'tokens') THEN 'unique' ELSE 'ambiguous' END AS status, basis FROM w""",
)
def _(t):
    """All customers as members, some of which name a nation in folder, stem or text; every nation's profile."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    met = t("customer").join(t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lower("n_name").alias("name")), "c_nationkey")
    path = F.when((k % 149 == n) & (n % 4 == 0), F.concat("name", F.lit("/"), k, F.lit(".csv"))).when((k == n + 1) & (n % 3 == 0), F.concat(F.lit("z/"), "name", F.lit(".pdf"))).otherwise(F.concat(F.lit("z/"), k, F.lit(".csv")))
    text = F.when(k % 401 == n, F.concat(F.lit("yearly "), "name", F.lit(" counts"))).otherwise(F.lower("c_mktsegment"))
    one = lambda v: F.array(F.lit(v))
    profiles = t("nation").select(F.col("n_name").alias("profile"), F.array(F.substring(F.lower("n_name"), 1, 4)).alias("producers"), F.array(F.lit("count"), F.lit("build")).alias("products"), one("auto").alias("places"), F.lit(".csv").alias("extension"))
    return S.identify_members(met.select(path.alias("path"), text.alias("folded_text")), profiles)


@query("S19_workbook_rows", "SELECT CAST(floor(c_custkey / 50) AS BIGINT) AS sheet, c_custkey % 50 AS row, 0 AS col, 'Nation code' AS label, CAST(c_nationkey AS VARCHAR) AS value FROM customer WHERE c_custkey % 50 > 3")
def _(t):
    row = F.col("c_custkey") % 50
    value = F.when(row == 3, "Nation code").when(row == 1, "a code").otherwise(F.col("c_nationkey").cast("string"))
    cells = t("customer").select(F.floor(F.col("c_custkey") / 50).alias("sheet"), row.alias("row"), F.lit(0).alias("col"), value.alias("value"))
    return S.workbook_rows(cells, {"nation": 3, "code": 1})


@query(
    "S19_workbook_columns",
    """SELECT n_regionkey AS sheet, n_nationkey AS col, CASE WHEN n_nationkey % 3 = 0 THEN 'col_' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') ELSE 'Code | ' || n_name END AS label, CASE WHEN n_nationkey % 3 > 0 AND n_nationkey = min(CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey END) OVER (PARTITION BY n_regionkey) THEN 'code' END AS role FROM nation""",
)
def _(t):
    n = t("nation").withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(9))))
    value = F.when((F.col("row") >= 7) | (F.col("n_nationkey") % 3 == 0), "").when(F.col("row") == 5, "Code").when(F.col("row") == 6, F.col("n_name")).when(F.col("row") < 3, "x").otherwise("")
    cells = n.select(F.col("n_regionkey").alias("sheet"), "row", F.col("n_nationkey").alias("col"), value.alias("value"))
    return S.workbook_columns(cells, {"code": 5}, {"code": "code"}, {}).select("sheet", "col", "label", "role")


@query(
    "S20_footprints",
    """SELECT tile_id, CASE WHEN k = 0 THEN 'invalid' WHEN x0 <= 60 AND x0 + w >= 20 AND y0 <= 40 AND y0 + 1 >= 10 THEN 'kept' ELSE 'outside' END AS status FROM (SELECT c_custkey AS tile_id, c_custkey % 3 AS k, CAST((c_custkey * 53) % 170 AS DOUBLE) AS x0, CAST((c_custkey * 71) % 80 AS DOUBLE) AS y0, 1.0 AS w FROM customer)""",
)
def _(t):
    k = F.col("c_custkey") % 3
    x, y = ((F.col("c_custkey") * 53) % 170).cast("double"), ((F.col("c_custkey") * 71) % 80).cast("double")
    corner = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    none = F.array().cast("array<struct<x:double,y:double>>")
    items = t("customer").select(F.col("c_custkey").alias("tile_id"), F.when(k == 1, F.array(x, y, x + 1, y + 1)).otherwise(F.array(x, y, x, y)).alias("bbox"), F.when(k == 2, F.array(corner(x, y), corner(x + 1, y), corner(x + 1, y + 1))).otherwise(none).alias("corners"))
    return S.footprints(items, (20.0, 10.0, 60.0, 40.0)).select("tile_id", "status")


@query(
    "S21_survey_marks",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_suppkey % 3000 + 0.5 END AS height, CASE WHEN x NOT BETWEEN 100 AND 900 THEN 'outside' WHEN s_suppkey % 7 = 0 THEN 'geometry_differs' WHEN s_suppkey % 11 = 0 THEN 'height_unreadable' WHEN s_suppkey % 3000 + 0.5 > 2500 THEN 'height_range' WHEN s_suppkey % 13 = 0 THEN 'undulation' END AS reason,
    CASE WHEN s_suppkey % 3 = 0 THEN 'M' || s_suppkey ELSE 'local:' || left(sha256(s_suppkey || chr(31) || CASE WHEN s_suppkey % 11 = 0 THEN '12.5' ELSE (s_suppkey % 3000) || ',5' END), 16) END AS mark_key FROM (SELECT *, CAST((s_suppkey * 211) % 1009 AS DOUBLE) AS x FROM supplier)""",
)
def _(t):
    k = F.col("s_suppkey")
    x = ((k * 211) % 1009).cast("double")
    marks = t("supplier").select("s_suppkey", x.alias("x"), F.lit(5.0).alias("y"), (x + F.when(k % 7 == 0, 0.5).otherwise(0.0)).alias("attr_x"), F.lit(5.0).alias("attr_y"), F.when(k % 11 == 0, "12.5").otherwise(F.concat((k % 3000).cast("string"), F.lit(",5"))).alias("height_raw"), (k % 3000 + 0.5 + F.when(k % 13 == 0, 90).otherwise(55)).alias("h_ellipsoidal"))
    marks = marks.withColumn("official", F.when(k % 3 == 0, F.concat(F.lit("M"), k)).when(k % 3 == 1, " "))
    return S.survey_marks(marks, (100.0, 0.0, 900.0, 10.0), "official", ["s_suppkey", "height_raw"]).select("s_suppkey", "height", "reason", "mark_key")


@query("S22_sparql_rows", "SELECT n_regionkey AS response, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS row_no, 'name' AS binding, n_name AS value FROM nation")
def _(t):
    bodies = t("nation").groupBy(F.col("n_regionkey").alias("response")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", F.col("n_name").alias("v")))), lambda r: F.create_map(F.lit("name"), F.struct(F.lit("literal").alias("type"), r["v"].alias("value")))).alias("b"))
    return S.sparql_rows(bodies.select("response", F.to_json(F.struct(F.struct(F.col("b").alias("bindings")).alias("results"))).alias("body")), 1000)


@query("S22_check_statistics", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'no data container' WHEN 1 THEN CASE WHEN event_id % 2 = 0 THEN 'no delimiter' END END AS fault FROM events")
def _(t):
    k, e = F.col("event_id") % 3, F.col("event_id")
    body = F.when(k == 0, F.col("props")).when(k == 1, F.when(e % 2 == 0, "none").otherwise(F.concat_ws(",", "event_id", "event_type"))).otherwise(F.concat(F.lit("<a>"), e, F.lit("</a>")))
    kind = F.when(k == 0, "json").when(k == 1, "csv").otherwise("xml")
    return S.check_statistics(t("events").select("event_id", kind.alias("format"), body.alias("body"))).select("event_id", "fault")


@query("S23_check_xml", "SELECT o_custkey AS file, 'http://n/' || (o_custkey % 3) AS namespace, count(*) AS matched, CASE WHEN o_custkey % 3 <> 1 THEN 'another namespace' END AS fault FROM orders GROUP BY o_custkey")
def _(t):
    members = F.array_join(F.collect_list(F.concat(F.lit("<w:member>"), "o_orderkey", F.lit("</w:member>"))), "")
    body = F.concat(F.lit('<?xml version="1.0"?><w:FeatureCollection xmlns:w="http://n/'), F.col("file") % 3, F.lit('" numberMatched="'), "n", F.lit('">'), "m", F.lit("</w:FeatureCollection>"))
    files = t("orders").groupBy(F.col("o_custkey").alias("file")).agg(members.alias("m"), F.count(F.lit(1)).alias("n")).select("file", body.alias("body"))
    return S.check_xml(files, "featurecollection", "/1").select("file", "namespace", "matched", "fault")


@query("S23_xml_scan", "SELECT n_regionkey AS file, 'schema' AS root, count(*) AS members, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def _(t):
    el = F.concat(F.lit('<element name="'), "n_name", F.lit('"/>'))
    files = t("nation").groupBy(F.col("n_regionkey").alias("file")).agg(F.concat(F.lit('<?xml version="1.0"?><xs:schema xmlns:xs="x">'), F.array_join(F.collect_list(el), ""), F.lit("</xs:schema>")).alias("body"))
    return S.xml_scan(files, "element")


@query("S23_feature_types", "SELECT DISTINCT o_custkey AS file, 'w:' || o_orderpriority AS name FROM orders")
def _(t):
    """Capabilities of every customer: a feature type for each order, named by its priority, beside other names."""
    kind = F.concat(F.lit("<w:FeatureType><w:Name> w:"), "o_orderpriority", F.lit(" </w:Name><Title>"), "o_orderkey", F.lit("</Title></w:FeatureType>"))
    body = F.concat(F.lit('<w:Capabilities xmlns:w="u"><w:Name>service</w:Name>'), F.array_join(F.collect_list(kind), ""), F.lit("</w:Capabilities>"))
    return S.feature_types(t("orders").groupBy(F.col("o_custkey").alias("file")).agg(body.alias("body")))


@query(
    "S23_schema_fields",
    """WITH f AS (SELECT o_custkey AS file, CASE WHEN o_orderkey % 4 = 0 THEN 'cota_' ELSE 'f_' END || o_orderkey % 10 AS field, min(o_orderkey) AS first FROM orders GROUP BY 1, 2)
    SELECT file, row_number() OVER (PARTITION BY file ORDER BY first) - 1 AS position, field, field LIKE 'cota%' AS is_height FROM f""",
)
def _(t):
    """Schemas of every customer: an element for each order in turn, some of which repeat."""
    name = F.concat(F.when(F.col("o_orderkey") % 4 == 0, "cota_").otherwise("f_"), F.col("o_orderkey") % 10)
    element = F.struct("o_orderkey", F.concat(F.lit('<xs:element name="'), name, F.lit('"/>')).alias("e"))
    inside = F.array_join(F.transform(F.array_sort(F.collect_list(element)), lambda x: x["e"]), "")
    files = t("orders").groupBy(F.col("o_custkey").alias("file")).agg(F.concat(F.lit('<xs:schema xmlns:xs="u">'), inside, F.lit("</xs:schema>")).alias("body"))
    return S.schema_fields(files)


@query(
    "S24_tile_index",
    """WITH b AS (SELECT s_suppkey AS box, CAST(s_suppkey % 60 - 30 AS BIGINT) AS x, CAST(s_suppkey % 40 - 20 AS BIGINT) AS y FROM supplier), c AS (SELECT box, x + i AS lon, y + j AS lat FROM b, (VALUES (0), (1)) a(i), (VALUES (0), (1), (2)) d(j))
    SELECT box, CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(abs(lat) AS VARCHAR), 2, '0') || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END || lpad(CAST(abs(lon) AS VARCHAR), 3, '0') AS tile, CASE WHEN lat = 5 AND lon >= 0 THEN 'listed' ELSE 'not_listed' END AS status FROM c""",
)
def _(t):
    k = F.col("s_suppkey")
    x, y = (k % 60 - 30).cast("double"), (k % 40 - 20).cast("double")
    boxes = t("supplier").select(k.alias("box"), x.alias("xmin"), y.alias("ymin"), (x + 1.5).alias("xmax"), (y + 2.25).alias("ymax"))
    listed = t("customer").select(F.concat(F.lit("N05E"), F.lpad((F.col("c_custkey") % 60).cast("string"), 3, "0")).alias("tile"))
    return S.tile_index(boxes, listed)


@query(
    "S24_unverified_tiles",
    """WITH b AS (SELECT s_suppkey AS box, CAST(s_suppkey % 60 - 30 AS BIGINT) AS x, CAST(s_suppkey % 40 - 20 AS BIGINT) AS y FROM supplier), c AS (SELECT box, x AS lon, y AS lat FROM b)
    SELECT box, CASE WHEN lat >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(abs(lat) AS VARCHAR), 2, '0') || CASE WHEN lon >= 0 THEN 'E' ELSE 'W' END || lpad(CAST(abs(lon) AS VARCHAR), 3, '0') AS tile, CASE WHEN lat = 5 AND lon >= 0 THEN 'listed' WHEN lat >= 0 AND lon >= 0 THEN 'not_listed' ELSE 'unverified' END AS status FROM c""",
)
def _(t):
    k = F.col("s_suppkey")
    x, y = (k % 60 - 30).cast("double"), (k % 40 - 20).cast("double")
    boxes = t("supplier").select(k.alias("box"), x.alias("xmin"), y.alias("ymin"), (x + 1).alias("xmax"), (y + 1).alias("ymax"))
    name = lambda lat: F.concat(F.lit("N"), F.lpad(lat.cast("string"), 2, "0"), F.lit("E"), F.lpad((F.col("c_custkey") % 60).cast("string"), 3, "0"))
    listed = t("customer").select(name(F.lit(5)).alias("tile"))
    read = t("customer").withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(20)))).select(name(F.col("_n")).alias("tile"))
    return S.tile_index(boxes, listed, read)


@query("S25_road_ways", "SELECT o_custkey AS way, count(*) AS points FROM orders GROUP BY 1 HAVING count(*) BETWEEN 2 AND 5000 AND o_custkey % 3 <> 0")
def _(t):
    ways = t("orders").groupBy(F.col("o_custkey").alias("way")).agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("points"))
    marked = ways.withColumn("highway", F.when(F.col("way") % 3 == 0, "footway").when(F.col("way") % 3 == 1, "primary").otherwise("motorway"))
    return S.road_ways(marked, ["primary", "motorway"]).select("way", F.size("points").cast("long").alias("points"))


_AT = ["regexp_replace(CAST(({c} + 0.0001) / 1000 - 8.5 AS VARCHAR), '\\.0$', '')".replace("{c}", c) for c in ("xmin", "ymin", "xmax", "ymax")]


@query(
    "S26_bbox_polygons",
    "SELECT tile_id, 'POLYGON((' || concat_ws(',', {0} || ' ' || {1}, {2} || ' ' || {1}, {2} || ' ' || {3}, {0} || ' ' || {3}, {0} || ' ' || {1}) || '))' AS ring FROM rects".format(*_AT),
    rects=RECTS,
)
def _(t, rects):
    degrees = rects.withColumns({c: (F.col(c) + 0.0001) / 1000 - 8.5 for c in ("xmin", "ymin", "xmax", "ymax")})
    return S.bbox_polygons(degrees.unionByName(degrees))
