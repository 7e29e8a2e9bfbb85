"""Payload rules that a comparison over the given tables does not reach: odd forms of cubes, tables, addresses, labels, numbers and periods."""

from __future__ import annotations

import html
import unicodedata

import pytest
from pyspark.sql import functions as F

from calado.functions import text as X
from calado.sources import payloads, sinks

CUBE = "cube string, id array<string>, size array<int>, codes map<string,array<string>>, value string, status string"
CODES = {"a": ["x", "y"], "b": ["1", "2"]}


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t"))).first()[0]


def cells(spark, value, status, size=(2, 2), codes=CODES):
    rows = payloads.jsonstat_to_rows(spark.createDataFrame([("c", ["a", "b"], list(size), codes, value, status)], CUBE)).collect()
    return [(r["codes"], r["value"], r["text"], r["status"]) for r in sorted(rows, key=lambda r: r["linear_index"])]


def test_cube_status_and_text_values(spark):
    assert cells(spark, '[1,"..",null,2.5e1]', '{"1":"p","3":"e"}') == [("x|1", 1.0, None, None), ("x|2", None, "..", "p"), ("y|1", None, None, None), ("y|2", 25.0, None, "e")]
    assert cells(spark, '{"3":"5","0":-1}', '["a","b","c","d"]') == [("x|1", -1.0, None, "a"), ("y|2", 5.0, None, "d")]
    assert cells(spark, '{"3":1}', None) == cells(spark, '{"3":1}', "null") == cells(spark, '{"3":1}', "{}") == [("y|2", 1.0, None, None)]
    assert cells(spark, "{}", "[]") == []


@pytest.mark.parametrize(
    ("value", "status", "size", "codes", "why"),
    [
        ("[1,2,3]", None, (2, 2), CODES, "as long as"), ("[1,2,3,4]", '["a"]', (2, 2), CODES, "as long as"), ('{"4":1}', None, (2, 2), CODES, "beyond the cube"), ('{"-1":1}', None, (2, 2), CODES, "beyond the cube"),
        ('{"x":1}', None, (2, 2), CODES, "beyond the cube"), ("7", None, (2, 2), CODES, "a list or an object"), ("[1,2,3,4,5,6]", None, (2, 3), CODES, "number of codes"), ("[1,2,3,4]", '{"9":"p"}', (2, 2), CODES, "beyond the cube"), ("[1,2]", None, (2, 1), {"a": ["x", "y"]}, "number of codes"),
    ],
)
def test_cubes_of_wrong_sizes_are_errors(spark, value, status, size, codes, why):
    with pytest.raises(Exception, match=why):
        cells(spark, value, status, size, codes)


def table(spark, page, **kw):
    rows = payloads.html_tables(spark.createDataFrame([(1, page)], "page_id int, html string"), **kw).collect()
    return [(r["table_no"], r["row_no"], list(r["cells"])) for r in sorted(rows, key=lambda r: (r["table_no"], r["row_no"]))]


def test_first_filled_row_is_the_header(spark):
    page = "<table><tr><td> </td></tr><tr><td>Ano</td><td>Valor</td></tr><tr><td>2020<td>A&amp;B&nbsp;&#8364;</tr></table><table><tr><td></td></tr></table><table><tr><th>B</th></tr><tr><th>x &amp;lt;</th></tr></table>"
    assert table(spark, page, headers=["valor"]) == [(0, 1, ["2020", "A&B €"])]
    assert table(spark, page, index=1) == [(1, 1, ["x &lt;"])]
    assert table(spark, page) == [(0, 1, ["2020", "A&B €"]), (1, 1, ["x &lt;"])]
    assert table(spark, page, min_rows=2) == [] == table(spark, page, headers=["missing"])


def test_addresses_and_labels_are_decoded(spark):
    page = """<a title="x > y" href="a?x=1&amp;y=2">R&eacute;sum&eacute; &amp; <b>more</b></a> <a href='my file.pdf'>two</a> <a href=plain.csv>three</a> <a data-href="no.html">none</a> <a href=" b.html ">four</a>"""
    rows = payloads.links(spark.createDataFrame([(1, "https://h.example/d/i.html", page)], "page_id int, url string, html string")).collect()
    got = [(r["href"], r["label"]) for r in sorted(rows, key=lambda r: r["position"])]
    root = "https://h.example/d/"
    assert got == [(root + "a?x=1&y=2", "Résumé & more"), (root + "my file.pdf", "two"), (root + "plain.csv", "three"), (root + "b.html", "four")]


def test_references_like_the_standard_library(spark):
    for text in ("&amp;lt; &lt;b&gt;", "&#233;&#xE9;&eacute;&nosuch;&", "&#128512; &hearts;&#0;", "no reference", "&amp;amp; &lt;", "", None):
        want = None if text is None else html.unescape(text).replace("�", "&#0;")
        assert one(spark, X.unescape, text) == want, text


def test_fold_spells_letters_out(spark):
    for text in ("Straße", "STRASSE", "ﬁne ﬃ ﬀ", "Ĳssel №5", "ΣΊΣΥΦΟΣ", "½ ™ …", "naïve – x", "北京 Straße"):
        want = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
        assert one(spark, X.fold, text) == want, text
    assert one(spark, X.norm_label, " A–b — c_d - e ") == "a b c d e"


@pytest.mark.parametrize(
    ("text", "period", "scope"),
    [
        ("3º trimestre 2021", "2021Q3", "Q3"), ("1o Trimestre de 2020", "2020Q1", "Q1"), ("Port 3 2021", "2021", "ANNUAL"), ("Budget 4 of 2020", "2020", "ANNUAL"), ("Freight 2 2022.xls", "2022", "ANNUAL"), ("2021Q3", "2021Q3", "Q3"),
        ("T2 2019", "2019Q2", "Q2"), ("3T2021", "2021Q3", "Q3"), ("trimestre 2021", "2021", "UNRESOLVED"), ("file-2021-05.csv", "2021-05", "ANNUAL"), ("no year", None, "UNRESOLVED"), (None, None, "UNRESOLVED"), ("4.º trim 2018", "2018Q4", "Q4"),
    ],
)
def test_periods(spark, text, period, scope):
    row = spark.createDataFrame([(text,)], "t string").select(X.parse_period(F.col("t")), X.edition_scope(F.col("t"))).first()
    assert tuple(row) == (period, scope)


def test_shard_digests_tell_repeats_apart(spark, tmp_path):
    rows = [("p", "a"), ("p", "a"), ("q", "b"), ("q", "b"), ("r", "a"), ("s", "a"), ("s", "c"), ("s", "c")]
    got = {r["k"]: r["digest"] for r in sinks.write_shards(spark.createDataFrame([(k, v) for k, v in rows], "k string, v string").withColumn("k2", F.lit("x")), "k", str(tmp_path / "o")).collect()}
    assert 0 not in got.values() and len(set(got.values())) == 4


def test_boxes_keep_their_digits(spark):
    rows = [("t", -8.61234, 41.1489, -8.60111, 41.1599), ("u", 12345678.25, 0.00012, 3e8, 5.0)]
    got = {r["tile_id"]: r["ring"] for r in payloads.bbox_polygons(spark.createDataFrame(rows, "tile_id string, xmin double, ymin double, xmax double, ymax double")).collect()}
    assert got["t"] == "POLYGON((-8.61234 41.1489,-8.60111 41.1489,-8.60111 41.1599,-8.61234 41.1599,-8.61234 41.1489))"
    assert got["u"].startswith("POLYGON((12345678.25 0.00012,300000000 0.00012,300000000 5,")
