"""Personal data: fixed forms against plain regular expressions, and planted identifiers that only contexts give away."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from calado.llm import personal_data as P

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text):
            digits = re.sub(r"\D", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and plain_luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def spans(text):
    return ",".join(f"{P.KINDS[k]}:{s}:{e}" for k, s, e in P.base_spans(text))


def test_base_as_plain_expressions():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice("ab@@..-+ 0123456789 11()é\n%") for _ in range(rng.randrange(60)))
        assert spans(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["a" * 300000, "1" * 300000, "1." * 150000, "@" * 300000, "a@" * 150000, "+1 " * 100000, "+1" + " " * 300000, "1 " * 150000, ":" * 300000, "(at)" * 75000, "1.1.1.1 " * 30000])
def test_long_texts_take_time_in_proportion(text):
    base = P.base_spans(text)
    assert len(list(P.loose_spans(text, base))) < len(text)


def test_query_on_the_given_tables(spark):
    from calado.llm.queries import queries

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries()["op12_personal_data"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        want = plain_base(docs[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in FORMS] == [sum(x.startswith(k) for x in want.split(",")) for k in FORMS]
        assert set(want.split(",")) - {""} <= set(r["spans"].split(","))


PROSE = "the river runs past old mills and the valley opens to the east of town where people call on friends at noon".split()


def planted():
    """Documents with seeds in shared contexts, with other forms in these contexts, and with numbers in common ones."""
    rng, docs, hidden, clean = random.Random(7), [], {}, set()
    said = lambda n: " ".join(rng.choice(PROSE) for _ in range(n))

    def add(text, *found):
        docs.append((len(docs), text))
        if found:
            hidden[len(docs) - 1] = {f"{k}:{text.index(v)}:{text.index(v) + len(v)}" for k, v in found}

    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    for _ in range(15):
        add(f"{said(20)} Please ring me on +1 ({digits(3)}) 555-{digits(4)} {said(20)}")
        add(f"{said(20)} E-mail: ann.{digits(2)}@mail{digits(1)}.example.com {said(20)}")
        add(f"{said(20)} logged in from 10.{rng.randrange(256)}.3.{rng.randrange(256)} {said(20)}")
    for _ in range(8):
        phone, mail, address = f"0{digits(2)} {digits(3)} {digits(4)}", f"bob{digits(3)} (at) mail.example (dot) org", f"fe80:{digits(3)}:0:1::{digits(2)}"
        add(f"{said(20)} Please ring me on {phone} {said(20)}", ("phone", phone))
        add(f"{said(20)} E-mail: {mail} {said(20)}", ("email", mail))
        add(f"{said(20)} logged in from {address} {said(20)}", ("ip", address))
    for _ in range(40):
        clean.add(len(docs))
        add(f"{said(20)} the {digits(8)} {said(9)} of {digits(14)} at 12:30:45 and look at example . com {said(9)}")
    return docs, hidden, clean


def test_contexts_find_other_forms(spark):
    docs, hidden, clean = planted()
    rows = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    for i, want in hidden.items():
        assert want <= set(rows[i]["spans"].split(",")), (docs[i], rows[i]["spans"])
        assert rows[i]["n_added"] == 1
    for i, text in docs:
        if i not in hidden:
            assert rows[i]["n_added"] == 0, text
        assert rows[i]["base_sha256"] == hashlib.sha256(plain_base(text).encode()).hexdigest()


def test_copies_are_no_support(spark):
    """One seed that is copied a thousand times trusts no pattern: three different ones are asked for."""
    docs = [(i, "ring me on +1 (017) 555-7713 soon after") for i in range(300)] + [(1000, "ring me on 017 555 7714 soon after")]
    rows = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[1000]["n_added"] == 0 and rows[5]["n_phone"] == 1


def test_known_number_in_another_form(spark):
    docs = [(1, "ring +1 (017) 555-7713"), (2, "or (1) 017 555 7713 then")]
    rows = {r["doc_id"]: r for r in P.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert rows[2]["spans"] == "phone:3:19" and rows[2]["n_phone"] == 0


def test_edges(spark):
    docs = [(None, None, 1), (1, None, 1), (2, "", 1), (3, "x", 1), (3, "x", 1), (4, "é" * 200000 + " a@b.cc", 1)]
    rows = P.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string, kind int")).collect()
    assert len(rows) == 6 and {r["spans"] for r in rows} == {"", "email:200001:200007"}
    assert all(r["base_sha256"] == hashlib.sha256(r["spans"].encode()).hexdigest() for r in rows)
    assert P.find_personal_data(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_grams_in_several_passes(spark):
    docs, hidden, _ = planted()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    one, many = (sorted((r["doc_id"], r["spans"]) for r in P.find_personal_data(df, grams_at_once=n).collect()) for n in (1 << 16, 3))
    assert one == many
