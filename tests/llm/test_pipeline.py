"""The pipeline's stages, and the whole of it, against plain loops; and the registered queries of the operators."""

import os
from collections import Counter

import duckdb
import pytest

pytest.importorskip("corpus_pipeline")

import corpus_pipeline
from calado.llm import language_id, packing, queries

from test_near_dedup import brute

SF = "/root/testdata/sf0.001"


def slow_lines(rows, least=40, shared=5):
    """(doc_id, text) without lines that ``shared`` documents or more hold, but in the largest doc_id."""
    blanks = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(blanks).translate(lower)
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least:
                holders.setdefault(key(x), set()).add(i)
    gone = {k: max(x for x in v if x is not None) for k, v in holders.items() if len([x for x in v if x is not None]) >= shared}
    return [(i, "\n".join(x for x in (t or "").split("\n") if key(x) not in gone or gone[key(x)] == i)) for i, t in rows]


def slow_language(learned, text):
    """The language of the smallest frame by one-shot compression of the same chunks, and its margin."""
    import zstandard

    plain = language_id._plain(text)
    if not plain:
        return "und", 0.0
    search = {"strategy": zstandard.STRATEGY_BTLAZY2, "search_log": 4, "min_match": 3} if len(plain) <= 1024 else {"strategy": zstandard.STRATEGY_LAZY, "search_log": 3, "min_match": 4}
    sizes = []
    for rank, (lang, content) in enumerate(learned):
        how = zstandard.ZstdCompressionParameters(window_log=18, hash_log=16, chain_log=17, write_content_size=False, write_dict_id=False, **search)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(compression_params=how)
        size = lambda x: len(zstandard.ZstdCompressor(dict_data=words, compression_params=how).compress(x))  # noqa: B023, E731
        sizes.append((sum(size(plain[i : i + 8192].encode()) - size(b"") for i in range(0, len(plain), 8192)), rank, lang))
    sizes.sort()
    return sizes[0][2], (sizes[1][0] - sizes[0][0]) / max(sizes[0][0], 1)


def check_stages(spark, docs, sf_dir, tmp):
    """Each stage on all that the one before kept, compared with plain loops; returns the last one's rows."""
    columns = docs.columns
    rows = [r.asDict() for r in docs.collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "line_dedup", "near_dedup", "mixing", "packing"]

    def after(name):
        nonlocal docs
        path = f"{tmp}/{name}"
        steps[name](spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        return [r.asDict() for r in docs.collect()]

    out = language_id.held_out(docs["doc_id"])
    learned = language_id.language_dictionaries(docs.where(~out & docs["lang"].isNotNull()))
    found = [(r, *slow_language(learned, r["text"])) for r in rows]
    want = [{**r, "lang": lang} for r, lang, margin in found if lang != "und" and margin >= 0.01]
    rows = after("language_id")
    assert docs.columns == columns and sorted(map(str, rows)) == sorted(map(str, want))

    left = slow_lines([(r["doc_id"], r["text"]) for r in rows])
    want = [{**r, "text": t, "n_chars": len(t)} for r, (_, t) in zip(rows, left, strict=True) if t.strip(" \t\n\x0b\x0c\r")]
    rows = after("line_dedup")
    assert docs.columns == columns and sorted(map(str, rows)) == sorted(map(str, want))

    known = [r for r in rows if r["doc_id"] is not None]
    classes = dict(brute([(r["doc_id"], r["text"]) for r in known]))
    before, rows = rows, after("near_dedup")
    assert docs.columns == columns and all(r in before for r in rows)
    if len(known) == len(before) == len({r["doc_id"] for r in known}):
        assert sorted(r["doc_id"] for r in rows) == sorted(set(classes.values()))

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp}/near_dedup/*.parquet'")
    taken = Counter()
    for d, *_, n in con.execute(queries.oracle_sql()["op9_source_mixing"]).fetchall():
        taken[d] += n
    texts = {r["doc_id"]: r["text"] for r in rows}
    rows = after("mixing")
    words = Counter()
    for r in rows:
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"]) and r["text"] in texts[r["doc_id"]]
    assert docs.columns == columns and words == +taken

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter((r["doc_id"], len(library.encode(r["text"], add_special_tokens=False).ids) + 1) for r in rows)
    packed = after("packing")
    whole = Counter()
    fill = Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
        if r["start"] + r["length"] <= 2048 and r["piece"] == 0 and r["length"] < 2048:
            whole[r["doc_id"], r["length"]] += 1
    assert whole == Counter({k: n for k, n in lengths.items() if k[1] < 2048}) and max(fill.values()) <= 2048
    counts = Counter(r["length"] for r in packed)
    assert len(fill) == len({q + k for length, a, b, m, q, _ in packing.two_fit_plan(dict(counts), 2048) for k in range((b - a) // m)})
    return packed


def test_stages_and_run(spark, tmp_path):
    packed = check_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF, f"file://{tmp_path}")
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, (r.asDict() for r in got.collect()))) == sorted(map(str, packed))


def test_odd_rows(spark, tmp_path):
    """Null ids, texts and languages, repeated rows, columns with clashing names: the pipeline runs, and rows that no stage rejects stay."""
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    line = "This is a line of its own that no other document of the table has at all."
    odd = [{**rows[0], "doc_id": None, "text": line + " The null id and the words and the line are here."}, {**rows[1], "text": None}, {**rows[2], "lang": None}, rows[3], rows[3], {**rows[4], "doc_id": rows[5]["doc_id"]}]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    table = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows + odd], schema).selectExpr("*", "1 AS size", "2 AS lang_pred", "'x' AS target", "3 AS sequence_id")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()
    assert any(r["doc_id"] is None for r in got) and len(got) > 50
    table.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_registered_sql(spark, name):
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{table}'")
    found = con.execute(queries.oracle_sql()[name])
    columns = sorted(c[0] for c in found.description)
    want = sorted(str([round(v, 6) if isinstance(v, float) else v for _, v in sorted(zip([c[0] for c in found.description], r, strict=True))]) for r in found.fetchall())
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(str([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in columns]) for r in got.collect()) == want


@pytest.mark.parametrize("name", sorted(n for n in queries.queries() if n.startswith("op") and not n.startswith("op13_")))
def test_registered_queries_cover_their_tables(spark, name):
    """One row for each row of the table (op7: one piece or more for each document). op13's rows are no table's: its SQL above compares them."""
    got = queries.queries()[name](spark, SF)
    table, key = ("pages", "page_id") if name.startswith("op2_") else ("documents", "doc_id")
    ids = sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").collect())
    rows = got.collect()
    if name.startswith("op7_"):
        rows = [r for r in rows if r["piece"] == 0]
    assert sorted(r[key] for r in rows) == ids
