import hashlib

from pyspark.sql import functions as F

from calado.llm.line_dedup import drop_shared_lines

BLANKS = " \t\n\x0b\x0c\r"
LONG = "A long line that is shared by many documents, indeed"


def brute(rows, min_chars=40, min_docs=5):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(BLANKS).translate(lower)
    held = {}
    for i, text in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                held.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in held.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone or gone[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = drop_shared_lines(docs, **options).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256))
    return sorted([tuple(r) for r in out.collect()], key=str)


def test_edges(spark):
    rows = [(i, f"{LONG}\nown {i}\n\n{LONG.upper()}") for i in range(6)]
    rows += [(10, None), (11, ""), (12, "\n\n"), (13, f"  {LONG}\t"), (None, f"{LONG}\nx"), (14, "é" * 39), (15, "é" * 40)]
    rows += [(2, rows[2][1])] + [(20 + i, "é" * 40 + "\r\nend") for i in range(5)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb", 7, "x")], "doc_id long, text string, n_lines int, source string")
    out = drop_shared_lines(docs)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "n_dropped"]
    assert tuple(out.first()) == (1, "a\nb", "x", 2, 0)


def test_many_lines(spark):
    rows = [(i, "\n".join(f"{LONG} number {j % 97}" if j % 3 else f"{i} {j}" for j in range(3000))) for i in range(7)]
    assert run(spark, rows) == brute(rows)


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows) == brute(rows)
