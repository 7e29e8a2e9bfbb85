import random

from pyspark.sql import functions as F

from calado.llm.mixing import mix_sources, sainte_lague, source_targets, take_spans


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(limit * sizes[s] for s in capped)) / (sum(w[s] for s in free) or 1)
        over = [s for s in free if level * w[s] > limit * sizes[s] + 1e-9]
        if not over:
            return {s: limit * sizes[s] if s in capped else level * w[s] for s in names}
        capped.update(over)


def test_targets(spark):
    rnd = random.Random(4)
    for n in (1, 2, 7, 30):
        sizes = {f"s{i}": rnd.choice([0, 1, 5, 1000, 50000]) for i in range(n)} | {None: 77, "Z": 10, "é": 30}
        got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
        want = targets(sizes)
        for r in got.collect():
            assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]), (sizes, r)


def test_sainte_lague(spark):
    rnd = random.Random(5)
    rows = [(g, p, float(rnd.choice([0, 1, 3, 10, 500, 500, 7000]))) for g in range(12) for p in range(rnd.randint(1, 9))]
    seats = {g: rnd.choice([0, 1, 2, 5, 40, 333]) for g in range(12)}
    got = sainte_lague(spark.createDataFrame([(g, p, w, seats[g]) for g, p, w in rows], "g int, p int, w double, n long"), ["g"], ["p"], "w", "n")
    want = {}
    for g in range(12):
        quotients = sorted(((-w / (2 * k - 1), p) for gg, p, w in rows if gg == g and w for k in range(1, seats[g] + 1)))[: seats[g]]
        for gg, p, _ in rows:
            if gg == g:
                want[g, p] = sum(1 for _, q in quotients if q == p)
    assert {(r["g"], r["p"]): r["quota"] for r in got.collect()} == want


def docs(spark, n=400):
    rnd = random.Random(6)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), " ".join(f"w{j}" for j in range(rnd.choice([0, 1, 3, 50, 200, 2000])))) for i in range(n)]
    return spark.createDataFrame(rows + [(n, "d", None), (n + 1, "a", "x\ty\n z "), (None, "b", "q q"), (3, "b", "same id")], "doc_id long, source string, text string")


def test_mix(spark):
    table = docs(spark)
    got = mix_sources(table, shard_words=5000)
    rows = got.collect()
    assert len(rows) == table.count()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(s["end"] - s["start"] for s in r["spans"])
        by.setdefault(r["source"], [r["target"], r["source_size"], 0])[2] += r["taken"]
    for target, size, taken in by.values():
        assert abs(taken - target) <= 40 + 0.01 * target and target <= 2 * size + 1e-6
    assert sum(t for t, _, _ in by.values()) <= 1.5 * sum(s for _, s, _ in by.values()) + 1e-6
    again = mix_sources(table.repartition(7), shard_words=5000).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_spans_as_documents(spark):
    mixed = mix_sources(docs(spark), with_text=True)
    taken = mixed.agg(F.sum("taken")).first()[0]
    words = take_spans(mixed).select(F.size(F.filter(F.split("text", r"[ \t-\r]+"), lambda x: x != "")).alias("n")).agg(F.sum("n")).first()[0]
    assert words == taken


def test_empty_and_clashes(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string, size int")
    assert mix_sources(empty).collect() == []
    one = spark.createDataFrame([(1, "a", "b c", 9, "x")], "doc_id long, source string, text string, size int, taken string")
    assert mix_sources(one).select("doc_id", "size", "source_size", "taken").first()["size"] == 2


def test_null_texts_only(spark):
    rows = mix_sources(spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 2
