import random

import numpy as np
import pytest

from calado.llm.near_dedup import connected, keep_first, links_of_block, may_link, near_duplicates, prob_min_hash, probability_jaccard, shingles


def exact(a, b):
    """Probability Jaccard by its definition."""
    wa, wb = dict(zip(*map(list, a), strict=True)), dict(zip(*map(list, b), strict=True))
    if not wa and not wb:
        return 1.0
    union = set(wa) | set(wb)
    return sum(1 / sum(max(wa.get(j, 0) / wa[i], wb.get(j, 0) / wb[i]) for j in union) for i in set(wa) & set(wb))


def texts(seed=1, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    out = []
    for i in range(n):
        base = [rnd.choice(words) for _ in range(rnd.choice([1, 4, 5, 6, 30, 120, 400]))]
        if i % 4 == 0:
            base += base[: len(base) // 2] * rnd.randint(0, 3)
        out.append(base)
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, max(1, len(base) // 60)])):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(copy)
    return [" ".join(x) for x in out]


def test_probability_jaccard_is_exact():
    sets = [shingles(t) for t in texts(2, 40)]
    rnd = random.Random(1)
    for _ in range(300):
        a, b = rnd.choice(sets), rnd.choice(sets)
        assert probability_jaccard(a, b) == pytest.approx(exact(a, b), abs=1e-9)


def test_registers_estimate_it():
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(500)]
    a = [rnd.choice(words) for _ in range(300)] * 2
    b = a[:500] + [rnd.choice(words) for _ in range(150)]
    x, y = shingles(" ".join(a)), shingles(" ".join(b))
    m = 4000
    same = (prob_min_hash(*x, m) == prob_min_hash(*y, m)).mean()
    assert abs(same - exact(x, y)) < 0.04
    one = shingles("only")
    assert (prob_min_hash(*one, 125) == one[0][0]).all()


def brute(rows, similarity=0.8):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "").split() == (rows[j][1] or "").split() or (len(sets[i][0]) and len(sets[j][0]) and probability_jaccard(sets[i], sets[j]) >= similarity):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted([(d, least.get(root(i))) for i, (d, _) in enumerate(rows)], key=str)


def test_classes_as_brute_force(spark):
    rows = [(int(i), t) for i, t in enumerate(texts())]
    rnd = random.Random(3)
    rnd.shuffle(rows)
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, rows[3][1]), (None, "nothing like it at all here"), rows[7]]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=8)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_hot_group_of_near_copies(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(2000)]
    base = [rnd.choice(words) for _ in range(200)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rnd.randint(0, 4)):
            copy[rnd.randrange(200)] = rnd.choice(words)
        rows.append((i, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=32)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_connected(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 480)] + [(500, i) for i in range(501, 560)]
    got = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    for x in list(parent):
        assert got.get(x, x) == root(x)


def test_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)
    assert np.unique([r[0] for r in rows]).size == len(rows)


@pytest.mark.parametrize("columns", [3, 64, 4096])
def test_links_of_block(columns):
    sets = [shingles(t) for t in texts(5, 40)]
    n = len(sets)
    root = np.arange(n)
    left, right = np.arange(n) % 3 == 0, np.arange(n) % 3 > 0
    i, j = links_of_block(sets, root, left, right, 0.8, columns)
    want = {(x, y) for x in range(n) for y in range(n) if left[x] and right[y] and exact(sets[x], sets[y]) >= 0.8}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want


def test_may_link():
    rnd = np.random.default_rng(4)
    kept = rnd.integers(0, 3, (40, 25)).astype("<u2")
    root, left, right = rnd.integers(0, 30, 40), np.arange(40) % 2 == 0, np.arange(40) % 3 > 0
    want = set()
    for i in np.flatnonzero(left):
        for j in np.flatnonzero(right):
            if root[i] != root[j] and (kept[i] == kept[j]).mean() >= 0.48:
                want |= {i, j}
    assert 0 < len(want) < 40
    assert set(np.flatnonzero(may_link([r.tobytes() for r in kept], root, left, right, 0.48))) == want


def test_different_texts_of_one_band(spark):
    # One window that holds the weight of most registers puts texts in one band that are not near; near copies among them are found.
    rnd = random.Random(12)
    rows = []
    for i in range(120):
        own = [f"x{rnd.randrange(10**6)}" for _ in range(60)]
        rows.append((i, " ".join(["again"] * 300 + own)))
        if i % 10 == 0:
            rows.append((1000 + i, " ".join(["again"] * 300 + own[:-1] + ["other"])))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=8)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_repeated_ids_null_ids_and_clashing_columns(spark):
    """Rows are told apart by id and text: repeated ids with other texts keep their own classes, in every run."""
    base = [f"a{i}" for i in range(60)]
    near, other, long = base[:30] + ["x"] + base[31:], [f"b{i}" for i in range(60)], " ".join(f"c{i}" for i in range(60_000))
    rows = [(7, " ".join(base)), (7, " ".join(other)), (9, " ".join(near)), (4, " ".join(other)), (None, " ".join(other)), (None, "all alone here with no copy"), (None, None), (12, long), (13, long + " end"), (12, long)]
    docs = spark.createDataFrame([(*r, i, "k") for i, r in enumerate(rows)], "doc_id long, text string, class_id long, _key string")
    for _ in range(2):
        got = sorted([tuple(r) for r in near_duplicates(docs.repartition(3)).collect()], key=str)
        want = [(7, 7), (7, 4), (9, 7), (4, 4), (None, 4), (None, None), (None, None), (12, 12), (13, 12), (12, 12)]
        assert got == sorted(want, key=str)
        kept = keep_first(docs.repartition(2))
        assert kept.columns == docs.columns and sorted(r["class_id"] for r in kept.collect()) == [0, 3, 5, 6, 7]


def test_recall_on_a_table(spark):
    """All pairs of the 0.01 table that exact sets call similar are in one class."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    found = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [shingles(t) for _, t in rows]
    met, pairs = {}, set()
    for i, (codes, _) in enumerate(sets):
        for c in codes.tolist():
            pairs.update((j, i) for j in met.setdefault(c, []))
            met[c].append(i)
    close = [(i, j) for i, j in pairs if probability_jaccard(sets[i], sets[j]) >= 0.8]
    assert len(close) > 20 and all(found[rows[i][0]] == found[rows[j][0]] for i, j in close)
