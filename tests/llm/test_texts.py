"""Language ID, HTML text, fingerprints, LM scores, quality rules."""

import hashlib
import random
import re
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from calado.llm import fingerprints, html_text, language_id, lm_scoring, quality_rules

DOCS = "doc_id long, text string"


# -- language ID

def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.held_out(F.col("doc_id"))
    learned = language_id.language_dictionaries(docs.where(~out))
    found = language_id.label_language(docs.where(out), learned)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97 and found.where("accepted").count() > 0.95 * found.count()


def test_held_out_is_the_crc(spark):
    import zlib

    rows = spark.range(200).select("id", language_id.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_language_edges(spark):
    learned = [("en", b"the cat and the dog of the house with many words in it " * 40), ("de", "der hund und die katze für das haus über viele wörter ".encode() * 40)]
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 ... !!", "x"), (4, "the dog and the cat of the house", "x"), (4, "the dog and the cat of the house", "x"), (None, "DER HUND!! UND### DIE KATZE", "x"), (6, "ok", "x"), (7, "der hund und die katze für das haus " * 20000, "x")]
    docs = spark.createDataFrame(rows, DOCS + ", lang_pred string")
    got = language_id.label_language(docs, learned).collect()
    assert [r["lang_pred"] for r in got][:6] == ["und", "und", "und", "en", "en", "de"] and got[7]["lang_pred"] == "de"
    assert got[0].asDict() == {"doc_id": 1, "text": None, "lang_pred": "und", "score": 0.0, "margin": 0.0, "accepted": False}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in language_id.identify_language(docs, []).collect()] == ["und"] * 8
    assert language_id.identify_language(docs.limit(0), learned).collect() == []
    assert language_id.language_dictionaries(spark.createDataFrame([(1, None, "en"), (2, "text", None)], DOCS + ", lang string")) == []


def test_language_ties_go_to_the_first(spark):
    """Two languages with one dictionary: the first, which has more labelled rows, is named, without margin, and not accepted."""
    same = b"the cat and the dog of the house with many words in it " * 40
    docs = spark.createDataFrame([(1, "the dog and the cat of the house")], DOCS)
    for names in (("b", "a"), ("a", "b")):
        r = language_id.label_language(docs, [(n, same) for n in names]).first()
        assert (r["lang_pred"], r["margin"], r["accepted"]) == (names[0], 0.0, False) and r["score"] == pytest.approx(0.5)


# -- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div id="cookie-notice">We use cookies and more cookies, please accept them all.</div>
<div class="layout"><div class="sidebar"><p>Popular things that many people read every day here</p></div>
%s
<div class="comments"><p>First! I think this article is long and I like to comment on it at length.</p></div></div>
<form><label>Mail</label><input name=x></form><footer>&copy; 2024 <a href="/c">Contact</a></footer></body></html>"""
BODY = "<h2>A&nbsp;title &amp; more</h2><p>The first paragraph has <b>bold</b> and <a href=x>linked</a> words,\n with   breaks.<br>New line.<p>The second one is not closed and has an entity &eacute;&#233;&#x41;.</p><ul><li>one item of a list<li>another item of it</ul>"
WANT = "A title & more The first paragraph has bold and linked words, with breaks. New line. The second one is not closed and has an entity ééA. one item of a list another item of it"


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main>%s</main>", '<div class="content">%s</div>', '<div class="x"><div>%s</div></div>'])
def test_main_text(around):
    assert html_text.main_text(PAGE % (around % BODY)) == WANT


def _given(page):
    """The text of the article element that the tables' pages have."""
    import html


    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "")).split())


def test_html_given_pages(spark):
    """All paragraphs of the tables' articles, no menu, advert or footer; the article element itself says nothing."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract_text(pages).collect()}
    for p in pages.collect():
        want = _given(p["html"])
        assert got[p["page_id"]]["text"] == want and got[p["page_id"]]["n_chars"] == len(want)
        assert html_text.main_text(p["html"].replace("article>", "div>")) == want


def test_html_densities_decide(spark, monkeypatch):
    """Without any element or name that marks menu, advert, article or footer, densities find most articles; other numbers do not."""


    bare = [(re.sub(r"<(/?)(?:nav|footer|article)>", r"<\1div>", p["html"]).replace('<div class="ad">', "<div>"), _given(p["html"])) for p in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    right = lambda: sum(html_text.main_text(h) == w for h, w in bare) / len(bare)
    assert right() > 0.88
    monkeypatch.setattr(html_text, "composite_density", lambda chars, *_: float(chars > 0))
    assert right() < 0.1


def _slow_counts(node):
    """(characters, tags below, link characters, link tags below) by recursion."""
    if node.dropped:
        return 0, 0, 0, 0
    below = [(c, _slow_counts(c)) for c in node.children if not c.dropped]
    chars = len("".join("".join(x for x in node.parts if isinstance(x, str)).split())) + sum(n[0] for _, n in below)
    tags, links, link_tags = (sum(n[k] for _, n in below) for k in (1, 2, 3))
    return chars, tags + len(below), chars if node.tag == "a" else links, link_tags + sum(c.tag == "a" for c, _ in below)


def test_html_densities_by_hand():
    import math

    rnd = random.Random(5)
    for _ in range(60):
        page = "<body>" + "".join(rnd.choice(["<div>", "<p>", "<a href=x>", "<b>", "</div>", "</a>", "</b>", "some words ", "x", "<nav>n</nav>", "<ul><li>i"]) for _ in range(60))
        root = html_text._parse(page)
        nodes = html_text._order(root)
        body = next(n for n in nodes if n.tag == "body")
        html_text._drop(nodes, True)
        html_text._weigh(nodes, body)
        b = _slow_counts(body)
        for n in nodes:
            c, t, lc, lt = _slow_counts(n)
            assert (n.chars, n.tags, n.link_chars, n.link_tags) == (c, t, lc, lt) or n.dropped
            if not c:
                assert n.density == 0
                continue
            lc1, lt1, t1 = max(lc, 1), max(lt, 1), max(t, 1)
            base = math.log(c / max(c - lc1, 1) * lc1 + b[2] / max(b[0], 1) * c + math.e)
            assert n.density == pytest.approx(c / t1 * math.log(c / lc1 * t1 / lt1 + 1) / math.log(base + 1))
        live = [n for n in nodes if not n.dropped and n.chars and n.tag not in html_text.INLINE]
        if live:
            assert max(live, key=lambda n: n.total) in html_text._choose(nodes, body)[0]


TWO = "<p>" + "The first paragraph has many words in it, really. " * 4 + "</p><p>" + "The second one goes on and on in the same way. " * 4 + "</p>"
SAID = " ".join(("The first paragraph has many words in it, really. " * 4 + "The second one goes on and on in the same way. " * 4).split())


@pytest.mark.parametrize(
    "around",
    [
        '<div class="post comments-open">%s</div>', '<div class="has-sidebar">%s</div>', '<div class="content share-enabled">%s</div>', '<article class="post comments-open">%s</article>',
        '<article class="post header-image search-result">%s</article>', "<form>%s</form>", '<div><svg class="i" />%s</div>', "<div><button>Menu%s</div>", "<div><select><option>a%s</div>", "<div><script>var a%s</div>",
        '<div class="sidebar">%s</div>', "<div><nav><ul><li><a href=x>Home</a></ul>%s</div>", '<div id="main-nav"><a href=x>Home</a></div><div>%s</div><ul class="comment-list"><li>I like this page a lot, it says so many things, thanks to all.</li></ul>',
    ],
)
def test_html_names_and_tags_keep_articles(around):
    """Class names of states, a form around the page, and elements that never end do not empty a page."""
    assert html_text.main_text('<html><body><header>Top</header><nav><a href="/">Home</a></nav>' + around % TWO + "<footer>End</footer></body></html>") == SAID


def test_html_split_article():
    """Sections, and an article in two wrappers, stay whole; math stays, an image inside a word is no space."""
    part = lambda i: "".join(f"<p>Part {i} paragraph {k} has some words of its own that nobody else has, and more.</p>" for k in range(3))
    menu = "<ul>" + "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(9)) + "</ul>"
    for page in (f"<section>{part(1)}</section><section>{part(2)}</section><section>{part(3)}</section>", f"<div>{part(1)}</div><div>{menu}</div><div>{part(2)}{part(3)}</div>"):
        text = html_text.main_text(f"<body><div>{menu}</div><div>{page}</div></body>")
        assert text.count("Part") == 9 and "Link" not in text
    assert html_text.main_text("<p>un<img src=x>broken <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p>") == "unbroken x=2"


@pytest.mark.parametrize("many", ["<div>{}</div>", "<b>{}</b>", "<th><table>{}", "<td>{}", "<svg>{}", "<button>{}", "<nav>{}</nav>"])
def test_html_nesting_is_linear(many):
    import time

    opening, closing = many.split("{}")
    took = []
    for n in (5_000, 40_000):
        page = opening * n + "<div></div>" * n + "</x></p>" * n + "some words" + closing * n
        began = time.process_time()
        html_text.main_text(page)
        took.append(time.process_time() - began)
    assert took[1] < 24 * took[0] + 0.5


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>"), (4, "u", "plain words only"), (None, "u", "<p>a<p>b"), (6, "u", "<nav>x</nav><footer>y</footer>"), (7, "u", "<div>" * 5000 + "deep words here" + "</div>" * 5000), (8, "u", "<p>unclosed <b attr='"), (8, "u", "<p>unclosed <b attr='")]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"] for r in got] == ["", "", "", "plain words only", "a b", "", "deep words here", "unclosed", "unclosed"]
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, url string, html string, text int")).collect() == []
    text = "<article><p>" + "word " * 200_000 + "</p></article>"
    assert len(html_text.main_text(text)) == 5 * 200_000 - 1


# -- fingerprints

def brute_edit(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = {}
    for (i, a), (_, b) in zip(rows, rows[1:] + rows[:1], strict=True):
        a, b = a or "", b or ""
        half = len(a) // 2
        out.setdefault(i, []).append((len(a), hashlib.sha256((a[: len(a) - half] + b[:half]).encode()).hexdigest()))
    return out


def test_edits_and_likeness(spark):
    rnd = random.Random(1)
    words = [f"w{i}é" for i in range(800)]
    rows = [(i * 3 - 50, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 9, 80, 400])))) for i in range(2500)]
    rows += [(None, "first of all"), (9001, None), (9002, "😀" * 7), (9003, "a b c d " * 300), (9004, "a b c d " * 300)]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(rows, DOCS)).collect()
    want = brute_edit(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_chars"], r["edited_sha256"]) in want[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 256
    by = {r["doc_id"]: r for r in got}
    assert by[9003]["near_next"] == 1.0 and by[9003]["fingerprint"] == by[9004]["fingerprint"]
    long = [r for r in got if r["n_chars"] > 400]
    assert np.mean([r["near_edited"] > r["near_next"] for r in long]) > 0.97


def brute_print(text, k=3, picked=2, slots=64):
    """The fingerprint by plain loops, with xxh64 of the same bytes."""

    import struct

    import xxhash

    signed = lambda h: struct.unpack("<q", struct.pack("<Q", h))[0]
    on = lambda seed, *longs: [seed := xxhash.xxh64_intdigest(struct.pack("<q", x), seed) for x in longs][-1] if longs else seed
    small = lambda seed, x: xxhash.xxh64_intdigest(struct.pack("<i", x), seed)
    words = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return "-" * (4 * slots)
    seen, picks = {}, []
    for i in range(max(len(words) - k + 1, 1)):
        gram = words[i : i + k] + [0] * (k - len(words[i : i + k]))
        code = signed(on(42, *gram))
        seen[code] = seen.get(code, -1) + 1
        picks.append((small(on(42, code), seen[code]) >> 24, i + 1))
    out = []
    for j in range(slots):
        start = ((j + slots // 2) % slots) * (1 << 40) // slots
        near = sorted(picks, key=lambda x: (x[0] - start) % (1 << 40))[:picked]
        code = 42
        for v, _ in sorted(near, key=lambda x: x[1]):
            code = on(code, v - (1 << 40) if v >= 1 << 39 else v)
        out.append(f"{code & 0xFFFF:04X}")
    return "".join(out)


def brute_likeness(a, b):
    return 1.0 if a == b else sum(a[i : i + 4] == b[i : i + 4] != "----" for i in range(0, len(a), 4)) / (len(a) // 4)


def test_fingerprints_as_by_hand(spark):
    """Every position of both fingerprints, and both likenesses, equal brute force."""
    rnd = random.Random(3)
    words = [f"w{i}é" for i in range(60)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 9, 40, 150])))) for i in range(60)]
    rows += [(100, "a b c " * 90), (101, None), (102, "x"), (103, "one two\nthree\x0bfour  five")]
    docs = rows + [(None, "the id is null, the text is not")]
    got = fingerprints.edited_fingerprints(spark.createDataFrame(docs, DOCS)).collect()
    order = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0))
    by = {r["doc_id"]: r for r in got}
    for (i, a), (_, b) in zip(order, order[1:] + order[:1], strict=True):
        a, b = a or "", b or ""
        half = len(a) // 2
        plain, edited = brute_print(a), brute_print(a[: len(a) - half] + b[:half])
        assert by[i]["fingerprint"] == plain and by[i]["edited_fingerprint"] == edited
        assert by[i]["near_edited"] == pytest.approx(brute_likeness(plain, edited)) and by[i]["near_next"] == pytest.approx(brute_likeness(plain, brute_print(b)))


def test_halves_swapped(spark):
    """Order counts in short texts as in long ones."""
    rnd = random.Random(4)
    rows = []
    for n in (20, 40, 80, 160, 320):
        for i in range(20):
            words = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            rows += [(n * 1000 + i, 0, " ".join(words)), (n * 1000 + i, 1, " ".join(words[n // 2 :] + words[: n // 2]))]
    made = fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, half int, text string"))
    pair = made.groupBy("doc_id").agg(F.min(F.struct("half", "fingerprint")).alias("a"), F.max(F.struct("half", "fingerprint")).alias("b"))
    near = pair.groupBy(F.floor(F.col("doc_id") / 1000).alias("n")).agg(F.avg(fingerprints.likeness(F.col("a.fingerprint"), F.col("b.fingerprint"))).alias("near"))
    found = {r["n"]: r["near"] for r in near.collect()}
    assert len(found) == 5 and max(found.values()) <= 0.55, found


def test_blocks_of_bounds(spark):
    bounds = [x * 7 - 300 for x in range(9000)]
    got = spark.range(-400, 70000, 13).select("id", fingerprints.block_of(F.col("id"), bounds, 8).alias("b")).collect()
    assert all(r["b"] == sum(x <= r["id"] for x in bounds[max(0, (r["id"] + 300) // 7 - 2) :][:5]) + min(9000, max(0, (r["id"] + 300) // 7 - 2)) for r in got[:800])


def test_occurrences_count(spark):
    """A repeated k-mer counts once for each occurrence: fewer repeats are another fingerprint, in the same order another one."""
    rows = [(1, "a b c d e f " * 3), (2, "a b c d e f " * 40), (3, "a b c d e f " * 40), (4, " ".join(reversed(("a b c d e f " * 40).split())))]
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[2] == got[3] and len({got[1], got[2], got[4]}) == 3
    different = lambda s: len({s[i : i + 4] for i in range(0, 256, 4)})
    assert different(got[2]) > different(got[1]) and all("-" not in x for x in got.values())


def test_order_matters(spark):
    rnd = random.Random(2)
    blocks = [[f"w{rnd.randrange(5000)}" for _ in range(40)] for _ in range(12)]
    swapped = blocks[6:] + blocks[:6]
    flat = lambda b: " ".join(w for x in b for w in x)
    table = spark.createDataFrame([(1, flat(blocks)), (2, flat(swapped))], DOCS)
    a, b = (r["fingerprint"] for r in fingerprints.fingerprint(table).orderBy("doc_id").collect())
    grams = lambda b: set(pairwise(flat(b).split()))
    jaccard = len(grams(blocks) & grams(swapped)) / len(grams(blocks) | grams(swapped))
    same = np.mean([a[i : i + 4] == b[i : i + 4] for i in range(0, 256, 4)])
    assert jaccard > 0.95 and same < 0.8


def test_fingerprint_edges(spark):
    assert fingerprints.edited_fingerprints(spark.createDataFrame([], DOCS)).collect() == []
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(1, "abcd", "f")], DOCS + ", fingerprint string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    none = fingerprints.edited_fingerprints(spark.createDataFrame([(1, None), (2, "")], DOCS)).collect()
    assert all(r["near_next"] == r["near_edited"] == 1.0 and r["fingerprint"] == "-" * 256 for r in none)


def test_fingerprints_of_long_texts(spark):
    """Whole texts of 200,000 words count: another last word, halves swapped, and one word throughout."""
    words = [f"w{i}" for i in range(200_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "other"])), (3, " ".join(words[100_000:] + words[:100_000])), (4, "same " * 200_000)]
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1]["near_next"] > 0.9 > 0.75 > got[2]["near_next"] and got[3]["near_next"] == 0.0
    assert [got[i]["n_chars"] for i, _ in rows] == [len(t) for _, t in rows]
    edited = rows[3][1][: len(rows[3][1]) - len(rows[3][1]) // 2] + rows[0][1][: len(rows[3][1]) // 2]
    assert got[4]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


# -- LM scores

def slow_scores(net, vocabulary, counts, text):
    """Every word by plain loops: class, id in the class, and a rare word's share of its id's words."""
    import zlib

    words = (text or "").encode().split()
    ids = [vocabulary.ids.get(w) or vocabulary.size - vocabulary.rare + zlib.crc32(w[-3:]) % vocabulary.rare for w in words]
    padded = [0, 0, *ids, 0, 0]
    totals = {}
    for w, n in counts.items():
        if w not in vocabulary.ids:
            i = vocabulary.size - vocabulary.rare + zlib.crc32(w[-3:]) % vocabulary.rare
            totals[i] = totals.get(i, 0) + n
    total, width = 0.0, net["word_b"].shape[1]
    for i, w in enumerate(words):
        h = np.tanh(sum(net["embed"][padded[i + 2 + o]].astype(float) * net["place"][k] for k, o in enumerate(lm_scoring.OFFSETS)))
        c, v = divmod(ids[i], width)
        a, b = h @ net["class_w"] + net["class_b"], h @ net["word_w"][c] + net["word_b"][c]
        total += a[c] - np.log(np.exp(a).sum()) + b[v] - np.log(np.exp(b).sum())
        if w not in vocabulary.ids:
            total += np.log(counts[w] / totals[ids[i]])
    return total


def test_scores_as_by_hand(spark):
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = lm_scoring.word_counts(docs)
    texts = docs.collect()
    counts = Counter(w for r in texts for w in (r["text"] or "").encode().split())
    assert {bytes(r["word"]): r["n"] for r in words.collect()} == counts
    vocabulary = lm_scoring.learn_vocabulary(words, 256, 32)
    assert 150 < len(vocabulary.ids) <= 223 and min(counts[w] for w in vocabulary.ids) == vocabulary.least > max(n for w, n in counts.items() if w not in vocabulary.ids)
    assert vocabulary.counts.sum() == sum(counts.values())
    net = lm_scoring.train(docs, vocabulary, lm_scoring.first_network(docs, vocabulary, dim=8))
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, vocabulary, net, words).collect()}
    for r in texts[:12]:
        assert got[r["doc_id"]]["n_tokens"] == len(r["text"].split())
        assert got[r["doc_id"]]["sum_logprob"] == pytest.approx(slow_scores(net, vocabulary, counts, r["text"]), rel=1e-3)


def test_scores_beat_word_frequencies(spark):
    """By half a nat a word and more, whatever the number of tasks that rows are dealt to; tasks hardly change the order."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words = lm_scoring.word_counts(docs)
    entropy = words.agg(F.sum(F.col("n") * F.ln("n")) / F.sum("n") - F.ln(F.sum("n"))).first()[0]
    vocabulary = lm_scoring.learn_vocabulary(words)
    scores = []
    for tasks in (2, 24):
        dealt = docs.repartition(tasks, "doc_id")
        net = lm_scoring.train(dealt, vocabulary, lm_scoring.first_network(dealt, vocabulary))
        rows = lm_scoring.score(dealt, vocabulary, net, words).collect()
        assert sum(r["sum_logprob"] for r in rows) / sum(r["n_tokens"] for r in rows) > entropy + 0.5
        scores.append({r["doc_id"]: r["mean_logprob"] for r in rows})
    ranks = [np.argsort(np.argsort([s[i] for i in sorted(scores[0])])) for s in scores]
    assert np.corrcoef(*ranks)[0, 1] > 0.99


def test_scores_prefer_the_corpus(spark):
    rnd = random.Random(1)
    pairs = {"red": "apple", "blue": "sky", "tall": "tree", "deep": "sea"}
    line = lambda: " ".join(f"the {k} {pairs[k]} is here ." for k in rnd.choices(list(pairs), k=30))
    rows = [(i, line()) for i in range(150)]
    mixed = " ".join(f"the {k} {rnd.choice(list(pairs.values()))} is here ." for k in rnd.choices(list(pairs), k=30))
    docs = spark.createDataFrame([*rows, (1000, mixed), (1001, None), (1002, ""), (1000, mixed), (None, line())], DOCS).withColumn("n", F.lit("x")).withColumn("sum_logprob", F.lit(1)).withColumn("rare", F.lit(1))
    words = lm_scoring.word_counts(docs)
    vocabulary = lm_scoring.learn_vocabulary(words, 64, 8)
    start = lm_scoring.first_network(docs, vocabulary, 8, passes=12, batch_size=256)
    got = lm_scoring.score(docs, vocabulary, lm_scoring.train(docs, vocabulary, start, masked=1, batch_size=256), words).collect()
    mean = {r["doc_id"]: r["mean_logprob"] for r in got}
    assert len(got) == 155 and mean[1001] is None and mean[1002] is None and got[0].asDict().keys() == {"doc_id", "n_tokens", "sum_logprob", "mean_logprob"}
    assert min(mean[i] for i in range(150)) > mean[1000]
    assert np.mean([mean[i] for i in range(150)]) > -0.8
    assert lm_scoring.pseudo_likelihood(spark.createDataFrame([], DOCS), 64, 8, 8).collect() == []


def test_scores_of_rare_words_and_long_texts(spark):
    """A word that occurs more often is likelier even if no other word of its kind is in the vocabulary; every word of a long text counts."""
    long = " ".join(f"w{i % 5000}" for i in range(150_000))
    common = [(10 + i, "common words here and common words there") for i in range(60)]
    rows = [(1, long), (2, "common words 1zqab here"), (3, "common words 7zqab here"), *[(4, "see 7zqab there")] * 5, *common]
    got = {r["doc_id"]: r for r in lm_scoring.pseudo_likelihood(spark.createDataFrame(rows, DOCS), 64, 16, 8).collect()}
    assert got[1]["n_tokens"] == 150_000 and got[2]["mean_logprob"] < got[3]["mean_logprob"] < got[10]["mean_logprob"]
    assert got[3]["sum_logprob"] - got[2]["sum_logprob"] == pytest.approx(np.log(6), abs=1e-5)


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    vocabulary = lm_scoring.Vocabulary({}, 4, 16, 4, 1, rng.integers(1, 50, 16))
    net = {k: v.astype(np.float64) for k, v in lm_scoring.new_network(vocabulary, 3, 1).items()}
    ids = np.concatenate([[0, 0], rng.integers(1, 16, 40), [0, 0]])
    at = np.arange(2, 42)
    before = {k: v.copy() for k, v in net.items()}
    squares = {k: np.zeros_like(v) + 1e-30 for k, v in net.items()}
    lm_scoring.train_step(net, squares, ids, at, 1e-9)
    loss = lambda n: -lm_scoring.log_probabilities(n, ids, at).mean()
    for name, index in (("embed", (int(ids[5]), 2)), ("place", (1, 2)), ("class_w", (1, 2)), ("class_b", (2,)), ("word_w", (int(ids[4]) // 4, 1, 2)), ("word_b", (int(ids[7]) // 4, 1))):
        up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
        up[name][index] += 1e-5
        down[name][index] -= 1e-5
        assert np.sqrt(squares[name][index]) == pytest.approx(abs(loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-7)


# -- quality rules

def slow_repeats(text, width=5):
    words = text.encode().split()
    grams = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit.update(range(i, i + width))
    return len(hit)


def test_quality_counts(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choice(["a ", "b ", "c ", "dd# ", "é\n", "\t", "x|y ", "\n"]) for _ in range(rnd.choice([0, 3, 20, 200])))) for i in range(150)]
    rows += [(900, None), (901, " \n\n"), (902, "same line here now ok\n" * 4), (None, "one two three four five six seven eight nine ten"), (902, "same line here now ok\n" * 4)]
    got = quality_rules.judge_quality(spark.createDataFrame(rows, DOCS + "").withColumn("kept", F.lit(1))).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t in rows}
    for r in got:
        t = texts[r["doc_id"]]
        words = [w for w in __import__("re").split(r"[ \t-\r]+", t) if w]
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), slow_repeats(t))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r["base_failed"] and r["kept"])
    assert quality_rules.judge_quality(spark.createDataFrame([], DOCS)).collect() == []


def test_quality_of_a_long_text(spark):
    """A million words: those of a repeated passage count up to the text's end."""
    words = [f"w{i}" for i in range(1_000_000)]
    words[-50:] = words[:50]
    r = quality_rules.judge_quality(spark.createDataFrame([(1, "\n".join(" ".join(words[i : i + 10]) for i in range(0, len(words), 10)))], DOCS)).first()
    assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (1_000_000, sum(map(len, words)), 5, 100, False)


def test_votes_find_accuracies():
    rng = np.random.default_rng(3)
    n, for_good, for_bad = 40000, np.array([0.97, 0.95, 0.9, 0.85, 0.95, 0.9]), np.array([0.7, 0.5, 0.6, 0.8, 0.4, 0.6])
    good = rng.random(n) < 0.75
    right = rng.random((n, 6)) < np.where(good[:, None], for_good, for_bad)
    votes = np.where(rng.random((n, 6)) < 0.8, np.where(right == good[:, None], 1, -1), 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, yes, no = quality_rules.fit_votes(patterns, counts.astype(float))
    assert 1 / (1 + np.exp(-prior)) == pytest.approx(0.75, abs=0.03)
    assert np.allclose(yes, np.log(for_good / (1 - for_bad)), atol=0.2) and np.allclose(no, np.log((1 - for_good) / for_bad), atol=0.25)
    odds = prior + (votes > 0) @ yes + (votes < 0) @ no
    assert ((odds > 0) == good).mean() > ((votes.sum(axis=1) > 0) == good).mean() > 0.9


def slow_quality(rows, rounds=500):
    """Posteriors by expectation-maximisation over documents, rule by rule, in plain loops."""
    import math

    rules = len(rows[0])
    a, b, prior = [0.95] * rules, [0.35] * rules, 0.85
    for _ in range(rounds):
        p = []
        for votes in rows:
            yes, no = math.log(prior), math.log(1 - prior)
            for r, v in enumerate(votes):
                if v:
                    yes += math.log(a[r] if v > 0 else 1 - a[r])
                    no += math.log(1 - b[r] if v > 0 else b[r])
            p.append(1 / (1 + math.exp(min(no - yes, 700))))
        before = a + b + [prior]
        for r in range(rules):
            cast = [(q, v[r]) for q, v in zip(p, rows, strict=True) if v[r]]
            a[r] = (sum(q for q, v in cast if v > 0) + 0.95 * 20) / (sum(q for q, _ in cast) + 20)
            b[r] = (sum(1 - q for q, v in cast if v < 0) + 0.35 * 20) / (sum(1 - q for q, _ in cast) + 20)
            a[r] = min(max(a[r], 0.001), 0.999)
            b[r] = min(max(b[r], 1 - a[r], 0.001), 0.999)
        prior = min(max((sum(p) + 0.85 * 20) / (len(rows) + 20), 0.05), 0.99)
        if max(abs(x - y) for x, y in zip(before, a + b + [prior], strict=True)) < 1e-9:
            break
    return p


def test_quality_as_by_hand(spark):
    """``quality`` and ``kept`` of the query's operator equal a slow expectation-maximisation over the same votes."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = quality_rules.measure(docs)
    votes = seen.select("doc_id", "n_words", "n_repeat_words", *[v.alias(k) for k, v in quality_rules.rules().items()]).orderBy("doc_id").collect()
    want = slow_quality([r[3:] for r in votes])
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(docs).collect()}
    for r, p in zip(votes, want, strict=True):
        found = got[r["doc_id"]]
        assert found["quality"] == pytest.approx(p, abs=1e-5)
        assert found["kept"] == (p >= 0.5 and r["n_words"] >= 10 and 100 * r["n_repeat_words"] <= 20 * r["n_words"])


def test_quality_weights_decide(spark):
    """The fitted accuracies change verdicts against rules of equal weight, towards the labels."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    rules = quality_rules.rules()
    equal = quality_rules.measure(docs).withColumn("sum", sum(rules.values(), F.lit(0))).select("doc_id", "sum")
    rows = quality_rules.judge_quality(docs).where("not base_failed").join(equal, "doc_id").join(labels, "doc_id", "left").select("kept", (F.col("sum") > 0).alias("equal"), "label").collect()
    assert sum(r["kept"] != r["equal"] for r in rows) > 0.01 * len(rows)
    known = [r for r in rows if r["label"] is not None]
    assert sum(r["kept"] == bool(r["label"]) for r in known) > sum(r["equal"] == bool(r["label"]) for r in known)


def test_quality_other_scripts(spark):
    """Prose with vowel signs, without case, or without blanks between words is no worse than Latin prose; very long texts are whole."""
    texts = {
        1: "यह एक लंबा वाक्य है जिसमें बहुत सारे शब्द हैं और यह किसी भी अच्छे लेख की तरह लिखा गया है। " * 1 + "दूसरा वाक्य भी उतना ही अच्छा है और पढ़ने में आसान लगता है।",
        2: "இது ஒரு நீண்ட வாக்கியம் மற்றும் இதில் பல சொற்கள் உள்ளன, எனவே இது நல்ல உரை ஆகும். மேலும் ஒரு வாக்கியம் இங்கே எழுதப்பட்டுள்ளது.",
        3: "นี่คือประโยคยาวที่เขียนเป็นภาษาไทย โดยไม่มีช่องว่างระหว่างคำ และควรถือว่าเป็นข้อความที่ดี เพราะ เขียน อย่าง ดี และ มี ความหมาย ครบถ้วน.",
        4: "Это длинное предложение, в котором много разных слов, и оно написано так же, как любой хороший текст. Второе предложение тоже хорошее.",
        5: "A long text. " + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(17_000)) + " end.",
    }
    prose = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id >= 0").withColumn("doc_id", F.col("doc_id") + 1000)
    got = {r["doc_id"]: r for r in quality_rules.judge_quality(prose.union(spark.createDataFrame(list(texts.items()), DOCS))).collect()}
    assert [i for i in texts if not got[i]["kept"]] == [] and got[5]["n_words"] == 17_004


def test_quality_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality_rules.judge_quality(docs).withColumnRenamed("quality", "p").join(labels, "doc_id").where("n_words >= 10").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
    kept = {r["quality"]: r["kept"] for r in rows}
    assert kept[1] > 0.98 and kept[0] < 0.15


PROSE = "<p>The committee met in the old town hall to discuss the new bridge, and most of those present spoke at length.</p><p>A decision is expected in spring, once the river has been measured, said the mayor after the meeting.</p>"
PLAIN = re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", PROSE)).strip()


@pytest.mark.parametrize(
    "around",
    [
        '<div class="elementor-element elementor-widget elementor-widget-text-editor">%s</div>', '<div class="widget Blog"><div class="post">%s</div></div>', '<div class="article hero-banner">%s</div>', '<div role="form">%s</div>', '<article class="article hero-banner">%s</article>',
        '<div class="service-notice">%s</div>', '<div id="social">%s</div>', '<main><h1>The bridge</h1><div class="elementor-widget">%s</div></main>', '<div class="post tags">%s</div>', '<div class="sidebar">%s</div>',
    ],
)
@pytest.mark.parametrize("beside", ["<p>© 2020 Site</p>", '<nav><a href="/">Home</a></nav><p>© 2020 Site</p>', '<div class="widget"><a href="/a">One</a> <a href="/b">Two</a></div>', ""])
def test_names_do_not_take_the_article(around, beside):
    """Names that page builders give to what holds an article lose against it, also beside stray lines."""
    got = html_text.main_text(f"<html><body>{around % PROSE}{beside}</body></html>")
    assert PLAIN in got and "One" not in got and "Home" not in got


def test_split_widgets_stay_whole():
    """An article in many blocks of one builder's class, each of which is small beside the others."""
    blocks = "".join(f'<div class="elementor-widget">{PROSE}</div>' for _ in range(5))
    assert html_text.main_text(f"<body><p>© 2020 Site</p>{blocks}</body>").count("committee") == 5


def test_small_named_blocks_go():
    for name in ("widget", "banner", "social", "notice", "comments", "sidebar", "promo", "cookie-notice"):
        page = f'<body><div class="content">{PROSE}</div><div class="{name}"><p>Sign up for more of this, it is free of charge.</p></div></body>'
        assert html_text.main_text(page) == PLAIN, name
    long = "<p>I for one think that this bridge is not needed at all, and I have said so before.</p>" * 12
    assert html_text.main_text(f'<body><div class="content">{PROSE}</div><div class="comments">{long}</div></body>') == PLAIN
    assert html_text.main_text(f'<body><article>{PROSE}</article><div class="widget">{long}</div></body>') == PLAIN


def test_references_in_an_article_stay():
    page = f'<body><article>{PROSE}<ul><li><a href="/1">Survey of the river</a></li><li><a href="/2">Minutes of the meeting</a></li></ul></article><ul><li><a href="/x">Home</a></li><li><a href="/y">Contact</a></li></ul></body>'
    assert html_text.main_text(page) == f"{PLAIN} Survey of the river Minutes of the meeting"


def test_article_element_wins_over_a_longer_block_of_comments():
    said = "".join(f"<div><b>user {i}</b><p>I for one think that this bridge is not needed, and so do many more.</p></div>" for i in range(4))
    assert html_text.main_text(f"<body><article>{PROSE}</article><section>{said}</section></body>").startswith(PLAIN)
