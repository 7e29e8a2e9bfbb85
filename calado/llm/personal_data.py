"""Personal data: fixed forms as seeds, and identifiers of other forms found by the contexts that seeds share."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calado.llm._shared import materialise

#: The kinds in their order, and the forms of the base.
KINDS = ("email", "ip", "card", "phone")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
#: A match of this form always begins where a run of digits does.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

#: Looser forms that only a context makes an identifier of.
_NUMBERS = re.compile(r"[+(]?[0-9][0-9 ().\-/]*+")
_HEXES = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])")
_AT = re.compile(r"@|[\[({<] ?(?:at|AT|@) ?[\])}>]| (?:at|AT) ")
_BEFORE_AT = re.compile(r"[\w.%+-]{1,64} ?\Z")
_DOT = r" ?(?:\.|[\[({<] ?(?:dot|DOT|\.) ?[\])}>]| (?:dot|DOT) ) ?"
_AFTER_AT = re.compile(rf" ?([\w-]{{1,63}}(?:{_DOT}[\w-]{{1,63}}){{0,5}})")
_DOTS, _SPELLED = re.compile(_DOT), re.compile(r"dot|DOT")

_BLANK, _LETTER = re.compile(r"\s"), re.compile(r"[^\W\d_]")
#: Characters around a place that are looked at for its context, the longest word of a context, and the text split at once.
_WINDOW, _LONGEST, _CHUNK = 100, 40, 1 << 20
_SPAN = "struct<kind:int,start:bigint,end:bigint>"
_FOUND = "struct<kind:int,start:bigint,end:bigint,value:string,known:boolean,contexts:array<string>>"


def _luhn(digits: str) -> bool:
    doubled = sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind and start: leftmost and non-overlapping in each kind."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.match(text[start - 1]):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((0, start, host.end()))
            last = host.end()
        at = text.find("@", max(last, at + 1))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def _value(kind: int, text: str) -> str:
    """An identifier without what may differ from place to place: digits of numbers, small letters otherwise."""
    return _NO_DIGIT.sub("", text) if kind >= 2 else text.lower()


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, str]]:
    """(kind, start, end, value) of looser forms outside the base: numbers of 7 to 19 digits that stand alone (a number may be of two
    kinds), addresses of eight groups or four large ones, mail addresses spelled out or with other letters."""
    parts, last = [], 0
    for _, start, end in sorted(base, key=lambda x: x[1:]):
        start = max(start, last)
        if start < end:
            parts += [text[last:start], "\0" * (end - start)]
            last = end
    return _loose("".join([*parts, text[last:]]))


def _loose(text: str) -> Iterator[tuple[int, int, int, str]]:
    for m in _NUMBERS.finditer(text):
        body = m[0].rstrip(" ().-/")
        start, end = m.start(), m.start() + len(body)
        around = text[max(0, start - 1) : start] + text[end : end + 1]
        digits = _NO_DIGIT.sub("", body)
        if len(digits) < 4 or len(digits) > 19 or any(c.isalnum() or c in "_@\0" for c in around):
            continue
        if re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", body):
            yield 1, start, end, body
        else:
            if 12 <= len(digits):
                yield 2, start, end, digits
            if 7 <= len(digits) <= 15:
                yield 3, start, end, digits
    if text.count(":") > 2:
        for m in _HEXES.finditer(text):
            if m[0].count(":") > 2 or "::" in m[0]:
                yield 1, *m.span(), m[0].lower()
    last = 0
    for m in _AT.finditer(text):
        local, host = _BEFORE_AT.search(text[max(last, m.start() - 65) : m.start()]), _AFTER_AT.match(text, m.end())
        if local and host and ("@" in m[0] or m[0][0] != " " or _SPELLED.search(host[1])):
            last = host.end(1)
            name = local[0].rstrip()
            yield 0, m.start() - len(local[0]), last, f"{name}@{_DOTS.sub('.', host[1])}".lower()


def _words(text: str) -> list[str]:
    """Small-letter words between blanks; a sign that leads on to an identifier ends its word."""
    text = text.lower()
    for sign in ":=(,;":
        text = text.replace(sign, sign + " ")
    return text.split()


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a place: the word before (<), the two before, the two after (>). Words are of at most 40 characters, and a
    pattern has a letter."""
    left, right = text[max(0, start - _WINDOW) : start], text[end : end + _WINDOW]
    before, out = _words(left), []
    if start > _WINDOW and before and not left[0].isspace():
        before = before[1:]
    blank = _BLANK.search(right)
    after = _words(right[blank.start() :]) if blank else []
    if end + _WINDOW < len(text) and after and not right[-1].isspace():
        after = after[:-1]
    if before:
        out.append(("<", before[-1:]))
    if len(before) > 1:
        out.append(("<", before[-2:]))
    if len(after) > 1:
        out.append((">", after[:2]))
    return [side + " ".join(w) for side, w in out if max(map(len, w)) <= _LONGEST and _LETTER.search(" ".join(w))]


def _scan(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, base, found): spans of the fixed forms, and all identifiers and possible ones with their values and patterns."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base array<{_SPAN}>, found array<{_FOUND}>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "value", "known", "contexts")
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
        found = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("known", pa.bool_()), ("contexts", pa.list_(pa.string()))]))
        for rows in batches:
            bases, all_found = [], []
            for text in (t.as_py() or "" for t in rows.column(1)):
                base = base_spans(text)
                seen = [(k, s, e, _value(k, text[s:e]), True) for k, s, e in base] + [(*x, False) for x in loose_spans(text, base)]
                bases.append([dict(zip(names, x, strict=False)) for x in base])
                all_found.append([dict(zip(names, (*x, contexts(text, x[1], x[2])), strict=True)) for x in seen])
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(bases, span), pa.array(all_found, found)], ["doc_id", "base", "found"])

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def _count_grams(texts: DataFrame, grams: set[str]) -> DataFrame:
    """(gram, total): how often these words and pairs of words occur in all texts."""
    single = frozenset(g for g in grams if " " not in g)
    pairs = frozenset(tuple(g.split(" ")) for g in grams if " " in g)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for rows in batches:
            for text in (t.as_py() or "" for t in rows.column(0)):
                start, last = 0, []
                while start < len(text):
                    cut = _BLANK.search(text, start + _CHUNK)
                    end = cut.start() if cut else len(text)
                    words = _words(text[start:end])
                    sums.update(filter(single.__contains__, words))
                    words = last + words
                    sums.update(map(" ".join, filter(pairs.__contains__, zip(words, words[1:], strict=False))))
                    start, last = end, words[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums.keys()), pa.string()), pa.array(list(sums.values()), pa.int64())], ["gram", "n"])

    return texts.mapInArrow(count, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("total"))


def _meet(many: DataFrame, few: DataFrame, on: list[str], by: Column, how: str = "inner", salts: int = 16) -> DataFrame:
    """Join with rows of ``few``, one a key, so that a key of very many rows is split in ``salts`` parts."""
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)))
    return salted.join(few.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))), [*on, "_salt"], how).drop("_salt")


def score_graph(edges: DataFrame, totals: DataFrame, rounds: int = 5, enough: float = 0.75, support: int = 3, doubt: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(patterns with their ``trust``, values with their ``score``) after iterations over the graph of edges (pattern, kind, value, known, n).

    A known value scores 1. A pattern's trust is the share of what its places hold: scores of values of its kind, against all its other
    places in the texts (``totals``: pattern, total) and ``doubt`` times its values that are not trusted yet; below ``support``
    values of a score of ``enough`` it is 0. A value's score is the probability that one of its patterns of trust ``enough`` is right. It ends when
    scores stay, after ``rounds`` at most; each round is written.
    """
    values = edges.groupBy("kind", "value").agg(F.max("known").alias("known"))
    scores, before = materialise(values.withColumn("score", F.col("known").cast("double")), "scores"), -1.0
    for _ in range(rounds):
        met = _meet(edges.drop("known"), scores, ["kind", "value"], F.col("pattern"))
        trusted = F.count_if(F.col("score") >= enough)
        held = met.groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("_yes"), F.sum(F.col("n") * (1 - F.col("score"))).alias("_open"), F.sum("n").alias("_n"), trusted.alias("_sure"))
        held = held.join(totals, "pattern", "left")
        no = F.greatest(F.coalesce("total", F.lit(0)) - F.col("_n"), F.lit(0))
        trust = F.when(F.col("_sure") >= support, F.col("_yes") / (F.col("_yes") + no + doubt * F.col("_open") + 0.5)).otherwise(0.0)
        patterns = materialise(held.select("pattern", "kind", trust.alias("trust")), "patterns")
        strong = patterns.where(F.col("trust") >= enough)
        reached = _meet(edges.select("pattern", "kind", "value"), strong, ["pattern", "kind"], F.col("value"))
        reached = reached.groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log1p(-F.col("trust"))))).alias("_score"))
        score = F.when(F.col("known"), 1.0).otherwise(F.coalesce("_score", F.lit(0.0)))
        scores = materialise(scores.drop("score").join(reached, ["kind", "value"], "left").select("kind", "value", "known", score.alias("score")), "scores")
        total = scores.agg(F.sum("score")).first()[0] or 0.0
        if abs(total - before) < 1e-6:
            break
        before = total
    return patterns, scores


def find_personal_data(docs: DataFrame, rounds: int = 5, enough: float = 0.75, support: int = 3, grams_at_once: int = 1 << 16) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added).

    The base are the fixed forms of mail and IP addresses, card and phone numbers; the four counts and ``base_sha256``, over
    ``kind:start:end`` of its spans, are of the base alone. Its identifiers are seeds: the words around them are patterns. Looser forms (numbers
    of other lengths or without the plus sign, failing cards, IPv6, mail addresses spelled out) join where a pattern
    that seeds share is trusted, or where the same identifier is known from a fixed form; see ``score_graph``. What a trusted pattern
    finds supports patterns in the next round. ``spans`` lists base and added spans by kind and start, ``n_added`` counts the latter.
    A pattern is trusted by all its places in all texts, so common words never are.

    Places are code points. Null and empty texts have no spans. Repeated rows have equal results and repeat in them; they support a pattern as one
    value. Ties between kinds do not arise: a place may be of two kinds, each with its own evidence. Texts of any length are
    scanned whole in time proportional to it. Patterns are counted ``grams_at_once`` in a pass, the only rows that reach the driver. An
    empty table gives an empty table. Other columns of ``docs`` do no harm.
    """
    scanned = materialise(_scan(docs).withColumn("_row", F.monotonically_increasing_id()), "scanned")
    found = scanned.select("_row", F.explode("found").alias("_f")).select("_row", "_f.*")
    edges = found.select("kind", "value", "known", F.explode("contexts").alias("pattern"))
    edges = edges.groupBy("pattern", "kind", "value").agg(F.max("known").alias("known"), F.count(F.lit(1)).alias("n"))
    edges = materialise(edges, "edges")
    useful = edges.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("_values"), F.count_if(~F.col("known")).alias("_open"))
    useful = useful.where((F.col("_values") >= support) & (F.col("_open") > 0)).select("pattern", "kind")
    edges = materialise(_meet(edges, useful, ["pattern", "kind"], F.col("value")), "edges")
    totals = _totals(docs, edges.select("pattern").distinct(), grams_at_once)
    known = found.where("known").select("kind", "value").distinct().withColumn("score", F.lit(1.0))
    _, scores = score_graph(edges, totals, rounds, enough, support)
    sure = known.unionByName(scores.where(~F.col("known") & (F.col("score") >= enough)).select("kind", "value", "score")).select("kind", "value").distinct()
    span = F.struct("kind", "start", "end")
    added = _meet(found.where(~F.col("known")).select("_row", "kind", "start", "end", "value"), sure, ["kind", "value"], F.col("_row"))
    added = added.groupBy("_row").agg(F.collect_list(span).alias("_added"))
    rows = scanned.select("_row", "doc_id", "base").join(added, "_row", "left")
    extra = F.coalesce("_added", F.slice("base", 1, 0))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k))
    counts = [of_kind(k).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    said = lambda spans: F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select("doc_id", *counts, F.sha2(said(F.col("base")), 256).alias("base_sha256"), said(F.concat("base", extra)).alias("spans"), F.size(extra).cast("bigint").alias("n_added"))


def _totals(docs: DataFrame, patterns: DataFrame, at_once: int) -> DataFrame:
    """(pattern, total): places of each pattern's words in all texts, counted for about ``at_once`` patterns in a pass."""
    patterns = materialise(patterns.withColumn("gram", F.substring("pattern", 2, 2 * _LONGEST + 1)), "grams")
    passes, out = -(-patterns.count() // at_once), None
    for i in range(passes):
        part = patterns.where(F.pmod(F.xxhash64("gram"), F.lit(passes)) == i)
        grams = {r[0] for r in part.select("gram").distinct().collect()}
        counted = _count_grams(docs.select("text"), grams).join(part, "gram").select("pattern", "total")
        out = counted if out is None else out.unionByName(counted)
    return materialise(out, "totals") if out is not None else patterns.select("pattern", F.lit(0).cast("bigint").alias("total"))
