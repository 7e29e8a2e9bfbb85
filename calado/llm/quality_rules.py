"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation weighs them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calado.llm._shared import materialise

#: Blanks that end a word, the symbols that count, and signs that end a line of prose.
BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ENDS = ".!?…:;\"'”’)।॥。！？؟۔"
#: A word that is one sign, or ends in two or more.
_ODD_END = re.compile(r"(?:[^\w\s]{2,}|(?<!\S)[^\w\s–—&।॥-])(?!\S)")
_ODD_END_MARKED = regex.compile(r"(?:[^\w\s\p{M}]{2,}|(?<!\S)[^\w\s\p{M}–—&।॥-])(?!\S)")
_UPPER, _LOWER, _LETTERS = regex.compile(r"\p{Lu}+"), regex.compile(r"\p{Ll}+"), regex.compile(r"[\p{L}\p{M}]+")
#: Scripts that put no blanks between words.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]+")
_LATIN = {kind: bytes(i for i in range(256) if unicodedata.category(chr(i)) in kinds) for kind, kinds in (("upper", ("Lu",)), ("lower", ("Ll",)), ("letters", ("Lu", "Ll", "Lo")))}

_FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_lower", "n_ended", "n_letters", "n_odd_ends", "n_echoes", "n_unspaced"]


def _repeated_words(ids: np.ndarray, width: int) -> int:
    """Positions inside windows of ``width`` that occur twice or more; windows are compared exactly."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    base = int(ids.max()) + 1
    key, span = ids.astype(np.int64), 1
    while span < width:  # ranks of windows of 1, 2, .. words
        key = key[: len(ids) - span] * base + ids[span:]
        span += 1
        if span < width:
            key = np.unique(key, return_inverse=True)[1] if int(key.max()) > (1 << 62) // base else key
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[where] > 1)
    if not len(starts):
        return 0
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def _measure(text: str, width: int) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANK_CHARS)]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANK_CHARS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        _repeated_words(ids, width) if len(words) > width else 0,
        len(lines),
        len(number),
        *_cased(text),
        sum(x.rstrip(BLANK_CHARS)[-1] in ENDS for x in lines),
        *_signs(text),
        int((ids[1:] == ids[:-1]).sum()),
        0 if text.isascii() else sum(map(len, _UNSPACED.findall(text))),
    )


def _latin(text: str) -> bytes | None:
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _cased(text: str) -> tuple[int, int]:
    """Upper-case and lower-case letters."""
    raw = _latin(text)
    if raw is None:
        return sum(map(len, _UPPER.findall(text))), sum(map(len, _LOWER.findall(text)))
    return len(raw) - len(raw.translate(None, _LATIN["upper"])), len(raw) - len(raw.translate(None, _LATIN["lower"]))


def _signs(text: str) -> tuple[int, int]:
    """Letters with the marks that combine with them, and odd word ends."""
    raw = _latin(text)
    if raw is None:
        return sum(map(len, _LETTERS.findall(text))), len(_ODD_END_MARKED.findall(text))
    return len(raw) - len(raw.translate(None, _LATIN["letters"])), len(_ODD_END.findall(text))


def measure(docs: DataFrame, width: int = 5) -> DataFrame:
    """Rows (doc_id, counts of the whole text) that the rules read. Null text has no words and all counts 0."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} bigint" for c in _FEATURES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [_measure(t or "", width) for t in rows.column(1).to_pylist()]
            if found:
                yield pa.RecordBatch.from_arrays([rows.column(0), *[pa.array(x, pa.int64()) for x in zip(*found, strict=True)]], ["doc_id", *_FEATURES])

    return docs.select("doc_id", "text").mapInArrow(count, schema)


def _vote(bad: Column, good: Column) -> Column:
    """-1 against quality, 1 for it, 0 to abstain."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules over the columns of ``measure``. Each votes both ways and abstains between its bounds, or where it says nothing:
    case in scripts without it, word lengths where blanks do not end words, repeats and variety in short texts."""
    c = F.col
    words, lines, letters = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1)), c("n_letters")
    cased, long = c("n_upper") + c("n_lower"), c("n_words") >= 30
    spaced = 10 * c("n_unspaced") <= 3 * letters
    return {
        "symbols": _vote(c("n_symbols") > 0.15 * words, c("n_symbols") <= 0.02 * words),
        "capitals": _vote((c("n_upper") > 0.5 * cased) & (2 * cased > letters), (c("n_upper") <= 0.2 * cased) & (2 * cased > letters)),
        "repeats": _vote(c("n_repeat_words") > 0.15 * words, long & (c("n_repeat_words") <= 0.02 * words)),
        "lines": _vote(c("n_dup_lines") > 0.3 * lines, (c("n_lines") >= 3) & (c("n_dup_lines") == 0)),
        "odd_ends": _vote(c("n_odd_ends") > 0.2 * words, c("n_odd_ends") <= 0.02 * words),
        "letters": _vote(letters < 0.75 * c("word_chars"), letters >= 0.9 * c("word_chars")),
        "word_length": _vote(spaced & ~c("word_chars").between(2.5 * words, 14 * words), spaced & c("word_chars").between(3.5 * words, 9 * words)),
        "variety": _vote(long & (c("n_distinct") < 0.2 * words), long & (c("n_distinct") >= 0.35 * words)),
        "echoes": _vote(c("n_echoes") > 0.1 * words, c("n_echoes") <= 0.01 * words),
        "ended": _vote(long & (c("n_ended") < 0.1 * lines), c("n_ended") >= 0.5 * lines),
    }


def fit_votes(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, pseudo: float = 20.0, good: float = 0.95, bad: float = 0.35, share: float = 0.85
) -> tuple[float, np.ndarray, np.ndarray]:
    """(log prior odds, log odds of each rule's vote for, log odds of each rule's vote against) by expectation-maximisation.

    ``patterns`` are distinct rows of votes (1, -1, 0) and ``counts`` how many documents cast each. A rule has two
    accuracies: the share of its votes for among good texts, and of its votes against among bad ones, of those where it votes;
    abstaining says nothing. They begin at ``good`` and ``bad`` (most faults spare most rules), the prior at ``share``, which
    also weigh as ``pseudo`` votes and documents. No rule falls below a coin.
    """
    up, down = (patterns > 0).astype(float), (patterns < 0).astype(float)
    a, b, prior = np.full(patterns.shape[1], good), np.full(patterns.shape[1], bad), share
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + up @ np.log(a / (1 - b)) + down @ np.log((1 - a) / b)
        p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        yes, no = counts * p, counts * (1 - p)
        new_a = np.clip((yes @ up + good * pseudo) / (yes @ (up + down) + pseudo), 0.001, 0.999)
        new_b = np.clip(np.maximum((no @ down + bad * pseudo) / (no @ (up + down) + pseudo), 1 - new_a), 0.001, 0.999)
        new_prior = float(np.clip((yes.sum() + share * pseudo) / (counts.sum() + pseudo), 0.05, 0.99))
        change = max(np.abs(new_a - a).max(), np.abs(new_b - b).max(), abs(new_prior - prior))
        a, b, prior = new_a, new_b, new_prior
        if change < 1e-9:
            break
    return float(np.log(prior / (1 - prior))), np.log(a / (1 - b)), np.log((1 - a) / b)


def judge_quality(docs: DataFrame, width: int = 5, threshold: float = 0.5) -> DataFrame:
    """Rows (doc_id, the counts of ``measure``, base_failed, quality, kept).

    ``base_failed``: under 10 words, or over 20 % of words in repeated windows. ``quality`` is the posterior probability
    from all rules' votes; ``kept`` if it is ``threshold`` or more and the base did not fail. Only the table of
    distinct vote patterns, at most 3 to the power of the number of rules, goes to the driver. Null and empty texts fail the base.
    Repeated rows count each; an empty table gives an empty table.
    """
    cast = rules()
    seen = materialise(measure(docs, width).select("*", *[v.cast("int").alias(f"_{k}") for k, v in cast.items()]), "votes")
    votes = [f"_{k}" for k in cast]
    table = seen.groupBy(*votes).count().orderBy(*votes).collect()
    patterns = np.array([r[:-1] for r in table], int).reshape(-1, len(votes))
    prior, speaks_for, against = fit_votes(patterns, np.array([r[-1] for r in table], float))
    odds = F.lit(prior)
    for name, yes, no in zip(votes, speaks_for, against, strict=True):
        odds = odds + F.when(F.col(name) > 0, float(yes)).when(F.col(name) < 0, float(no)).otherwise(0.0)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    quality = 1 / (1 + F.exp(-odds))
    return seen.select("doc_id", *_FEATURES[:5], failed.alias("base_failed"), quality.alias("quality"), (~failed & (quality >= threshold)).alias("kept"))
