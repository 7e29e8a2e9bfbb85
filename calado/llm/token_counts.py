"""Token counts of whole texts by a public byte-level vocabulary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A single space between two other characters: no token crosses it, and what follows is tokenised alike on its own.
_SAFE = re.compile(r"(?<=\S) (?=\S)")
#: Characters of pieces whose counts a task remembers at most, and of the longest piece that it does.
_CACHE, _LONGEST = 1 << 24, 256


class _Counter:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[str, int] = {}
        self.held = 0

    def lengths(self, texts: list[str]) -> list[int]:
        """Texts are split at safe boundaries; only pieces not yet counted are encoded, together in one batch."""
        split = [_split(t) for t in texts]
        if self.held > _CACHE:
            self.known, self.held = {}, 0
        new = list(set().union(*split).difference(self.known))
        if not new:
            return [sum(map(self.known.__getitem__, pieces)) for pieces in split]
        counts = dict(zip(new, map(len, self.library.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        long = [x for x in new if len(x) > _LONGEST]  # no such piece comes back soon, and one may be a whole text
        self.known.update(counts)
        out = [sum(map(self.known.__getitem__, pieces)) for pieces in split]
        for x in long:
            del self.known[x]
        self.held += sum(map(len, new)) - sum(map(len, long))
        return out


def _split(text: str) -> list[str]:
    """The text's pieces; all but the first had a space before them, which goes with them."""
    if not text:
        return []
    first, *rest = _SAFE.split(text)
    return [first, *[" " + x for x in rest]]


def _balanced(texts: list[str], sizes: list[int], most: int) -> Iterator[list[str]]:
    batch, size = [], 0
    for t, n in zip(texts, sizes, strict=True):
        if batch and size + n > most:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += n
    if batch:
        yield batch


_counters: dict[str, _Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, batch_bytes: int = 1 << 20) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit): the ids the library gives for each whole text, without added ids.

    Null text counts as empty: 0 bytes, 0 tokens. Strings of special tokens inside a text are handled as the library
    does by default. Texts go to the library in batches of about ``batch_bytes`` bytes, split at single spaces
    between other characters, where this kind of vocabulary always starts a token. Repeated rows give repeated rows;
    a null doc_id stays null; an empty table gives an empty table.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocabulary not in _counters:
            _counters[vocabulary] = _Counter(vocabulary)
        for rows in batches:
            texts = [t or "" for t in rows.column(1).to_pylist()]
            n_bytes = [len(t.encode()) for t in texts]
            tokens = [n for batch in _balanced(texts, n_bytes, batch_bytes) for n in _counters[vocabulary].lengths(batch)]
            columns = [rows.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(count, schema)
