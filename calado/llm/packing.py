"""Best-two-fit packing of token pieces into sequences."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calado.llm._shared import materialise

# Latin-1 letters in lower case, and the table that lowers the others. No Latin-1 text changes under NFC.
_LETTERS = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0xC0 <= b <= 0xDE and b != 0xD7 else b for b in range(256))
#: Runs of letters and runs of other signs are tokens' outer bounds, but for an apostrophe, which may go with letters after it.
_RUNS = re.compile(rb"[%b]+|[^\s%b]+" % (_LETTERS, _LETTERS))
_RUNS_QUOTED = re.compile(rb"[^\s']*'\S*|[%b]+|[^\s%b]+" % (_LETTERS, _LETTERS))
_WORD = re.compile(rb"[%b]+" % _LETTERS)
#: Bytes of pieces that each of a task's two caches holds at most, beyond which it is emptied, and of the longest piece kept.
_CACHE, _LONGEST = 1 << 24, 256


class _Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Tokens never cross ASCII white space here, so a text's ids are those of its pieces, and pieces come back often: each is
    encoded by the library once. Pieces of Latin-1 texts are runs of lower-case letters and runs of signs; those of other texts,
    and of texts with the marks of special tokens, are all that stands between white space.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.whole = Tokenizer.from_file(path)
        self.words = Tokenizer.from_file(path)
        # A run of lower-case letters is one piece of the vocabulary's own rule, and already normalised.
        self.words.normalizer = None
        self.words.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.words.get_vocab_size(), bool)  # tokens that end a piece
        self.ends[[i for token, i in self.words.get_vocab().items() if token.endswith("</w>")]] = True
        self.runs: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}
        self.held = [0, 0]  # bytes of the pieces in either

    def _split(self, text: str) -> tuple[dict, list[bytes]]:
        if "<|" not in text:
            try:
                raw = text.encode("latin-1").translate(_LOWER)
                return self.runs, (_RUNS_QUOTED if b"'" in raw else _RUNS).findall(raw)
            except UnicodeEncodeError:
                pass
        return self.chunks, text.encode().split()

    def _learn(self, known: dict[bytes, bytes], pieces: list[bytes], encoding: str) -> None:
        texts = [x.decode(encoding) for x in pieces]
        for piece, e in zip(pieces, self.whole.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            known[piece] = array("I", e.ids).tobytes()

    def _learn_words(self, words: list[bytes], together: int = 256) -> None:
        """Words of letters are encoded many to a text; each ends with a token that ends a piece."""
        groups = [words[i : i + together] for i in range(0, len(words), together)]
        found = self.words.encode_batch_fast([b" ".join(g).decode("latin-1") for g in groups], add_special_tokens=False)
        for group, e in zip(groups, found, strict=True):
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            for word, a, b in zip(group, [0, *ends], ends, strict=False):
                self.runs[word] = raw[a:b]
            if len(ends) != len(group):
                raise ValueError("a word has no ending token, or several")

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        for batch in _batches(texts):
            split = [self._split(t or "") for t in batch]
            long: list[tuple[dict, bytes]] = []  # pieces that are not kept: none comes back soon, and one may be a whole text
            for i, (known, encoding) in enumerate(((self.runs, "latin-1"), (self.chunks, "utf-8"))):
                if self.held[i] > _CACHE:
                    known.clear()
                    self.held[i] = 0
                new = set().union(*(p for k, p in split if k is known)).difference(known)
                self.held[i] += sum(len(x) for x in new if len(x) <= _LONGEST)
                long += [(known, x) for x in new if len(x) > _LONGEST]
                if known is self.runs:
                    plain = [x for x in new if _WORD.fullmatch(x)]
                    self._learn_words(plain)
                    new = new.difference(plain)
                self._learn(known, list(new), encoding)
            found = [b"".join(map(known.__getitem__, pieces)) for known, pieces in split]
            for known, x in long:
                del known[x]
            yield from found


def _batches(texts: list[str | None], most: int = 1 << 20) -> Iterator[list[str | None]]:
    batch, size = [], 0
    for t in texts:
        batch.append(t)
        size += len(t or "")
        if size > most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


_encoders: dict[str, _Encoder] = {}


def token_pieces(docs: DataFrame, vocabulary: str, limit: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]) of each document's ids followed by ``end_id``.

    Only documents of over ``limit`` ids are cut, every ``limit`` ids. Null and empty text: ``end_id`` alone. ``ids`` holds
    little-endian unsigned 32-bit ids. Repeated rows give repeated pieces; a null doc_id stays null.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    step, tail = 4 * limit, np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if vocabulary not in _encoders:
            _encoders[vocabulary] = _Encoder(vocabulary)
        encoder = _encoders[vocabulary]
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, packed in enumerate(encoder.ids(batch.column(1).to_pylist())):
                packed += tail
                for k, at in enumerate(range(0, len(packed), step)):
                    part = packed[at : at + step] if len(packed) > step else packed
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def two_fit_plan(counts: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int, int]]:
    """Fill sequences from a histogram of lengths.

    A sequence starts with the largest length left and takes the largest that fits until none does. Then the two lengths
    left that fill the gap without its smallest member best replace that member, if together they are longer. The same
    sequence is repeated while its lengths last. Returns (length, first rank, end rank, members of that length in a sequence,
    first sequence, offset in it): the documents of a length, ranked, go to the sequences in turn.
    """
    left = np.zeros(limit + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(limit + 1, np.int64)
    plan, sequence = [], 0
    at = np.arange(limit + 1)
    while left.any():
        free = left.copy()
        fill: list[int] = []
        gap = limit
        below = np.maximum.accumulate(np.where(free > 0, at, 0))  # the largest length left that is no longer
        while gap and below[gap]:
            x = int(below[gap])
            fill.append(x)
            free[x] -= 1
            gap -= x
            if not free[x]:
                below = np.maximum.accumulate(np.where(free > 0, at, 0))
        if gap:
            smallest = fill[-1]
            room = gap + smallest
            a = np.flatnonzero(free[: room + 1])
            b = below[room - a]
            if len(a):
                twice = (a == b) & (free[a] < 2)
                b = np.where(twice, below[np.maximum(b - 1, 0)], b)
                total = np.where(b > 0, a + b, 0)
                if total[best := int(total.argmax())] > smallest:
                    fill[-1:] = sorted((int(a[best]), int(b[best])), reverse=True)
        lengths, members = np.unique(fill, return_counts=True)
        times = int((left[lengths] // members).min())
        offset = 0
        for x, m in sorted(zip(lengths.tolist(), members.tolist(), strict=True), reverse=True):
            plan.append((x, int(used[x]), int(used[x]) + times * m, m, sequence, offset))
            used[x] += times * m
            left[x] -= times * m
            offset += x * m
        sequence += times
    return plan


def pack(pieces: DataFrame, limit: int = 2048, ranked_together: int = 512) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``length`` (1 to ``limit``) by best-two-fit.

    Only the histogram of lengths, at most ``limit`` numbers, goes to the driver. Pieces of one length are
    interchangeable: they are ranked in salted groups of about ``ranked_together``, whose starts are running counts,
    so that no task gets a whole length. Longer pieces are an error. An empty table gives an empty table.
    """
    pieces = materialise(pieces, "pieces")
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    if counts and max(counts) > limit:
        raise ValueError(f"a piece has {max(counts)} tokens; the limit is {limit}")
    plan = spark.createDataFrame(two_fit_plan(counts, limit), "_length long, _from long, _to long, _members long, _sequence long, _offset long")
    salts = spark.createDataFrame([(x, -(-n // ranked_together)) for x, n in counts.items()], "_length long, _salts long")
    salted = pieces.join(F.broadcast(salts), F.col("length") == F.col("_length")).drop("_length")
    salted = salted.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("_salts")))
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = groups.select(F.col("length").alias("_gl"), F.col("_salt").alias("_gs"), before.alias("_before"))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_local", F.row_number().over(order) - 1)
    ranked = ranked.join(groups, (F.col("length") == F.col("_gl")) & (F.col("_salt") == F.col("_gs")))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_local"))
    met = ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    k = F.col("_rank") - F.col("_from")
    return met.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(k / F.col("_members"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + F.pmod(k, F.col("_members")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = 2048, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Encode documents, cut those over ``limit`` ids, and pack all pieces: the columns of ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, vocabulary, limit, end_id, with_ids), limit)
