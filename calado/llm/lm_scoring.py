"""LM scoring by masked pseudo-likelihood: a network over the words on both sides predicts every word."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calado.llm._shared import materialise

#: Words on either side that the network sees.
OFFSETS = (-2, -1, 1, 2)
_SIDE = max(OFFSETS)
_BATCH = 1 << 13
_RARE_KEPT = 300_000
#: Counts are binned by this many steps a factor of two, to find the least count of a common word.
_STEPS = 32


@dataclass
class Vocabulary:
    """Ids in classes of ``width``: id // width is the class.

    Id 0 stands outside the text. Words of at least ``least`` occurrences have ids of their own; all others, whatever their
    number, share the last ``rare`` ids by the end of their spelling, and a share of their id's probability by their counts.
    """

    ids: dict[bytes, int]
    width: int
    size: int
    rare: int
    least: int
    counts: np.ndarray  # occurrences of each id in the corpus
    met: dict[bytes, int] = field(default_factory=dict)  # ids of common words and of rare ones met

    def encode(self, words: list[bytes]) -> np.ndarray:
        if not self.met or len(self.met) > len(self.ids) + _RARE_KEPT:
            self.met = dict(self.ids)
        ids = list(map(self.met.get, words))
        if None in ids:
            first, rare, met = self.size - self.rare, self.rare, self.met
            for i, known in enumerate(ids):
                if known is None:
                    w = words[i]
                    ids[i] = met[w] = first + zlib.crc32(w[-3:]) % rare
        return np.array(ids, np.int32)


def word_counts(docs: DataFrame, held: int = 300_000) -> DataFrame:
    """(word binary, n) over all texts: tasks count in memory, at most about ``held`` words at a time, and Spark adds up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(text.encode().split())
                if len(counts) > held:
                    yield flush()
        if counts:
            yield flush()

    parts = docs.select("text").mapInArrow(count, "word binary, n bigint")
    return materialise(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def _bucket(word: Column, rare: int) -> Column:
    """Which rare id a word belongs to, by its last three bytes."""
    n = F.octet_length(word)
    return F.pmod(F.crc32(F.when(n > 3, F.substring(word, n - 2, F.lit(3))).otherwise(word)), F.lit(rare)).cast("int")


def learn_vocabulary(words: DataFrame, size: int = 4096, rare: int = 512) -> Vocabulary:
    """Ids for the rows of ``word_counts``: words above the least count that leaves room for all of them get their own, in the order of
    their counts. To the driver go the histogram of counts (at most 64 * 32 bins), these words and the totals of rare ids."""
    width = int(round(size**0.5))
    assert width * width == size
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    room = size - 1 - rare
    least, taken = None, 0
    for r in sorted(words.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect(), key=lambda r: -r["bin"]):
        if taken + r["words"] > room:
            break
        least, taken = r["n"], taken + r["words"]
    common = F.col("n") >= least if least is not None else F.lit(False)
    top = sorted(words.where(common).collect(), key=lambda r: (-r["n"], bytes(r["word"])))
    totals = words.where(~common).groupBy(_bucket(F.col("word"), rare).alias("bucket")).agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    for i, r in enumerate(top):
        counts[i + 1] = r["n"]
    for r in totals:
        counts[size - rare + r["bucket"]] = r["n"]
    return Vocabulary({bytes(r["word"]): i + 1 for i, r in enumerate(top)}, width, size, rare, least if least is not None else 1 << 62, counts)


def new_network(vocabulary: Vocabulary, dim: int, seed: int) -> dict[str, np.ndarray]:
    """Small random weights; the biases are the log frequencies of classes, and of ids in them."""
    rng = np.random.default_rng(seed)
    size, width = vocabulary.size, vocabulary.width
    seen = (vocabulary.counts + 0.5).reshape(-1, width)
    embed = rng.normal(0, 0.1, (size, dim))
    embed[0] = 0
    net = {
        "embed": embed,
        "place": np.ones((len(OFFSETS), dim)),
        "class_w": rng.normal(0, 0.1, (dim, size // width)),
        "class_b": np.log(seen.sum(axis=1) / seen.sum()),
        "word_w": rng.normal(0, 0.1, (size // width, dim, width)),
        "word_b": np.log(seen / seen.sum(axis=1, keepdims=True)),
    }
    return {k: v.astype(np.float32) for k, v in net.items()}


def new_squares(net: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Running sums of squared gradients, which scale the steps."""
    return {k: np.full_like(v, 1e-4) for k, v in net.items()}


def _around(net: dict, ids: np.ndarray, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(vectors of the ids on either side, hidden layer): each side's vector counts by its place, then tanh of the sum."""
    sides = [net["embed"][ids[at + o]] for o in OFFSETS]
    return sides, np.tanh(sum(x * p for x, p in zip(sides, net["place"], strict=True)))


def _by_class(classes: np.ndarray, n: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """(order of positions by class, (class, from, to) in that order)."""
    order = np.argsort(classes.astype(np.uint16), kind="stable")
    ends = np.searchsorted(classes[order], np.arange(n + 1)).tolist()
    return order, [(c, a, b) for c, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]


def log_probabilities(net: dict, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """log P(class | both sides) + log P(id | class, both sides) at the places ``at`` of ``ids``, where texts have two zeros around."""
    _, h = _around(net, ids, at)
    classes, words = np.divmod(ids[at], net["word_b"].shape[1])
    scores = h @ net["class_w"] + net["class_b"]
    out = scores[np.arange(len(at)), classes] - np.log(np.exp(scores).sum(axis=1))
    order, groups = _by_class(classes, len(net["class_b"]))
    h, words, inner = h[order], words[order], np.empty(len(at), net["embed"].dtype)
    for c, a, b in groups:
        scores = h[a:b] @ net["word_w"][c] + net["word_b"][c]
        inner[a:b] = scores[np.arange(b - a), words[a:b]] - np.log(np.exp(scores).sum(axis=1))
    out[order] += inner
    return out


def train_step(net: dict, squares: dict, ids: np.ndarray, at: np.ndarray, rate: float) -> None:
    """One step of gradient descent scaled by running squares, on the masked places ``at``."""
    n = len(at)
    sides, h = _around(net, ids, at)
    classes, words = np.divmod(ids[at], net["word_b"].shape[1])

    def move(name: str, g: np.ndarray, rows=...) -> None:
        squares[name][rows] += g * g
        net[name][rows] -= rate * g / np.sqrt(squares[name][rows])

    p = np.exp(h @ net["class_w"] + net["class_b"])
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), classes] -= 1
    back = p @ net["class_w"].T
    order, groups = _by_class(classes, len(net["class_b"]))
    hs, words, inner = h[order], words[order], np.empty_like(back)
    for c, a, b in groups:
        q = np.exp(hs[a:b] @ net["word_w"][c] + net["word_b"][c])
        q /= q.sum(axis=1, keepdims=True)
        q[np.arange(b - a), words[a:b]] -= 1
        inner[a:b] = q @ net["word_w"][c].T
        move("word_w", hs[a:b].T @ q / n, c)
        move("word_b", q.sum(axis=0) / n, c)
    back[order] += inner
    back *= (1 - h * h) / n
    grads = np.concatenate([back * p for p in net["place"]])
    seen = np.concatenate([ids[at + o] for o in OFFSETS])
    move("class_w", h.T @ p / n)
    move("class_b", p.sum(axis=0) / n)
    move("place", np.stack([(back * x).sum(axis=0) for x in sides]))
    order = np.argsort(seen.astype(np.uint16), kind="stable") if len(net["embed"]) <= 1 << 16 else np.argsort(seen, kind="stable")
    starts = np.flatnonzero(np.diff(seen[order], prepend=-1))
    rows = seen[order[starts]]
    move("embed", np.add.reduceat(grads[order], starts, axis=0), rows)
    net["embed"][0] = 0


def _positions(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """(ids with zeros around each text, places of words, words of each text)."""
    pad = np.zeros(_SIDE, np.int32)
    words = [t.encode().split() if t else [] for t in texts]
    parts, at, begin = [pad], [np.empty(0, np.int64)], _SIDE
    for x in words:
        parts += [vocabulary.encode(x), pad]
        at.append(np.arange(begin, begin + len(x)))
        begin += len(x) + _SIDE
    return np.concatenate(parts), np.concatenate(at), words


def _learn(net: dict, squares: dict, texts: list[str | None], vocabulary: Vocabulary, rng: np.random.Generator, masked: float, rate: float, batch_size: int) -> int:
    """Train on a share ``1 / masked`` of the words of ``texts``, in random order; returns how many."""
    ids, at, _ = _positions(texts, vocabulary)
    at = at if masked <= 1 else at[rng.random(len(at)) < 1 / masked]
    rng.shuffle(at)
    for i in range(0, len(at), batch_size):
        train_step(net, squares, ids, at[i : i + batch_size], rate)
    return len(at)


def _chunks(texts: list, most: int = 1 << 20) -> Iterator[list]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > most:
            yield part
            part, size = [], 0
    if part:
        yield part


_BLOCK = 1 << 14
_KIND = "block int, n bigint, sums binary"


def _packed(n: int, flat: np.ndarray) -> pa.RecordBatch:
    parts = [flat[i : i + _BLOCK] for i in range(0, len(flat), _BLOCK)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary())], ["block", "n", "sums"])


def _unpacked(rows: list, shapes: dict) -> dict[str, np.ndarray]:
    flat = np.concatenate([np.frombuffer(r["sums"], np.float32) / np.float32(r["n"]) for r in rows])
    net, at = {}, 0
    for k, shape in shapes.items():
        n = int(np.prod(shape))
        net[k] = flat[at : at + n].reshape(shape)
        at += n
    return net


def first_network(docs: DataFrame, vocabulary: Vocabulary, dim: int = 16, sample_docs: int = 2000, longest: int = 20_000, passes: int = 2, rate: float = 0.2, seed: int = 7, batch_size: int = 2048) -> tuple[dict, dict]:
    """(network, its running squares) that every task starts from: trained in one task on every word of a bounded sample, ``passes`` times.

    The sample's bounds are these parameters: at most ``sample_docs`` documents of at most ``longest`` characters, by a hash of their
    ids. A threshold on that hash thins the rows where they are read.
    """
    net = new_network(vocabulary, dim, seed)
    squares = new_squares(net)
    shapes = {k: v.shape for k, v in net.items()}

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(seed)
        texts = [t for b in batches for t in b.column(0).to_pylist()]
        for _ in range(passes):
            for part in _chunks(texts):
                _learn(net, squares, part, vocabulary, rng, 1, rate, batch_size)
        yield _packed(1, np.concatenate([x[k].ravel() for x in (net, squares) for k in shapes]))

    scale, place = 1 << 30, F.xxhash64("doc_id", F.lit(2))
    share = min(scale, 2 * sample_docs * scale // max(docs.count(), 1))
    thinned = docs.where((F.char_length("text") <= longest) & (F.pmod(place, F.lit(scale)) < share)).select("text", place.alias("_place"), F.xxhash64("text").alias("_tie"))
    sample = thinned.orderBy("_place", "_tie").limit(sample_docs).select("text").coalesce(1)
    rows = sorted(sample.mapInArrow(learn, _KIND).collect(), key=lambda r: r["block"])
    if not rows:
        return net, squares
    found = _unpacked(rows, {(i, k): shape for i in range(2) for k, shape in shapes.items()})
    return {k: found[0, k] for k in shapes}, {k: found[1, k] for k in shapes}


def train(docs: DataFrame, vocabulary: Vocabulary, start: tuple[dict, dict], masked: float = 4, rate: float = 0.2, seed: int = 7, batch_size: int = 2048) -> dict[str, np.ndarray]:
    """The network trained on every text: each task goes on from ``start`` over its texts, masking one in ``masked`` words.

    Each task sends its weights, times its masked words; Spark adds them in two steps by block of weights, and the sums' averages
    are the network. The driver gets one network, whatever the input. As the start has learnt already and its running squares keep steps
    small, tasks stay near one another, and how rows are dealt to them matters little.
    """
    shapes = {k: v.shape for k, v in start[0].items()}
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, start))  # of a fixed size

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (net, squares) = sent.value
        net, squares = {k: v.copy() for k, v in net.items()}, {k: v.copy() for k, v in squares.items()}
        rng, n = np.random.default_rng(seed), 0
        for batch in batches:
            for part in _chunks(batch.column(0).to_pylist()):
                n += _learn(net, squares, part, words, rng, masked, rate, batch_size)
        if n:
            yield _packed(n, np.concatenate([net[k].ravel() for k in shapes]) * np.float32(n))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for b, n, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x = np.frombuffer(raw, np.float32)
                old = sums.get(b)
                sums[b] = [old[0] + n, old[1] + x] if old else [n, x]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v[0] for v in sums.values()], pa.int64()), pa.array([v[1].tobytes() for v in sums.values()], pa.binary())], ["block", "n", "sums"])

    parts = docs.select("text").mapInArrow(learn, _KIND)
    parts = parts.repartition(16, "block", F.spark_partition_id() % 16).mapInArrow(add, _KIND)  # many tasks' rows of a block in 16 heaps
    rows = parts.repartition(8, "block").mapInArrow(add, _KIND).orderBy("block").collect()
    return _unpacked(rows, shapes) if rows else start[0]


def score(docs: DataFrame, vocabulary: Vocabulary, net: dict[str, np.ndarray], words: DataFrame) -> DataFrame:
    """Rows (doc_id, n_tokens, sum_logprob, mean_logprob): every word of every whole text is predicted from both sides.

    A common word's probability is its id's; a rare word's is its id's times its count's share of all that id's words. Counts of
    rare words (``words``, the rows of ``word_counts``) are joined by a 64-bit hash, however many they are. A rare word is at most
    one in ``size`` - ``rare`` words of the corpus, so no key of that join is hot.

    Texts without words, null included, have 0 tokens, sum 0 and a null mean. Repeated rows give repeated rows; a null doc_id stays
    null; other columns are left out. Very long texts are predicted in batches.
    """
    spark = docs.sparkSession
    logs = np.log(np.maximum(vocabulary.counts, 1)).astype(np.float32)
    logs[: vocabulary.size - vocabulary.rare] = 0  # ids of their own have all of it
    sent = spark.sparkContext.broadcast((vocabulary, net, logs))  # of a fixed size: vocabulary and network do not grow with the input
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, known double, rare array<bigint>"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        vocabulary, network, shared = sent.value
        for batch in batches:
            n_all, sums, hashes, lengths = [], [], [], []
            for part in _chunks(batch.column(1).to_pylist()):
                ids, at, words = _positions(part, vocabulary)
                n = np.array([len(x) for x in words], np.int64)
                logs = [log_probabilities(network, ids, x) - shared[ids[x]] for x in (at[i : i + _BATCH] for i in range(0, len(at), _BATCH))]
                owner = np.repeat(np.arange(len(n)), n)
                sums.append(np.bincount(owner, np.concatenate(logs) if logs else np.empty(0), len(n)))
                n_all.append(n)
                is_rare = ids[at] >= vocabulary.size - vocabulary.rare
                lengths.append(np.bincount(owner[is_rare], minlength=len(n)))
                unknown = compress(chain.from_iterable(words), is_rare.tolist())
                hashes.append(np.fromiter((xxh64_intdigest(w, 42) for w in unknown), np.uint64, int(is_rare.sum())))
            if n_all:
                ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
                rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(hashes).view(np.int64), pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(n_all), pa.int64()), pa.array(np.concatenate(sums), pa.float64()), rare], ["doc_id", "n_tokens", "known", "rare"])

    scored = materialise(docs.select("doc_id", "text").mapInArrow(predict, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    # A word that occurs once has log count 0, so only the others are joined.
    counts = words.where((F.col("n") > 1) & (F.col("n") < F.lit(vocabulary.least))).groupBy(F.xxhash64("word").alias("_hash")).agg(F.ln(F.sum("n")).alias("_log"))
    met = scored.select("_row", F.explode("rare").alias("_hash")).join(counts.hint("merge"), "_hash")
    shares = met.groupBy(F.col("_row").alias("_of")).agg(F.sum("_log").alias("_shares"))
    total = F.col("known") + F.coalesce("_shares", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, total / F.col("n_tokens"))
    return scored.drop("rare").join(shares, F.col("_row") == F.col("_of"), "left").select("doc_id", "n_tokens", total.alias("sum_logprob"), mean.alias("mean_logprob"))


def pseudo_likelihood(docs: DataFrame, size: int = 4096, rare: int = 512, dim: int = 16) -> DataFrame:
    """Count the words of all of ``docs``, learn the network from them, then score each document. An empty table gives an empty table."""
    docs = docs.select("doc_id", "text")
    words = word_counts(docs)
    vocabulary = learn_vocabulary(words, size, rare)
    return score(docs, vocabulary, train(docs, vocabulary, first_network(docs, vocabulary, dim)), words)
