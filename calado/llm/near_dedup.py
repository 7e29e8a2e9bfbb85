"""Near-duplicate classes: ProbMinHash signatures, banding, and verification by probability Jaccard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calado.llm._shared import materialise

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


#: Bytes that part words.
_BLANK_BYTES = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def word_codes(text: bytes) -> np.ndarray:
    """A 64-bit code of each word: the mixed sum of its bytes' codes, each mixed with its place in the word."""
    data = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(~_BLANK_BYTES[data])
    if not len(at):
        return np.empty(0, _U)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    place = at - np.repeat(at[first], np.diff(first, append=len(at)))
    return _mix(np.add.reduceat(_mix((place.astype(_U) << _U(8)) + data[at] + _U(1)), first))


def shingles(text: str | None, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the windows of ``width`` words; a shorter text is one window; no words, no windows."""
    codes = word_codes(text.encode()) if text else np.empty(0, _U)
    if not len(codes):
        return codes, np.empty(0, np.int64)
    n = max(len(codes) - width + 1, 1)
    mixed = np.zeros(n, _U)
    for j in range(min(width, len(codes))):
        mixed = _mix(mixed + codes[j : j + n] + _U(j + 1))
    return np.unique(mixed, return_counts=True)


def prob_min_hash(codes: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The element that each of ``m`` registers keeps.

    Every element arrives as a Poisson process of its weight's rate, each arrival at a random register; a register keeps
    the element of its first arrival. Two sets keep the same element with their probability Jaccard similarity. An element
    stops when its next arrival is later than every register's; few elements go on beyond a round, so later rounds make several arrivals at once.
    """
    first = np.full(m, np.inf)
    kept = np.zeros(m, _U)
    each = max(1, -(-3 * m // len(codes)))
    live, rate, now, made = codes, weights.astype(np.float64), np.zeros(len(codes)), 0
    while len(live):
        k = np.arange(made + 1, made + each + 1, dtype=_U)
        draw = _mix(live[:, None] + k[None, :] * _U(0x9E3779B97F4A7C15))
        wait = -np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)
        times = now[:, None] + np.cumsum(wait, axis=1) / rate[:, None]
        register = (_mix(draw) % _U(m)).astype(np.int64)
        at, t, who = register.ravel(), times.ravel(), np.repeat(live, each)
        last = first.max()
        if last < np.inf:
            soon = t < last
            at, t, who = at[soon], t[soon], who[soon]
        np.minimum.at(first, at, t)
        won = t == first[at]
        kept[at[won]] = who[won]
        going = times[:, -1] < first.max()
        live, rate, now, made = live[going], rate[going], times[going, -1], made + each
        each = max(4, each)
    return kept


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over shared elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i). Without repeats it is the Jaccard similarity."""
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 1.0 if not len(a[0]) and not len(b[0]) else 0.0
    if a[1].max() == 1 and b[1].max() == 1:
        return len(common) / (len(a[0]) + len(b[0]) - len(common))
    # With elements by the ratio of their weights, each sum is a prefix of b / b_i and a suffix of a / a_i.
    wa, wb = a[1][ia].astype(float), b[1][ib].astype(float)
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    upper_b, lower_a = np.cumsum(wb), np.cumsum(wa[::-1])[::-1]
    # For j before i in that order, a_j / a_i is at most b_j / b_i; after it, at least.
    total = (upper_b + only_b) / wb + (np.append(lower_a[1:], 0.0) + only_a) / wa
    return float((1.0 / total).sum())


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A long for a row's id and text: rows that repeat both share it, others differ; nulls count as values."""
    given = lambda x: F.coalesce(F.concat(F.lit("="), F.col(x).cast("string")), F.lit(""))
    return F.xxhash64(given(doc_id), given(text))


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """Rows (_id, _key, _digest, _bands array<bigint>, _registers binary) of every whole text.

    Texts with the same words in the same order have the same digest; texts without words have no bands.
    """
    schema = f"_id {docs.schema['doc_id'].dataType.simpleString()}, _key bigint, _digest binary, _bands array<bigint>, _registers binary"
    scale = _mix(np.arange(1, rows + 1, dtype=_U)) | _U(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, keys, registers = [], [], []
            for text in batch.column(2).to_pylist():
                digests.append(hashlib.blake2b(b" ".join(text.encode().split()) if text else b"", digest_size=16).digest())
                codes, counts = shingles(text, width)
                if not len(codes):
                    keys.append([])
                    registers.append(b"")
                    continue
                kept = prob_min_hash(codes, counts, bands * rows)
                band = _mix((kept.reshape(bands, rows) * scale).sum(axis=1, dtype=_U) + np.arange(bands, dtype=_U))
                keys.append(band.astype(np.int64))
                registers.append((kept & _U(0xFFFF)).astype("<u2").tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(registers, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_key", "_digest", "_bands", "_registers"])

    return docs.select("doc_id", row_key(), "text").mapInArrow(sign, schema)


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node of each component, for the nodes of ``edges``, by large-star and small-star rounds."""
    edges = materialise(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("n", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("n")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(small_least, F.col("u") == F.col("n"))
        nxt = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least.select(F.col("n").alias("u"), F.col("m").alias("v")))
        edges = materialise(nxt.where("u <> v").distinct(), "edges")
        now = tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def _alike(pairs: DataFrame, registers: DataFrame, least: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose registers agree in a share of at least ``least``."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(batch.num_rows, -1) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= least, pa.bool_()))

    ra = registers.select(F.col("_id").alias("a"), F.col("_registers").alias("_ra"))
    rb = registers.select(F.col("_id").alias("b"), F.col("_registers").alias("_rb"))
    return pairs.join(ra, "a").join(rb, "b").select("a", "b", "_ra", "_rb").mapInArrow(check, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose texts are similar enough."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                good.append(probability_jaccard(shingles(x, width), shingles(y, width)) >= similarity)
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    ta = texts.select(F.col("_id").alias("a"), F.col("_text").alias("_ta"))
    tb = texts.select(F.col("_id").alias("b"), F.col("_text").alias("_tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "_ta", "_tb").mapInArrow(check, "a bigint, b bigint")


def links_of_block(sets: list, root: np.ndarray, left: np.ndarray, right: np.ndarray, similarity: float, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of similar sets, i from ``left`` and j from ``right``, one pair for each two different roots.

    Common elements are counted for all pairs at once, as products of 0/1 matrices of ``columns`` elements at a time.
    Sets without repeats are decided by those counts. With repeats, a pair's similarity is at most the share of either
    one's weight that is common; pairs where both shares reach the bound are computed.
    """
    n = len(sets)
    size = np.array([len(c) for c, _ in sets])
    plain = np.array([w.max(initial=1) == 1 for _, w in sets])
    owner = np.repeat(np.arange(n), size)
    share = np.concatenate([w / max(w.sum(), 1) for _, w in sets])
    _, code = np.unique(np.concatenate([c for c, _ in sets]), return_inverse=True)
    often = np.bincount(code)[code] > 1
    owner, share, code = owner[often], share[often], code[often]
    order = np.argsort(code, kind="stable")
    owner, share = owner[order], share[order]
    code = np.cumsum(np.diff(code[order], prepend=code[order][:1]) > 0) if len(order) else code
    common, held = np.zeros((n, n), np.float32), np.zeros((n, n), np.float32)
    repeats = not plain.all()
    for at in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, (at, at + columns))
        ones = np.zeros((n, min(columns, int(code[-1]) + 1 - at)), np.float32)
        ones[owner[a:b], code[a:b] - at] = 1
        common += ones @ ones.T
        if repeats:
            weights = np.zeros_like(ones)
            weights[owner[a:b], code[a:b] - at] = share[a:b]
            held += weights @ ones.T
    jaccard = common / np.maximum(size[:, None] + size[None, :] - common, 1)
    good = plain[:, None] & plain[None, :] & (jaccard >= similarity - 1e-6)
    if repeats:
        good |= ~(plain[:, None] & plain[None, :]) & (np.minimum(held, held.T) >= similarity - 1e-4)
    good &= left[:, None] & right[None, :] & (root[:, None] != root[None, :])
    i, j = np.nonzero(good)
    exact = np.array([(plain[x] and plain[y]) or probability_jaccard(sets[x], sets[y]) >= similarity for x, y in zip(i, j, strict=True)], bool)
    i, j = i[exact], j[exact]
    _, first = np.unique(np.stack([np.minimum(root[i], root[j]), np.maximum(root[i], root[j])]), axis=1, return_index=True)
    return i[first], j[first]


def may_link(registers: Iterable[bytes], root: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> np.ndarray:
    """Which texts, of a pair (i from ``left``, j from ``right``) with different roots, agree in a share of at least ``least`` of their registers."""
    kept = np.frombuffer(b"".join(registers), "<u2").reshape(len(root), -1)
    found, others = np.zeros(len(root), bool), np.flatnonzero(right)
    for i in np.flatnonzero(left):
        same = others[((kept[others] == kept[i]).mean(axis=1) >= least) & (root[others] != root[i])]
        found[same] = True
        found[i] |= len(same) > 0
    return found


def near_classes(
    docs: DataFrame, width: int = 5, similarity: float = 0.8, bands: int = 25, rows: int = 5, slack: float = 0.16, block: int = 256
) -> DataFrame:
    """Rows (_id, _key, class_id, keeper), one for each row of ``docs``: its id and ``row_key``, the least doc_id of its class, and the
    key of a row with that id.

    Documents are linked if the probability Jaccard similarity of their windows of ``width`` words, weighted by count, is
    ``similarity`` or more; classes are what links connect. Texts with the same words are one class; texts with fewer
    than ``width`` words are one window; texts without words, null included, are one class. Rows are told apart by id and
    text, so repeated ids with different texts and null ids have classes like any others; the class_id of a class without an id is null.
    Repeated rows give repeated rows. An empty table gives an empty one.

    Every pair of different texts that shares one of ``bands`` bands of ``rows`` registers is either connected already or
    compared. At similarity 0.8 a pair misses all of 25 bands of 5 with probability 5e-5.
    1. Bands with one text go. Each text's density is the sum of its bands' sizes; each band's densest text leads it.
    2. Texts are verified against the leaders of their bands, if their registers agree to within ``slack`` of the similarity.
    3. In bands with texts of several components, texts of different components are compared ``block`` by block: by their registers,
       and those whose registers agree with one of another component's to within ``slack`` exactly. At similarity 0.8 registers
       agree less than that with probability 1e-5.
    """
    signed = materialise(signatures(docs, width, bands, rows), "signatures")
    # A different text is a node, whose number is a hash of its digest; its first row has the least id, null last.
    least = F.min(F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_key").alias("key")))
    first = materialise(signed.groupBy(F.col("_digest").alias("_of")).agg(least.alias("_first")).withColumn("_rep", F.xxhash64("_of")), "first")
    reps = signed.join(first.select("_of", "_rep", F.col("_first.key").alias("_row")), (F.col("_digest") == F.col("_of")) & (F.col("_key") == F.col("_row")))
    reps = materialise(reps.select("_rep", "_bands", "_registers").dropDuplicates(["_rep"]), "reps")

    banded = reps.select("_rep", F.explode("_bands").alias("_key"))
    sizes = banded.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    banded = materialise(banded.join(sizes, "_key"), "banded")
    density = banded.groupBy("_rep").agg(F.sum("_n").alias("_density"))
    weighed = materialise(banded.join(density, "_rep").select("_key", "_rep", "_density"), "weighed")
    leaders = materialise(weighed.groupBy("_key").agg(F.max(F.struct("_density", "_rep")).alias("_lead")), "leaders")
    stars = weighed.join(leaders, "_key").select(F.col("_rep").alias("a"), F.col("_lead._rep").alias("b")).where("a <> b").distinct()

    members = weighed.select(F.col("_rep").alias("_id")).distinct()
    registers = materialise(reps.select(F.col("_rep").alias("_id"), "_registers").join(members, "_id", "left_semi"), "registers")
    # Candidates are a share of all documents, so this join is a shuffle at every size.
    wanted = first.join(members, F.col("_rep") == F.col("_id")).select("_id", F.col("_first.key").alias("_row"))
    texts = docs.select(row_key().alias("_key"), F.col("text").alias("_text")).join(wanted.hint("shuffle_hash"), F.col("_key") == F.col("_row"))
    texts = materialise(texts.select("_id", "_text").dropDuplicates(["_id"]), "texts")

    close = materialise(_alike(stars, registers, similarity - slack), "close")
    links = materialise(_verified(close, texts, width, similarity), "links")
    roots = connected(links, "a", "b")

    def rooted(df: DataFrame, column: str, name: str) -> DataFrame:
        met = df.join(roots.select(F.col("node").alias("_node"), F.col("root").alias("_root")), F.col(column) == F.col("_node"), "left")
        return met.withColumn(name, F.coalesce("_root", column)).drop("_node", "_root")

    here = materialise(rooted(weighed.select("_key", "_rep"), "_rep", "_root_id"), "rooted")
    mixed = here.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("_root_id").alias("_low"), F.max("_root_id").alias("_high")).where("_low < _high").select("_key", "_n")
    n = F.ceil(F.col("_n") / block).cast("int")
    left = here.join(materialise(mixed, "mixed"), "_key").withColumn("_mine", F.pmod(F.xxhash64("_rep"), n).cast("int"))
    left = left.withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1)))
    left = left.select("_key", "_rep", "_root_id", "_mine", F.least("_mine", "_other").alias("_lo"), F.greatest("_mine", "_other").alias("_hi"))
    pair = ["_key", "_lo", "_hi"]

    def likely(group: pd.DataFrame) -> pd.DataFrame:
        root, mine = group["_root_id"].to_numpy(), group["_mine"].to_numpy()
        found = may_link(group["_registers"], root, mine == group["_lo"].iat[0], mine == group["_hi"].iat[0], similarity - slack)
        return group.loc[found, [*pair, "_rep", "_root_id", "_mine"]]

    # Most texts of a pair of blocks agree with none of the other components; only the rest are fetched, with one row a text.
    held = left.join(registers.withColumnRenamed("_id", "_of_rep"), F.col("_rep") == F.col("_of_rep")).drop("_of_rep")
    left = held.groupBy(*pair).applyInPandas(likely, "_key bigint, _lo int, _hi int, _rep bigint, _root_id bigint, _mine int")
    left = materialise(left, "likely").join(texts, F.col("_rep") == F.col("_id"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        ids, root, mine = group["_rep"].to_numpy(), group["_root_id"].to_numpy(), group["_mine"].to_numpy()
        i, j = links_of_block([shingles(t, width) for t in group["_text"]], root, mine == group["_lo"].iat[0], mine == group["_hi"].iat[0], similarity)
        return pd.DataFrame({"a": ids[i], "b": ids[j]})

    more = materialise(left.groupBy(*pair).applyInPandas(compare, "a bigint, b bigint"), "more")
    if more.limit(1).count():
        roots = connected(links.union(more), "a", "b")

    # The class's first row: the least of its nodes' first rows.
    members = roots.union(roots.select("root", "root").distinct())
    met = first.select("_rep", "_first").join(members, F.col("_rep") == F.col("node"))
    heads = met.groupBy(F.col("root").alias("_head")).agg(F.min("_first").alias("_least"))
    classes = rooted(first, "_rep", "_class").join(heads, F.col("_class") == F.col("_head"), "left")
    classes = materialise(classes.select("_of", F.coalesce("_least", "_first").alias("_least")), "classes")
    done = signed.join(classes, F.col("_digest") == F.col("_of"))
    return done.select("_id", "_key", F.col("_least.id").alias("class_id"), F.col("_least.key").alias("keeper"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Rows (doc_id, class_id): see ``near_classes`` for what links documents and for its ``options``."""
    return near_classes(docs, **options).select(F.col("_id").alias("doc_id"), "class_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: the one with the least doc_id, null last; of rows that repeat id and text the first by the other
    columns. Other columns stay as they are."""
    kept = near_classes(docs, **options).select(F.col("keeper").alias("_keeper")).distinct()
    rows = docs.withColumn("_row_key", row_key()).join(kept, F.col("_row_key") == F.col("_keeper"), "left_semi")
    order = Window.partitionBy("_row_key").orderBy(*[F.to_json(F.struct(F.col(c))) if c not in ("doc_id", "text") else F.lit(0) for c in docs.columns])
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").select(*docs.columns)
