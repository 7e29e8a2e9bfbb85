import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from calado.llm.packing import pack, pack_documents, token_pieces, two_fit_plan
from calado.llm.token_counts import count_tokens

ODD = ["Don't stop 'tis it's WE'LL x'd", "a<|endoftext|>b <|startoftext|> c", "Σας ΟΔΟΣ İstanbul éÅ ≠ x≠", "naïve ÅÄÖ ß÷×µª1º2½", "日本語 テスト　foo\xa0bar\x85baz\x1cqux", "“quoted” — dash…", "a\x00b\x0bc", "'", "''s's", " lead  two   three \n\n new \t tab ", "1st 2nd 3.14,15", "", None, "  \n ", "x" * 5000]


def texts():
    rnd = random.Random(3)
    letters = "aAbEé'ÉÿÞ×1 2,.!-<|>\n\tß\xa0\x85µΣσ“’  "
    return ODD + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))) for _ in range(2000)] + [" ".join(rnd.choice(ODD[0].split() + ["the", "of,", "Überßä"]) for _ in range(3000))]


def test_counts_as_the_library(spark):
    rows = list(enumerate(texts()))
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [len(e) for e in Tokenizer.from_file(path).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    got = {r["doc_id"]: r for r in count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, batch_bytes=1000).collect()}
    assert [got[i]["n_tokens"] for i, _ in rows] == want
    assert all(got[i]["n_bytes"] == len((t or "").encode()) and got[i]["over_limit"] == (want[i] > 512) for i, t in rows)


def test_counts_edges(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
    rows = count_tokens(spark.createDataFrame([(None, "a b", 1), (1, "a b", 2), (1, "a b", 2)], "doc_id long, text string, n_tokens int"), path).collect()
    assert [tuple(r) for r in rows] == [(None, 3, 2, False), (1, 3, 2, False), (1, 3, 2, False)]


def test_counts_of_long_texts(spark):
    """Longer than any batch: with spaces, which are split, and one line without any, which is not."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, " ".join(ODD[i % 4] for i in range(30_000))), (2, "".join(chr(0x4E00 + i % 977) for i in range(200_000))), (3, "QUJD" * 50_000)]
    want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False)) for _, t in rows]
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, batch_bytes=10_000).collect()}
    assert got == {i: (len(t.encode()), n, True) for (i, t), n in zip(rows, want, strict=True)}


def test_packing_round_trip(spark):
    rows = list(enumerate(texts())) + [(10_000 + i, "a") for i in range(50)]
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = [e.ids + [0] for e in Tokenizer.from_file(path).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    got = pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, with_ids=True).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for (i, _), want in zip(rows, ids, strict=True):
        parts = sorted(by[i], key=lambda r: r["piece"])
        assert sum((np.frombuffer(r["ids"], "<u4").tolist() for r in parts), []) == want
        assert [r["start"] for r in parts] == list(range(0, len(want), 2048)) and all(r["length"] == 2048 for r in parts[:-1])
        assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in parts)
    filled(got, 2048, sum(map(len, ids)))


def filled(rows, limit, total):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    assert len(sequences) <= -(-total // limit) * 1.05 + 2


@pytest.mark.parametrize("seed", range(4))
def test_pack_lengths(spark, seed):
    rnd = random.Random(seed)
    limit = 64
    lengths = [rnd.choice([1, 2, 31, 32, 33, 63, 64, rnd.randint(1, 64)]) if seed % 2 else max(1, min(64, int(rnd.expovariate(0.1)))) for _ in range(3000)]
    table = spark.createDataFrame([(i, 0, n, 0) for i, n in enumerate(lengths)], "doc_id long, piece int, length long, ids_crc32 long")
    rows = pack(table, limit, ranked_together=16).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3000))
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= limit
    assert len(sequences) == len(brute_two_fit(lengths, limit))


def brute_two_fit(lengths, limit):
    """The same rule, one document at a time, with the same sequence repeated while its lengths last."""
    left = sorted(lengths, reverse=True)
    out = []
    while left:
        fill, gap = [], limit
        rest = list(left)
        for x in list(rest):
            if x <= gap:
                fill.append(x)
                rest.remove(x)
                gap -= x
        if gap:
            room, best = gap + fill[-1], (fill[-1], None)
            distinct = sorted(set(rest))
            for a in distinct:
                for b in distinct:
                    if a + b <= room and a + b > best[0] and (a != b or rest.count(a) > 1):
                        best = (a + b, (a, b))
            if best[1]:
                fill[-1:] = list(best[1])
        times = min(left.count(x) // fill.count(x) for x in set(fill))
        for _ in range(times):
            out.append(fill)
            for x in fill:
                left.remove(x)
    return out


def test_two_fit_replaces():
    plan = two_fit_plan({60: 1, 30: 1, 25: 1, 14: 1}, 100)  # 60 + 30 leaves 10; 25 + 14 fills 39 of the 40 better
    first = {p[0] for p in plan if p[4] == 0}
    assert first == {60, 25, 14}


def test_packing_edges(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
    rows = pack_documents(spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2)], "doc_id long, text string, piece int"), path).collect()
    assert sorted((r["length"], r["ids_crc32"]) for r in rows) == [(1, zlib.crc32(b"\0\0\0\0"))] * 3
    assert token_pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"), path).columns == ["doc_id", "piece", "start", "length", "ids_crc32"]


def test_caches_are_bounded_by_bytes(spark, monkeypatch):
    """Small caches are emptied, pieces as long as a text are not kept, and counts and ids stay those of the library."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from calado.llm import packing, token_counts

    texts = ["a b c " * 50 + str(i) for i in range(60)] + ["字" * 5000, "x" * 3000 + " y", "字" * 5000, "<|endoftext|> é" * 9, "", "ÀB'c d"]
    byte, word = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    monkeypatch.setattr(token_counts, "_CACHE", 500)
    monkeypatch.setattr(packing, "_CACHE", 500)
    counter, encoder = token_counts._Counter(byte), packing._Encoder(word)
    plain = [Tokenizer.from_file(p) for p in (byte, word)]
    for i in range(0, len(texts), 4):
        assert counter.lengths(texts[i : i + 4]) == [len(plain[0].encode(t, add_special_tokens=False).ids) for t in texts[i : i + 4]]
        assert list(encoder.ids(texts[i : i + 4])) == [np.array(plain[1].encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts[i : i + 4]]
        assert all(len(x) <= 256 for x in [*counter.known, *encoder.runs, *encoder.chunks])
    assert sum(map(len, counter.known)) <= 2500 and max(encoder.held) <= 2500
