"""Language by compression: the language whose dictionary makes a text smallest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo 4, is 2. Null ids are not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _plain(text: str | None) -> str:
    """Lower-case runs of letters with one space between."""
    return " ".join(_LETTERS.findall(text.lower())) if text else ""


def language_dictionaries(labelled: DataFrame, dict_bytes: int = 1 << 16, sample_docs: int = 400, longest: int = 20_000) -> list[tuple[str, bytes]]:
    """(language, raw-content dictionary), the languages with most rows first.

    ``labelled`` has doc_id, text and lang. The bounds of the sample are these parameters: for each language the whole texts of
    at most ``sample_docs`` documents in the order of a hash of their id, of those with at most ``longest`` characters,
    as far as ``dict_bytes`` goes. Rows with null text or lang are left out. A threshold on that hash, by each language's
    number of rows, thins the rows where they are read, so that what is ranked does not grow with the input.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "doc_id", "text", (F.char_length("text") <= longest).alias("_fits"))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if("_fits").alias("fits")).collect()
    counts = {r["lang"]: r["n"] for r in found}
    if not counts:
        return []
    scale = 1 << 30
    limit = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(scale, 2 * sample_docs * scale // max(r["fits"], 1)))])
    place = F.xxhash64("doc_id", F.lit(1))
    thinned = rows.where(F.col("_fits") & (F.pmod(place, F.lit(scale)) < limit[F.col("lang")]))
    order = Window.partitionBy("lang").orderBy(place, "doc_id", F.xxhash64("text"))
    sample = thinned.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample_docs)
    texts: dict[str, list[str]] = {}
    for r in sample.orderBy("lang", "_rank").toLocalIterator():
        texts.setdefault(r["lang"], []).append(_plain(r["text"]))
    learned = []
    for lang in sorted(texts, key=lambda x: (-counts[x], x)):
        # The content nearest the end is cheapest to refer to; the dictionary's end is its start of the sample.
        content = b" ".join(t.encode() for t in reversed(texts[lang]))[-dict_bytes:]
        if len(content) >= 8:
            learned.append((lang, content))
    return learned


_ADDED = {"lang_pred": "string", "score": "double", "margin": "double", "accepted": "boolean"}


def label_language(docs: DataFrame, dictionaries: list[tuple[str, bytes]], chunk: int = 8192, short: int = 1024, margin: float = 0.01, doubt: float = 0.05, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred, score, margin and accepted for every whole text.

    Each text's letters, in lower case, are compressed in chunks of about ``chunk`` characters with each language's
    dictionary, texts of up to ``short`` characters with a closer search; sizes are added over the whole text, less that of an
    empty frame. The smallest total wins; at a tie
    the language with more labelled rows. ``margin`` is how much larger the next is, as a share of the smallest;
    texts below the parameter ``margin`` are not accepted. ``score`` (0 to 1) is the winner's share of
    exp(-size / (doubt * smallest size)). Null text, text without letters and an empty list of dictionaries give
    ``und``, score 0, not accepted. Only the text is read for a prediction; columns that clash with the added ones are
    replaced. Repeated rows give repeated rows; an empty table an empty one.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in _ADDED]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def coder(content: bytes, **search) -> tuple:
            plain = zstandard.ZstdCompressionParameters(window_log=18, hash_log=16, chain_log=17, write_content_size=False, write_dict_id=False, **search)
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=plain)
            made = zstandard.ZstdCompressor(dict_data=raw, compression_params=plain)
            return made, len(made.compress(b""))

        def coders(**search) -> list:
            return [(lang, *coder(content, **search)) for lang, content in dictionaries]

        fast = coders(strategy=zstandard.STRATEGY_LAZY, search_log=3, min_match=4)
        careful = coders(strategy=zstandard.STRATEGY_BTLAZY2, search_log=4, min_match=3)

        def best(text: str | None) -> tuple[str, float, float, bool]:
            plain = _plain(text)
            if not plain or not dictionaries:
                return UNKNOWN, 0.0, 0.0, False
            parts = [plain[i : i + chunk].encode() for i in range(0, len(plain), chunk)]
            sizes = [(sum(len(c.compress(p)) - empty for p in parts), k, lang) for k, (lang, c, empty) in enumerate(careful if len(plain) <= short else fast)]
            sizes.sort()
            least = max(sizes[0][0], 1)
            weight = sum(math.exp(-(n - sizes[0][0]) / (doubt * least)) for n, _, _ in sizes)
            apart = (sizes[1][0] - sizes[0][0]) / least if len(sizes) > 1 else 1.0
            return sizes[0][2], 1 / weight, apart, apart >= margin

        for rows in batches:
            found = [best(t) for t in rows.column(rows.num_columns - 1).to_pylist()]
            if found:
                columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(i) for i in range(len(keep))] + columns, [*keep, *_ADDED])

    read = docs.select(*keep, F.col("text").alias("_text"))
    return read.mapInArrow(identify, ", ".join(fields + [f"{k} {v}" for k, v in _ADDED.items()]))


def identify_language(docs: DataFrame, dictionaries: list[tuple[str, bytes]], **options) -> DataFrame:
    """Rows (doc_id, lang_pred, score, margin, accepted); see ``label_language``."""
    return label_language(docs, dictionaries, keep=["doc_id"], **options)
