"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calado.llm import fingerprints, hard_negatives, html_text, language_id, line_dedup, lm_scoring, mixing, near_dedup, packing, personal_data, quality_rules, resampling, token_counts
from calado.llm._shared import read


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    out = language_id.held_out(F.col("doc_id"))
    learned = language_id.language_dictionaries(docs.where(~out & F.col("lang").isNotNull()))
    return language_id.identify_language(docs, learned).withColumn("held_out", out)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read(spark, sf_dir, "pages"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read(spark, sf_dir, "documents"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(read(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_ranks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(read(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", noisy))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corpus_pipeline import run

    ops = [op1_language_id, op2_html_extraction, op3_document_fingerprints, op4_lm_scoring, op5_token_counts, op6_quality_rules, op7_best_fit_packing, op8_minhash_near_dedup, op9_source_mixing, op10_line_dedup, op11_importance_resampling, op12_personal_data, op13_hard_negatives]
    return {f.__name__: f for f in ops} | {"pipeline": run}


_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP10 = f"""
WITH lines AS (
  SELECT doc_id, text, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id IS DISTINCT FROM s.keeper AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _scatter(x: str, seed: int) -> str:
    """``mixing._scatter`` in SQL."""
    m, a = mixing.PRIME, mixing.STEP
    start = f"((coalesce({x}, -1) % {m} + {m}) % {m})"
    once = f"(({start} * {a} + {seed}) % {m})"
    return f"((({once} + ({once} >> 15)) * {a}) % {m})"


_SEED, _BLOCK, _SHARD = 20240601, 16, 1 << 18
_BEFORE, _AFTER = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"

_OP9 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), src AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS cap
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source)
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST {_BEFORE}), 0))
    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST {_AFTER}) AS level FROM src
), targets AS (
  SELECT source, source_size, least(cap, coalesce(max(CASE WHEN level <= cap / w THEN level END) OVER (), 'inf'::DOUBLE) * w) AS target FROM levels
), seats AS (
  SELECT *, CAST(round(sum(target) OVER () / {_BLOCK}) AS BIGINT) AS seats, sum(target) OVER () AS whole, count(*) OVER () AS n FROM targets
), blocks AS (
  SELECT source, count(*) AS blocks FROM (
    SELECT source, seats, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST) AS i
    FROM (SELECT *, unnest(range(1, CAST(seats * target / whole AS BIGINT) + n + 2)) AS k FROM seats WHERE target > 0)
  ) WHERE i <= seats GROUP BY source
), wide AS (
  SELECT t.*, coalesce(b.blocks, 0) AS blocks, greatest(CAST(ceil(source_size / {_SHARD}) AS BIGINT), 1) AS shards
  FROM targets t LEFT JOIN blocks b ON t.source IS NOT DISTINCT FROM b.source
), dealt AS (
  SELECT d.*, w.source_size, w.target, w.blocks, {_scatter('doc_id', _SEED)} % w.shards AS shard, {_scatter('doc_id', _SEED + 1)} AS place
  FROM sized d JOIN wide w ON d.source IS NOT DISTINCT FROM w.source
), parts AS (
  SELECT source, shard, sum(size) AS words, first(blocks) AS seats FROM dealt GROUP BY source, shard
), tried AS (
  SELECT *, sum(words) OVER (PARTITION BY source) AS whole, count(*) OVER (PARTITION BY source) AS n FROM parts
), quotas AS (
  SELECT source, shard, count(*) AS quota FROM (
    SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY words / (2 * k - 1) DESC, shard) AS i
    FROM (SELECT *, unnest(range(1, CAST(seats * words / whole AS BIGINT) + n + 2)) AS k FROM tried WHERE words > 0)
  ) WHERE i <= seats GROUP BY source, shard
), runs AS (
  SELECT p.source, p.shard, CAST(ceil(words / {_BLOCK}) AS BIGINT) AS n, least(coalesce(quota, 0), 2 * CAST(ceil(words / {_BLOCK}) AS BIGINT)) AS quota
  FROM parts p LEFT JOIN quotas q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
), spans AS (
  SELECT *, CASE WHEN n > 0 THEN {_scatter('shard', _SEED + 2)} % n ELSE 0 END AS first_, CASE WHEN n > 0 THEN quota % n ELSE 0 END AS more FROM runs
), laid AS (
  SELECT *, sum(size) OVER (PARTITION BY source, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS end_ FROM dealt
)
SELECT l.doc_id, l.size, l.source_size, l.target, CAST(CASE WHEN l.size = 0 THEN 0 ELSE l.size * (quota // n)
  + greatest(0, least(least(first_ + more, n) * {_BLOCK}, end_) - greatest(first_ * {_BLOCK}, end_ - l.size))
  + greatest(0, least((first_ + more - n) * {_BLOCK}, end_) - (end_ - l.size)) END AS BIGINT) AS taken
FROM laid l JOIN spans s ON l.source IS NOT DISTINCT FROM s.source AND l.shard = s.shard
"""


_TO_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP11_WORDS = "regexp_extract_all(" + _TO_LOWER.format("coalesce(text, '')") + r", '[0-9a-z\x{80}-\x{10FFFF}]+')"

_OP11 = f"""
WITH crcs AS (  -- the reflected polynomial, eight bits at once
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS bytes FROM range(256) r(b)
), said AS (
  SELECT doc_id, NULL AS item_id, {_OP11_WORDS} AS words FROM documents UNION ALL SELECT NULL, item_id, {_OP11_WORDS} FROM benchmark
), used AS (
  SELECT word, count(*) FILTER (item_id IS NULL) AS s, count(*) FILTER (item_id IS NOT NULL) AS t FROM (SELECT item_id, unnest(words) AS word FROM said) GROUP BY word
), hashed AS (
  SELECT word, s, t, xor(list_reduce(list_transform(range(octet_length(encode(word))), lambda i: CAST('0x' || substr(hex(encode(word)), 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, crcs.bytes[CAST(xor(c & 255, b) AS BIGINT) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM used, crcs
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((sum(t) + 1)::DOUBLE * (sum(sum(s)) OVER () + 10000)::DOUBLE / ((sum(s) + 1)::DOUBLE * (sum(sum(t)) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM hashed GROUP BY bucket
), means AS (
  SELECT doc_id, count(*) AS n, sum(gain) AS total FROM (SELECT doc_id, unnest(words) AS word FROM said WHERE item_id IS NULL) JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(CAST(floor(total::DOUBLE / n) AS BIGINT), 0) AS weight,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('2024:' || d.doc_id), 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS luck
  FROM documents d LEFT JOIN means USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY weight + luck DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, weight + luck AS score, CASE WHEN r <= (10 * n) // 100 THEN r END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""


_OP13 = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    from corpus_pipeline import ORACLE_SQL

    return {"op9_source_mixing": _OP9, "op10_line_dedup": _OP10, "op11_importance_resampling": _OP11, "op13_hard_negatives": _OP13} | ({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})
