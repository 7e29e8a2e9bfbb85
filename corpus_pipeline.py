"""From raw documents to packed sequences: language ID, line dedup, near-dedup, mixing, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calado.llm import language_id, line_dedup, mixing, near_dedup, packing
from calado.llm._shared import remove, shared_folder


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not told apart clearly go; ``lang`` becomes the language found.

    Null text, and text without letters, is of no language, so it goes; so does a tie of two languages. Repeated rows have the same
    fate; a null doc_id or label is no reason to go. A table without labels has no languages, so nothing stays."""
    out = language_id.held_out(F.col("doc_id"))
    learned = language_id.language_dictionaries(docs.where(~out & F.col("lang").isNotNull()))
    found = language_id.label_language(docs, learned)
    return found.where("accepted").select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more share stay in one; documents left without a word go.

    Of documents that tie as holders of a line, rows of the largest doc_id keep it. Null text has no word. Repeated rows are one document."""
    kept = line_dedup.drop_shared_lines(docs).select(*docs.columns)
    return _measured(kept.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays: that of the least doc_id, null last."""
    return near_dedup.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those at the ends of a shard's run are cut.

    A null source is a source of its own; null or empty text has no words, so it is not taken. Repeated rows take part like any others;
    ties of seeded numbers go by id and text. An empty table gives an empty one."""
    return _measured(mixing.take_spans(mixing.mix_sources(docs, with_text=True)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, in as few sequences of 2,048 as best-two-fit finds: a row for each piece.

    Null text is empty and holds the end token alone. Repeated rows are packed each; a null doc_id stays null. Documents
    over 2,048 tokens are cut into pieces. An empty table gives an empty one."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [("language_id", identify), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies), ("mixing", mix), ("packing", pack)]

#: Compression, signatures and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's rows are written in the shared folder, and deleted once the next stage's are."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = f"{shared_folder(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if before:
            remove(spark, before)
        before = out
    return docs
