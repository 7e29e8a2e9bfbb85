"""Intake of landed receipts as a stream: repeats of a fingerprint are dropped, late files are accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calado.sources.sinks import merge_receipts

SCHEMA = "source string, fingerprint string, content string, stamp bigint"


def receipt_stream(spark: SparkSession, path: str) -> DataFrame:
    """Receipts landed as JSON lines, in whatever order files come; one row for each (source, fingerprint, content).

    State is one key for each receipt: receipts are append-only, so it must not be forgotten after a time.
    """
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 64).json(path).dropDuplicates(["source", "fingerprint", "content"])


def run_intake(spark: SparkSession, landed: str, accepted: str, conflicts: str, state: str) -> None:
    """Take in all that has landed: inserts are appended to ``accepted``, conflicts to ``conflicts``, repeats change nothing.

    Each batch writes under its number, so that a batch run again after a failure replaces itself.
    """
    kind = SCHEMA + ", batch bigint"

    def take(rows: DataFrame, batch: int) -> None:
        old = spark.read.schema(kind).parquet(accepted).where(F.col("batch") < batch) if batch else spark.createDataFrame([], kind)
        merged = merge_receipts(old, rows, ["source", "fingerprint"], "content", "stamp")
        met = rows.join(merged.drop("stamp"), ["source", "fingerprint"])
        parts = [("insert", accepted), ("conflict", conflicts)]
        for outcome, path in parts:
            found = met.where(F.col("outcome") == outcome).select("source", "fingerprint", "content", "stamp")
            found.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = receipt_stream(spark, landed).writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
