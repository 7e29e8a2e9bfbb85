"""How queries are registered: a name, a function of the tables, and SQL with the same result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder; ``t("orders")`` reads one, ``t.sql`` runs SQL that names tables in braces."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        names = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{n: self(n) for n in names})


def query(name: str, sql: str | None = None, **inputs: str):
    """Register ``f(t, input, ...)``. ``inputs`` are SELECTs that Spark and DuckDB read alike, with tables in braces;
    ``sql`` sees them as tables of these names."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = Tables(spark, sf_dir)
            return f(t, *[t.sql(text) for text in inputs.values()])

        QUERIES[name] = run
        if sql is not None:
            plain = {k: re.sub(r"\{(\w+)\}", r"\1", v) for k, v in inputs.items()}
            head = ", ".join(f"{k} AS ({v})" for k, v in plain.items())
            body = sql.strip()
            if head:
                begin = next((w for w in ("WITH RECURSIVE ", "WITH ") if body.upper().startswith(w)), "")
                body = f"{begin or 'WITH '}{head}{', ' if begin else ' '}{body[len(begin):]}"
            SQL[name] = body
        return f

    return register
