"""All queries of the operators, by id and name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from calado.plans import aggregate, catalogue, gate, graph, join, scalar, selection, sequence, sink, source, spatial, stream  # noqa: F401
from calado.plans._query import QUERIES, SQL


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
