"""Lengths of connectors, over many rows at once."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from calado.functions import geometry as G


def test_many_lengths_at_once(spark):
    ends = [((F.lit(0.0), F.lit(0.0))), (F.col("id") * 1.0, F.col("id") * 2.0), (F.lit(30.0), F.lit(0.0)), (F.lit(0.0), F.when(F.col("id") != 7, F.lit(30.0)))]
    rows = spark.range(9000).select("id", G.quintic_length(*ends).alias("length"))
    assert "zip_with" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: r["length"] for r in rows.collect()}
    t = np.arange(201) / 200
    h = [t - 6 * t**3 + 8 * t**4 - 3 * t**5, 10 * t**3 - 15 * t**4 + 6 * t**5, -4 * t**3 + 7 * t**4 - 3 * t**5]
    for i in (0, 1, 6, 4095, 4096, 8999):
        x, y = h[0] * 30 + h[1] * i, h[1] * 2 * i + h[2] * 30
        assert got[i] == pytest.approx(np.hypot(np.diff(x), np.diff(y)).sum())
    assert got[7] is None
