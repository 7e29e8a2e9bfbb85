"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

from __future__ import annotations

import importlib
import math
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from calado.plans import registry

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parent.parent
QUERIES, SQL = registry.queries(), registry.oracle_sql()


LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    """A connection for each folder of tables."""
    found = {}
    for folder in (SF, LARGER):
        found[folder] = con = duckdb.connect()
        for name in os.listdir(folder):
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return found


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return str(bool(v))
    if isinstance(v, str):
        return v
    try:
        return float(v)
    except (TypeError, ValueError):
        return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: [(x is None, isinstance(x, str), f"{x:.4g}" if isinstance(x, float) else x or "") for x in r])


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    for folder in (SF, LARGER):  # the larger tables where the smallest give no rows, as that would show nothing
        found = duck[folder].execute(SQL[name])
        columns = [c[0] for c in found.description]
        want = rows(columns, found.fetchall())
        if want:
            break
    assert want, "a comparison without rows shows nothing"
    df = QUERIES[name](spark, folder)
    got = rows(df.columns, df.collect())
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b, rel=1e-6, abs=1e-6) if all(isinstance(x, float) for x in a) else all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-6, abs_tol=1e-6)) for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(5).collect()


def test_without_the_llm_folder(tmp_path):
    """The entry module imports and lists the other queries where the subpackage and the pipeline are gone."""
    import shutil

    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "calado", tmp_path / "calado", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_llm():
    for path in (ROOT / "calado").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
    assert importlib.util.find_spec("calado.plans")
