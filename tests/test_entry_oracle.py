"""Driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from citypulse.catalog import QUERIES
from conftest import SF_SMALL

TABLES = "region nation customer supplier orders events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def _canon(cols, rows):
    def r(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else f"{v:.6f}"
        return str(v)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(r(row[i]) for i in order) for row in rows)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Year", "Month", "Total Crimes", "#"]
    assert len(rows) > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_the_rest_imports_without_the_training_data_part(tmp_path):
    root = os.path.dirname(os.path.abspath(E.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(root, "citypulse"), copy / "citypulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), copy)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) == set(e.queries())"
    for left_behind in (False, True):       # also where the empty folder stays
        if left_behind:
            (copy / "citypulse" / "llm").mkdir()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert out.returncode == 0, out.stderr
        assert out.stdout.split() == sorted(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
