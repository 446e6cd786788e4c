"""Driver contract: entry, registered queries and oracle SQL (fast subset vs DuckDB at sf0.001)."""

import decimal
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = ["region", "nation", "customer", "orders", "events"]


def test_every_query_has_oracle_sql():
    from dailylake.catalog import REGISTRY
    from oracle_sql import ORACLE
    assert set(REGISTRY) == set(ORACLE) and len(REGISTRY) >= 48
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_llm_subpackage(tmp_path):
    """A copy without those folders still registers all other queries."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, env={**os.environ, "PYTHONPATH": "."})
    from dailylake.catalog import REGISTRY
    assert got.stdout.split()[-2:] == [str(len(REGISTRY))] * 2, got.stderr[-500:]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "is_temp_anomaly_5c" in df.columns


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", ["fact_daily", "mart_rolling", "bi_anomalies", "bi_weekly",
                                  "perf_country_daily", "q_report", "silver_dedup", "dim_location"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    s_rows = sorted(tuple(_norm(r[c]) for c in order) for r in sdf.collect())
    d_idx = [rel.columns.index(c) for c in order]
    d_rows = sorted(tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall())
    assert s_rows == d_rows
