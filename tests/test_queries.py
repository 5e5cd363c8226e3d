"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from millrace import plans
from millrace.sources.tables import TEST_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["region", "customer_name", "total_revenue", "rn"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(plans.oracle()) == set(plans.registry())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(plans.registry()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _bag(df.columns, df.collect()) == _bag(d_cols, cur.fetchall())


def test_entry_module_imports_without_a_session():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.path.insert(0, %r); import __spark_entry__ as E; "
            "assert set(E.oracle_sql()) <= set(E.queries())" % root)
    subprocess.run([sys.executable, "-c", code], check=True, cwd="/", timeout=120)
