"""Every registered query equals its DuckDB oracle (exact values, any row order)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from soarcast import oracle

TABLES = ("lineitem", "events")


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


# the training-data queries have tests of their own
KEYS = sorted(oracle.QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _canon(df.columns, rows) == _canon(d_cols, res.fetchall())


def test_every_query_has_an_oracle():
    extra = set(E.queries()) - set(KEYS)
    assert set(KEYS) <= set(E.oracle_sql()) and all(k == "pipeline" or k.startswith("op") for k in extra)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["hour", "avg_cape", "avg_blh", "avg_wind", "avg_cloud_base", "flyable_pct",
                          "cape_rolling_avg", "blh_rolling_avg"]


def test_registry_needs_no_session():
    """The driver may list queries before it creates a session."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import __spark_entry__ as E; q = E.queries(); o = E.oracle_sql(); "
            "assert set(o) <= set(q) and len(q) >= 48")
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
