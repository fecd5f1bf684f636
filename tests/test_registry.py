"""Every registered query runs at sf0.001 and matches its DuckDB oracle."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import canon, duck  # noqa: E402

from strata.registry import REGISTRY  # noqa: E402

EVERY = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", EVERY)
def test_query_matches_oracle(spark, sf_dir, con, name):
    q = REGISTRY[name]
    df = q.run(spark, sf_dir)
    scols, srows = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(q.sql)
    dcols, drows = canon([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert srows == drows


def test_entry_contract():
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert "daily_kpis" in e.queries()
