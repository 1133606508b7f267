"""Every query against its SQL on the smallest tables."""

import importlib.util
import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
import check  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert importlib.util.find_spec("bench") is not None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    got = check.canonical(df.columns, df.collect())
    if name in oracle_sql():
        cursor = con.execute(oracle_sql()[name])
        want = check.canonical([d[0] for d in cursor.description], cursor.fetchall())
        assert got[0] == want[0]
        assert len(got[1]) == len(want[1])
        assert got[1] == want[1]
    else:
        assert got[1]
