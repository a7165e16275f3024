"""Every registered query against its DuckDB statement on the smallest fixture."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert type_mismatches(df.schema, cur.description) == {}
    assert len(rows) == len(orows)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "corporate_id" in df.columns
