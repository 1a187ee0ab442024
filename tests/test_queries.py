"""Every registered query runs, and gives the rows of its SQL where there is one."""

import glob
import os

import duckdb
import pytest

from panelloom.plans import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = ordered(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert rows
    if name in ORACLES:
        result = duck.execute(ORACLES[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        want = ordered(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
        assert rows == want


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark, duck):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 5
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
