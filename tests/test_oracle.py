"""Every registered query of the library against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest

from quillsieve import catalog

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        name = f.removesuffix(".parquet")
        c.execute(f"create view {name} as select * from '{SF}/{f}'")
    return c


def _rows(rows):
    clean = lambda x: round(x, 5) + 0.0 if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(clean(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(catalog.ORACLE[name])
    assert sorted(want.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    assert _rows(got.select(*columns).collect()) == _rows(con.sql(f"select {picked} from ({catalog.ORACLE[name]})").fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_query_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
