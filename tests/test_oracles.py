"""Every query with SQL gives the rows that DuckDB gives."""

import math
import os

import duckdb
import pytest

from tessera.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    return tuple(map(norm, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return c


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no fixture tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    r = con.execute(catalogue.ORACLES[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(norm(x[names.index(c)]) for c in cols)) for x in r.fetchall())
    assert got == want
