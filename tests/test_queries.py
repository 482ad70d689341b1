"""Every query of the library against its SQL, on the smallest tables."""

import decimal
import glob
import math
import os

import duckdb
import pytest

from sparkloom.plans import queries as Q
from sparkloom.plans import more_queries, wide_queries  # noqa: F401  (they register their queries)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.exists(SF):
        pytest.skip("test data isn't here")
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


#: These need more rows than the smallest tables have.
LARGE = {"q_cluster_alloc", "q_leak_audit"}


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n in Q.ORACLE])
def test_same_as_sql(spark, duck, name):
    sf = SF
    if name in LARGE and duck.sql("SELECT count(DISTINCT conv_id) FROM conversations").fetchall()[0][0] < 30:
        pytest.skip("too few conversations")
    df = Q.QUERIES[name](spark, sf)
    names = sorted(df.columns)
    rel = duck.sql(Q.ORACLE[name])
    at = [rel.columns.index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert sorted(rel.columns) == names
    assert sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr) == want
