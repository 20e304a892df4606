"""Every query of the core against its SQL, row by row, on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from chronopitch.plans import catalog

DATA = "/root/testdata/sf0.001"
#: What SQL cannot say; each has a test of its own against brute force.
NO_SQL = {"p1_found", "p1_table", "p6_found", "calibration_promotion", "walk_forward_selection"}


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v + 0.0) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def oracle():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    db = duckdb.connect()
    db.execute("SET TimeZone='UTC'")
    for file in os.listdir(DATA):
        db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DATA}/{file}'")
    return db


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, oracle, name):
    df = catalog.QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(str([plain(r[c]) for c in columns]) for r in df.collect())
    if name not in catalog.ORACLE:
        assert name in NO_SQL and got
        return
    result = oracle.execute(catalog.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    assert got == sorted(str([plain(r[i]) for i in place]) for r in result.fetchall())
