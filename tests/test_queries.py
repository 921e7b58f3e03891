"""Every registered query against its SQL on the driver's tables."""

import math
import os

import duckdb
import pytest

from longtrace import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def cell(x):
        if isinstance(x, float):
            return None if math.isnan(x) else round(x, 4) + 0.0
        if isinstance(x, (list, tuple)):
            return tuple(cell(y) for y in x)
        return x

    return sorted((tuple(cell(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = plain([tuple(r) for r in df.collect()], df.columns)
    assert got, "no rows"
    if name not in SQL:
        return
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert got == plain(want.fetchall(), want.columns)
