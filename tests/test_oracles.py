"""Every query against its DuckDB SQL on the small tables; the others must run and keep their columns."""

import math

import duckdb
import pytest

from geoloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v if v is None or isinstance(v, (bool, str)) else float(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    if name not in registry.ORACLES:
        assert got
        return
    rel = con.sql(registry.ORACLES[name])
    assert sorted(rel.columns) == sorted(df.columns)
    want = rows(rel.columns, rel.fetchall())
    assert len(got) == len(want)
    assert got == want
