"""Every catalog query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from shardloom.jobs import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if v is None or v != v:
        return "-"
    return f"{float(v):.6f}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, sql, name):
    got = registry.QUERIES[name](spark, SF)
    want = sql.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
