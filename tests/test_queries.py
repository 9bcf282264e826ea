"""Every core query against its SQL on the same tables."""

import duckdb
import pytest
from pathlib import Path

from textloom.plans import catalog


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


# Tested against brute force on small cases instead.
WITHOUT_SQL = {"broken_replies", "edge_windows", "greedy_triplets", "kmeans_clusters", "path_lengths"}


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, data, name):
    df = catalog.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = plain(tuple(r) for r in df.select(*cols).collect())
    found = duck.execute(catalog.SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == plain(tuple(r[i] for i in at) for r in found.fetchall())


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL) | WITHOUT_SQL and not set(catalog.SQL) & WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0
