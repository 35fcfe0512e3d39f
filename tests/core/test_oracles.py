"""Every query that has SQL gives what DuckDB gives, on the smallest tables."""

import math

import duckdb
import pytest

from grainmill.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    want = sorted(str([plain(row[n]) for n in order]) for row in result.fetchall())
    assert sorted(str([plain(v) for v in row]) for row in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
