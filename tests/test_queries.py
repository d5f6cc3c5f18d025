"""Every registered query against its SQL on the whole small tables."""

import datetime as dt
import math

import duckdb
import pytest

from sessionloom.plans.catalog import QUERIES
from sessionloom.plans.oracles import ORACLES

from conftest import plan_of

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def table_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = table_of(columns, result.fetchall())
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == expected
    assert expected, "a query over whole tables finds something"
    plan = plan_of(df)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
