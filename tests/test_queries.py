"""Every registered query against its SQL oracle, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from touchline.plans.catalog import ORACLE, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def test_entry_holds_all():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = df.select(*columns).collect()
    if name not in ORACLE:
        assert rows
        return
    answer = con.execute(ORACLE[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert sorted(tuple(normal(v) for v in r) for r in rows) == sorted(tuple(normal(r[i]) for i in at) for r in answer.fetchall())
