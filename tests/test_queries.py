import duckdb
import pytest

import __spark_entry__

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: repr(round(float(v), 6)) if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(__spark_entry__.oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    got = __spark_entry__.queries()[name](spark, FOLDER)
    want = tables.sql(__spark_entry__.oracle_sql()[name])
    assert canonical(got.columns, [tuple(r) for r in got.collect()]) == canonical(want.columns, want.fetchall())


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).count() > 0
