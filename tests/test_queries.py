"""Every query of the engine against its DuckDB SQL on the smallest tables; those without SQL give rows."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from pagewright import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_equals_its_sql(spark, tiny, duck, name):
    df = plans.queries()[name](spark, tiny)
    result = duck.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert [[float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r] for r in rows(df.columns, df.collect())] == [[float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x for x in r] for r in rows(columns, result.fetchall())]


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_query_gives_rows(spark, tiny, name):
    assert plans.queries()[name](spark, tiny).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["pattern", "n_docs", "first_doc"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
