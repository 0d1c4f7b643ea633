"""Every core query against its SQL at the smallest scale; those without SQL must give rows."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from dialoom.plans import report_queries  # noqa: F401  adds to the same tables
from dialoom.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = [p.stem for p in Path(DATA).glob("*.parquet")] if Path(DATA).exists() else []


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(x):
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 9)
    return x


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in found), key=repr)


@pytest.mark.skipif(not TABLES, reason="tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    found = df.collect()
    if name not in ORACLES:
        assert found
        return
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    wanted = rows(names, cursor.fetchall())
    assert wanted
    assert rows(df.columns, [tuple(r) for r in found]) == wanted
