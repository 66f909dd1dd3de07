"""Every registered query with SQL against DuckDB; the others have rows of the same columns twice."""

from __future__ import annotations

import decimal
import math

import duckdb
import pytest

from attestor.plans import core, evidence, facts, pages, varied  # noqa: F401
from attestor.plans.registry import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return round(float(v), 6) if isinstance(v, decimal.Decimal) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    said = duck.execute(ORACLES[name])
    names = [d[0] for d in said.description]
    assert cols == sorted(names)
    order = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in said.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_is_stable(name, spark, sf_dir):
    a, b = (sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert a == b
