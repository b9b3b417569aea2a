"""Every query with an oracle gives what DuckDB gives for its SQL."""

import datetime
import decimal
import json
import math

import duckdb
import pytest

import __spark_entry__ as entry
from milldam.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return {k: plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else v


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(json.dumps([plain(r[i]) for i in order], default=str) for r in found)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_oracle(spark, sf_dir, duck, name):
    got = catalogue.QUERIES[name](spark, sf_dir)
    want = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
