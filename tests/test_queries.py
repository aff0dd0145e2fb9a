"""Every registered query of the panel against its SQL on DuckDB."""

from __future__ import annotations

import decimal

import duckdb
import pytest

from candela.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return 0.0 if isinstance(v, float) and v == 0 else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    rows = QUERIES[name](spark, sf_dir)
    names = sorted(rows.columns)
    found = sorted((tuple(plain(v) for v in r) for r in rows.select(*names).collect()), key=repr)
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == names
    at = [columns.index(n) for n in names]
    assert found == sorted((tuple(plain(r[k]) for k in at) for r in cursor.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
