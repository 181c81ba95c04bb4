"""Every query of the engine against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from siltstone.plans import catalog

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([repr(round(r[i], 9)) if isinstance(r[i], float) else str(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, small, duck, name):
    df = catalog.QUERIES[name](spark, small)
    found = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(catalog.ORACLES[name])
    assert found == canonical([x[0] for x in result.description], result.fetchall())
