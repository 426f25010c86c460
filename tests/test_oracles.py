"""Every reference-side query against its SQL in DuckDB, over the smallest tables."""

import duckdb
import pytest

from varqa.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, con, name):
    df = registry.queries()[name](spark, sf_dir)
    rows = [r.asDict() for r in df.collect()]
    if name not in registry.oracle_sql():
        assert df.columns and isinstance(rows, list)
        return
    want = con.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    a = sorted((tuple(norm(r[c]) for c in columns) for r in rows), key=repr)
    b = sorted((tuple(norm(r[want.columns.index(c)]) for c in columns) for r in want.fetchall()), key=repr)
    assert a == b


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
