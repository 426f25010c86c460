"""Queries of this subpackage that have SQL, against it in DuckDB."""

import duckdb
import pytest

from tests.test_oracles import TABLES, norm
from varqa.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    df, want = QUERIES[name](spark, sf_dir), c.sql(ORACLE[name])
    columns = sorted(want.columns)
    assert sorted(df.columns) == columns
    a = sorted((tuple(norm(r[k]) for k in columns) for r in df.collect()), key=repr)
    assert a == sorted((tuple(norm(r[want.columns.index(k)]) for k in columns) for r in want.fetchall()), key=repr)
