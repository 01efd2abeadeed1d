"""The training-data queries against their SQL at the smallest size."""

from __future__ import annotations

import duckdb
import pytest

from samplewright.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(str(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns)) for r in cursor.fetchall())
    assert sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect()) == want
