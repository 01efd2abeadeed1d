"""Every registered query of the library against its SQL at the smallest size."""

from __future__ import annotations

import duckdb
import pytest

from samplewright.plans.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return tuple(plain(x) for x in v) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(str(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    if name in SQL:
        cursor = duck.execute(SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        assert mine == sorted(str(tuple(plain(dict(zip(names, r, strict=True))[c]) for c in columns)) for r in cursor.fetchall())


def test_entry_without_the_training_data_operators(spark, monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    monkeypatch.setitem(sys.modules, "samplewright.llm", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(SQL)
    assert entry.entry(spark).columns[0] == "sample"
