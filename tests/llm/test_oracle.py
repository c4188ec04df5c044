"""The SQL twins against the queries, over the driver's smallest tables."""

from collections import Counter

import duckdb
import pytest

from quaymark.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql_gives_the_same_rows(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.execute(oracle.SQL[name])
    names = [c[0] for c in want.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    rows = Counter(map(tuple, got.select(*names).collect()))
    assert rows and rows == Counter(want.fetchall())
