"""The corpus queries with SQL against DuckDB."""

import duckdb
import pytest

from sievework.llm import oracles, queries
from tests.test_queries import plain


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_query(spark, sf_dir, name):
    folder = sf_dir.replace("0.001", "0.01")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, folder).toPandas(), con.execute(oracles.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert [x for x in zip(plain(got), plain(want)) if x[0] != x[1]][:3] == []
