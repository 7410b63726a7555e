"""Every registered query with SQL against DuckDB, row for row."""

import duckdb
import pandas as pd
import pytest

from sievework import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    out = []
    for row in df.itertuples(index=False):
        cells = []
        for v in row:
            if v is None or (isinstance(v, float) and pd.isna(v)) or v is pd.NaT or v is pd.NA:
                cells.append("")
            elif isinstance(v, bool) or type(v).__name__ == "bool_":
                cells.append(str(bool(v)))
            elif isinstance(v, (int, float)) or hasattr(v, "dtype"):
                cells.append(f"{float(v):.6f}")  # pandas turns whole numbers with nulls into floats
            else:
                cells.append(str(v))
        out.append(tuple(cells))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    sql = registry.oracles().get(name)
    if sql is None:
        assert len(got.columns)
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    a, b = plain(got), plain(want)
    assert [x for x in zip(a, b) if x[0] != x[1]][:3] == []
