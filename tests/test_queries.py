"""Every query of the core against its SQL, on the smallest tables; queries without SQL only have to run."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans import company, loading, training_core

QUERIES = company.QUERIES | loading.QUERIES | training_core.QUERIES
SQL = company.SQL | loading.SQL | training_core.SQL


@pytest.fixture(scope="module")
def tables(sf):
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows(df: pd.DataFrame) -> list[str]:
    """Rows as comparable text: columns by name, numbers rounded, one kind of missing value."""

    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        return round(float(v), 6) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    return sorted(str([plain(v) for v in r]) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, tables, name):
    df = QUERIES[name](spark, sf)
    assert len(set(df.columns)) == len(df.columns)
    got = df.toPandas()
    if name in SQL:
        want = tables.sql(SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    elif name != "p3_alternatives":
        assert len(got)
