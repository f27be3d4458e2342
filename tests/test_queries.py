"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from rivulet.plans import oracle, queries

SF = "/root/testdata/sf0.001"


def rows(df: pd.DataFrame) -> list[str]:
    cols = sorted(df.columns)
    return sorted(str([None if pd.isna(v) else int(v) if isinstance(v, float) and v.is_integer() else v for v in r]) for r in df[cols].astype(object).values.tolist())


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    want = con.execute(oracle.SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_plans_stay_in_the_engine(spark):
    """Predicates and columns reach the file scan; the shallow path has no Python and, up to publications, no shuffle."""
    plan = queries.publications(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hashpartitioning" not in plan and "props" in plan and "value" not in plan.split("ReadSchema")[-1].split("\n")[0]
