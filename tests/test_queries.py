"""Every registered query of the library itself against its DuckDB SQL."""

import numbers
import os

import duckdb
import pandas as pd
import pytest

from paddock.plans.queries import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(frame, columns):
    def text(x):
        if pd.isna(x):
            return ""
        if hasattr(x, "isoformat"):
            return x.isoformat().replace("T00:00:00", "")
        return f"{float(x):.6f}" if isinstance(x, numbers.Number) and not isinstance(x, bool) else str(x)

    return sorted(tuple(text(v) for v in row) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours, sorted(ours.columns)) == canonical(theirs, sorted(ours.columns))


def test_entry_names_are_registered(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0
