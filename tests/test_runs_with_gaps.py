"""The view of runs on lines without a price or a horse, against its SQL, and what its plan reads."""

import datetime

import duckdb
from pyspark.sql import functions as F

from paddock.plans import views

from .test_queries import SF, canonical

TABLES = "region nation customer supplier part orders".split()


def test_lines_without_price_or_horse_rank_as_in_sql(spark, tmp_path):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    odd = "CASE WHEN l_suppkey % 5 <> 0 OR l_linenumber % 3 = 0 THEN l_extendedprice END AS l_extendedprice, CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey END AS l_partkey"
    con.execute(f"CREATE TABLE lineitem AS SELECT * REPLACE ({odd}) FROM '{SF}/lineitem.parquet'")
    con.execute(f"COPY lineitem TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    theirs = con.execute(f"WITH {views.SQL} SELECT * FROM runs").df()
    ours = views.Views(spark, str(tmp_path)).runs.toPandas()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns and theirs.horse_id.isna().any()
    assert canonical(ours, columns) == canonical(theirs, columns)


def test_runs_take_no_lists_and_read_only_the_days_asked_for(spark):
    runs = views.Views(spark, SF).runs.where(F.col("race_date") >= datetime.date(2001, 1, 1))
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Window [") == 2
    assert "GreaterThanOrEqual(o_orderdate" in plan
