"""Feature rows on runs with gaps, against their SQL, with batches that end within horses and days."""

import random

import duckdb
import pandas as pd
import pytest

from paddock.operators import features as X
from paddock.plans.feature_queries import _features_sql
from paddock.plans.views import Views

from .test_queries import canonical

COLUMNS = "race_id long, horse_id long, race_date date, position int, course_id int, region string, distance_f double, surface string, going string, race_class int, jockey_id long, trainer_id int, owner_id long"


def made_runs(n, seed=4):
    some = random.Random(seed)
    maybe = lambda x: None if some.random() < 0.08 else x
    days = pd.date_range("2024-01-01", periods=25).date
    return [
        (
            i, maybe(some.choice([1, some.randint(2, 30)])), maybe(some.choice(days)), maybe(some.randint(0, 9)), maybe(some.randint(1, 3)), "r", maybe(some.randint(20, 60) / 4),
            maybe(some.choice(["Turf", "AW"])), maybe(some.choice(["Firm", "Good"])), maybe(some.randint(1, 4)), maybe(some.randint(1, 3)), maybe(some.randint(1, 3)), i,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("size", ["1", "7", "10000"])
def test_features_of_runs_with_gaps_equal_sql(spark, size):
    rows = made_runs(150 if size == "1" else 600)
    runs = spark.createDataFrame(rows, COLUMNS)
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])  # noqa: F841
    types = ", ".join(f"{c}::{t} AS {c}" for c, t in ((c, {"long": "BIGINT", "string": "VARCHAR"}.get(t, t.upper())) for c, t in map(str.split, COLUMNS.split(", "))))
    theirs = duckdb.sql(f"WITH runs AS (SELECT {types} FROM frame) {_features_sql()}").df()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        ours = X.feature_rows(runs).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    assert canonical(ours, columns) == canonical(theirs, columns)
    assert (ours.total_races > len(rows) // 5).any() and (ours.distance_runs != ours.total_races).any()


def test_features_take_one_sort(spark):
    v = Views(spark, "/root/testdata/sf0.001")
    plan = X.feature_rows(v.landed, dealt=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and "Exchange" not in plan and "Bucketed: true" in plan
