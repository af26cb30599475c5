"""Queries over whole tables, beside the named slices of them."""

import os

from pyspark.sql import functions as F

from paddock.plans.queries import QUERIES
from paddock.plans.views import Views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_run_history_has_every_finished_run_in_order(spark):
    got = [(r["horse_id"], r["race_date"], r["race_id"]) for r in QUERIES["run_history_all"](spark, SF).collect()]
    want = [tuple(r) for r in Views(spark, SF).runs.where("position is not null").select("horse_id", "race_date", "race_id").collect()]
    assert sorted(got) == sorted(want) and len({h % 10 for h, _, _ in got}) == 10
    assert got == sorted(got, key=lambda x: (x[0], -x[1].toordinal(), -x[2]))


def test_calendar_gaps_have_no_race_at_all(spark):
    days = {r[0] for r in Views(spark, SF).races.select("race_date").collect()}
    gaps = {r[0] for r in QUERIES["calendar_gaps_all"](spark, SF).collect()}
    assert not gaps & days and len(gaps | days) == (max(days) - min(days)).days + 1


def test_top_pairs_count_every_run(spark):
    got = QUERIES["top_pairs_all"](spark, SF).collect()
    assert len(got) > 50 and sum(r["runs"] for r in got) == Views(spark, SF).runs.count()
    assert got == sorted(got, key=lambda r: (-r["runs"], r["jockey_id"], r["horse_id"]))


def test_context_stats_stand_beside_every_run(spark):
    whole, part = QUERIES["ml_context_stats_all"](spark, SF).cache(), QUERIES["ml_context_stats"](spark, SF)
    assert whole.select("race_id", "horse_id").distinct().count() == whole.count() == Views(spark, SF).runs.count()
    assert part.exceptAll(whole.select(*[F.col(c).cast(t) for c, t in part.dtypes])).count() == 0
