"""States, landed runs, observed loads and the closure: what they read, write and keep."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from paddock.operators import aggregates as A
from paddock.operators import pedigree as G
from paddock.operators import quality as Q
from paddock.operators import states as T
from paddock.operators import windows as W
from paddock.plans.queries import QUERIES
from paddock.plans.views import Views
from paddock.sources import documents, landed, sinks

SF = "/root/testdata/sf0.001"
DAY = datetime.date(2024, 3, 15)
RUN = "key string, race_date date, position int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_states_take_results_back_and_add_them_again(spark, tmp_path):
    rows = [("a", DAY, None), ("a", DAY, 1), ("b", DAY.replace(month=1), 2), (None, DAY, 1), ("c", None, 1)]
    path = str(tmp_path / "s")
    T.write_states(T.month_states(spark.createDataFrame(rows, RUN), "key"), path)
    before = {d: os.stat(tmp_path / "s" / d).st_mtime_ns for d in os.listdir(tmp_path / "s") if d.startswith("month")}
    old, new = spark.createDataFrame([("a", DAY, None), ("a", DAY, 1)], RUN), spark.createDataFrame([("a", DAY, 1), ("a", DAY, 3), ("d", DAY, 1)], RUN)
    T.refresh_states(path, old, new, "key")
    states = T.read_states(spark, path, "string", "key")
    got = {r["key"]: (r["runs"], r["wins"], r["places"], r["last_run"], r["last_win"]) for r in T.lifetime_from_states(states, "key").collect()}
    assert got == {"a": (2, 1, 2, DAY, DAY), "b": (1, 0, 1, DAY.replace(month=1), None), "d": (1, 1, 1, DAY, DAY)}
    after = {d: os.stat(tmp_path / "s" / d).st_mtime_ns for d in before}
    assert after["month=2024-01-01"] == before["month=2024-01-01"] and after["month=2024-03-01"] != before["month=2024-03-01"]
    T.refresh_states(path, new, new.limit(0), "key")  # all of March is taken away again
    assert [r["key"] for r in T.lifetime_from_states(T.read_states(spark, path, "string", "key"), "key").collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(month" in plan(T.recent_form_from_states(states, "key", DAY))


def test_merged_sets_are_exact(spark):
    rows = spark.range(200_000).selectExpr("cast(id % 7 as string) as key", "date_add(date'2024-01-01', cast(id % 90 as int)) as race_date", "id * 31 % 70001 as horse_id")
    parts = [T.distinct_states(rows.where(F.col("horse_id") % 3 == i), "key", "horse_id") for i in range(3)]
    got = {r["key"]: r["n"] for r in T.distinct_from_states(T.merge_distinct(*parts, key="key"), "key", "n").collect()}
    assert got == {r["key"]: r["n"] for r in rows.groupBy("key").agg(F.countDistinct("horse_id").alias("n")).collect()}


def test_form_windows_hold_days_and_not_runs(spark):
    rows = spark.range(50_000).selectExpr("id as race_id", "id as horse_id", "'one' as trainer_id", "date_add(date'2024-01-01', cast(id % 60 as int)) as race_date", "cast(id % 9 as int) as position")
    out = W.form_before(rows.unionByName(spark.createDataFrame([(1, 1, None, DAY, 1), (2, 2, "x", None, 1)], "race_id long, horse_id long, trainer_id string, race_date date, position int")), "trainer_id")
    got = {r["race_id"]: r for r in out.where("race_id = 59 or trainer_id is null or trainer_id = 'x'").collect()}
    assert got[59]["runs_before"] == rows.where("race_date < date'2024-02-29' and position is not null").count() and got[59]["runs_14d"] == rows.where("race_date between date'2024-02-15' and date'2024-02-28'").count()
    assert got[1]["runs_before"] is None and got[2]["runs_before"] is None


def test_landed_runs_prune_folders_and_need_no_shuffle_by_horse(spark, tmp_path):
    v = Views(spark, SF)
    table = landed.land(v.runs, "landed_test", str(tmp_path / "runs"), 4)
    recent = plan(landed.between(table, first=F.date_sub(v.as_of, 30)))
    assert "PartitionFilters: [((race_year" in recent.replace("isnotnull(race_year#", "") or "race_month" in recent.split("PartitionFilters")[1].split("PushedFilters")[0]
    from paddock.operators import features as X

    assert "Exchange hashpartitioning(horse_id" not in plan(X.runner_statistics(table, v.as_of, dealt=True)) and "Exchange" not in plan(X.feature_rows(table, dealt=True))
    gone = landed.drop_before(spark, "landed_test", datetime.date(1995, 6, 1))
    spark.catalog.refreshTable("landed_test")
    left = spark.table("landed_test")
    assert gone and left.agg(F.min("race_date")).first()[0] >= datetime.date(1995, 6, 1) and left.count() == v.runs.where("race_date >= date'1995-06-01'").count()
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in v.runs.schema)
    again = landed.attach(spark, "landed_again", str(tmp_path / "runs"), schema, 4)
    assert again.count() == left.count()


def test_loads_are_counted_by_the_job_that_writes(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"race_id": "r1", "runners": []}\n{"race_id": " "}\nnot json\n')
    docs = documents.read_documents(spark, str(tmp_path / "in.json"), documents.RESULT_SCHEMA)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("load", "load")
    bad = F.col("_corrupt_record").isNotNull() | (F.trim(F.coalesce("race_id", F.lit(""))) == "")
    got = sinks.load(docs, str(tmp_path / "out"), str(tmp_path / "log"), "races", bad)
    n = len(jobs.getJobIdsForGroup("load"))
    spark.sparkContext.setJobGroup("", "")
    assert got == {"processed": 1, "skipped": 2} and n <= 2  # the load and its line in the log
    assert [r.race_id for r in sinks.loaded(spark, str(tmp_path / "out")).collect()] == ["r1"] and sinks.quarantine(spark, str(tmp_path / "out")).count() == 2
    log = spark.read.parquet(str(tmp_path / "log")).first()
    assert (log.records_processed, log.records_skipped, log.status) == (1, 2, "success")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division by zero"):
        sinks.load(docs.withColumn("x", F.expr("1 / (length('') * 1)")), str(tmp_path / "out2"), str(tmp_path / "log"), "races", bad)
    assert spark.read.parquet(str(tmp_path / "log")).where("status = 'error' and records_processed = 0").count() == 1


def test_lines_that_meet_and_circles(spark):
    horses = spark.createDataFrame([(1, 2, 3), (2, 4, 5), (3, 4, 6), (4, 1, None), (7, 7, 1), (7, 7, 1), (8, None, None)], "horse_id long, sire_id long, dam_id long")
    got = {(r.horse_id, r.path): (r.ancestor_id, r.generation) for r in G.ancestry(horses, depth=4).collect()}
    assert got[1, "sire.sire"] == (4, 2) == got[1, "dam.sire"] and (1, "sire.sire.sire") not in got  # 4's sire is 1 itself
    assert got[4, "sire.dam.dam"] == (6, 3) and (7, "sire") not in got and got[7, "dam.sire.sire"] == (4, 3)
    assert all(h != a for (h, _), (a, _) in got.items()) and not any(h == 8 for h, _ in got)
    met = {(r.horse_id, r.ancestor_id): (r.n_paths, r.paths, r.cross) for r in G.inbreeding(G.ancestry(horses)).collect()}
    assert met[1, 4] == (2, "dam.sire,sire.sire", "2x2") and met[7, 4] == (2, "dam.dam.sire,dam.sire.sire", "3x3")
    assert G.ancestry(horses.limit(0)).count() == 0


def test_equal_runs_have_one_lineage(spark):
    run = (1, 9, 1, 1.0, DAY, 1, "s", "d", "ds")
    runs = spark.createDataFrame([run, run], "race_id long, horse_id long, position int, prize_won double, race_date date, race_class int, sire_id string, dam_id string, damsire_id string")
    assert sorted(r.lineage_id for r in G.lineage(runs).collect()) == ["1_9_1_dam", "1_9_1_sire", "1_9_2_damsire"]
    closure = G.ancestry(spark.createDataFrame([(9, 5, 6)], "horse_id long, sire_id long, dam_id long"))
    assert G.runner_lineage(runs, closure).count() == 2


def test_all_references_go_through_one_shuffle(spark):
    a, b = spark.createDataFrame([(1, 5), (2, 6), (None, 7), (9, 5)], "x int, y int"), spark.createDataFrame([("1",), ("2",)], "k string")
    out = Q.reference_report([("a.x", a, "x", b, "k"), ("a.y", a, "y", a, "y"), ("b.k", b, "k", a, "x")])
    assert sorted(map(tuple, out.collect())) == [("a.x", 3, 1, 1), ("a.y", 4, 0, 0), ("b.k", 2, 0, 0)]
    assert plan(out).split("Initial Plan")[-1].count("Exchange hashpartitioning(rule") == 2 and plan(out).count("Join") == 0


@pytest.mark.parametrize("name", ["inbred_runners", "inbred_runners_lineage", "ancestry_paths", "grand_progeny_runs", "settled_results", "stored_progeny_checked"])
def test_queries_have_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_profiles_read_the_runs_once(spark):
    v = Views(spark, SF)
    from paddock.operators import profiles as B

    whole = plan(B.ancestor_profiles(B.horse_careers(v.runs), v.horses, "sire_id"))
    assert "lineitem" not in whole and whole.split("Initial Plan")[-1].count("Exchange") < 20
    assert A.recent_form(v.landed, "jockey_id", v.as_of).count() == A.recent_form(v.runs, "jockey_id", v.as_of).count()
