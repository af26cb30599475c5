"""Wide rows for each run: the horse's record in every context, and features from earlier runs only.

All windows lie within one horse, so the runs are dealt out by horse once; the record's windows sort
within their partition, features take one sort by day; no run meets another in a join."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..functions.parsers import AW_SURFACES, FORM_WEIGHTS, JUMP_SURFACES, form_points, going_is, rate, surface_is
from .earlier import earlier_runs

P = F.col
#: What must be equal for a run of the horse to count.
RECORD_CONTEXTS = {"course": ("course_id",), "course_distance": ("course_id", "distance_f"), "distance": ("distance_f",), "jockey": ("jockey_id",)}
GOINGS = ("firm", "good", "soft", "heavy")
SURFACES = {"aw": AW_SURFACES, "jumps": JUMP_SURFACES}
OUTCOMES = {"runs": (1, 10**6), "wins": (1, 1), "2nds": (2, 2), "3rds": (3, 3)}
HISTORY_CONTEXTS = {"course": ("course_id",), "surface": ("surface",), "going": ("going",), "class": ("race_class",)}
RELATIONS = {"horse_jockey": ("jockey_id",), "horse_trainer": ("trainer_id",), "jockey_trainer": ("jockey_id", "trainer_id")}


def _outcomes(name: str, condition: Column, window) -> dict[str, Column]:
    """Runs, wins, seconds and thirds of the window's rows that meet the condition."""
    return {f"{name}_{k}": F.count_if(condition & P("position").between(a, b)).over(window) for k, (a, b) in OUTCOMES.items()}


def runner_statistics(runs: DataFrame, as_of: Column, min_runs: int = 1, dealt: bool = False) -> DataFrame:
    """The horse's whole record beside each finished run: career, course, distance, going, surface,
    jockey, last ten runs, last twelve months, last run and win. Horses with fewer than
    ``min_runs`` finished runs are left out. ``dealt``: the runs come from a table in buckets by horse."""
    rows = runs.where(P("position").isNotNull())
    rows = rows if dealt else rows.repartition("horse_id")
    horse = Window.partitionBy("horse_id")
    rows = rows.withColumn("_nth", F.row_number().over(horse.orderBy(F.desc("race_date"), F.desc("race_id"))))
    yes, p = F.lit(True), P("position")
    out = {"career_runs": F.count(F.lit(1)).over(horse), "career_wins": F.count_if(p == 1).over(horse), "career_places": F.count_if(p <= 3).over(horse), "career_prize": F.round(F.sum(F.coalesce("prize_won", F.lit(0.0))).over(horse), 2)}
    for name, keys in RECORD_CONTEXTS.items():
        out |= _outcomes(name, yes, Window.partitionBy("horse_id", *keys))
    for kind in GOINGS:
        out |= _outcomes(kind, going_is(P("going"), kind), horse)
    for name, kinds in SURFACES.items():
        out |= _outcomes(name, surface_is(P("surface"), kinds), horse)
    out |= _outcomes("last_10", P("_nth") <= 10, horse) | _outcomes("last_12m", P("race_date") >= F.date_sub(as_of, 365), horse)
    out |= {"last_raced": F.max("race_date").over(horse), "last_won": F.max(F.when(p == 1, P("race_date"))).over(horse)}
    wide = rows.select("race_id", "horse_id", *[v.alias(k) for k, v in out.items()]).where(P("career_runs") >= min_runs)
    return wide.withColumns({"career_win_percent": rate(P("career_wins"), P("career_runs")), "career_place_percent": rate(P("career_places"), P("career_runs"))})


#: Columns with the last runs of earlier days, latest first, and the form score.
HISTORY = (*(f"last_5_{k}" for k in ("positions", "dates", "courses", "distances", "classes")), "last_10_positions", "recent_form_score")


def feature_rows(runs: DataFrame, tolerance: float = 0.1, dealt: bool = False, keep: Sequence[str] = ("race_date", "course_id", "region", "distance_f", "surface", "going", "race_class", "jockey_id", "trainer_id", "owner_id")) -> DataFrame:
    """One row for each run with its race's columns and what the horse did on earlier days: career, the
    same course, surface, going, class and about the same distance (within ``tolerance``), recent form, and the
    horse with its jockey and trainer. Runs without a date are no history.

    Runs are numbered within their horse by date, which sorts them once, and pass through the sums of ``earlier_runs`` in that order.
    ``dealt``: the runs come from a table in buckets by horse."""
    horse = Window.partitionBy("horse_id").orderBy("race_date", "race_id", "position", "course_id", "distance_f", "race_class")
    contexts = HISTORY_CONTEXTS | RELATIONS
    used = dict.fromkeys(("race_id", "horse_id", *keep, "position", "race_date", "distance_f", "race_class", *itertools.chain(*contexts.values())))
    rows = (runs if dealt else runs.repartition("horse_id")).select(*used, F.row_number().over(horse).alias("_nth"))
    texts = {"positions": "position", "dates": "race_date", "courses": "course_id", "distances": "distance_f", "classes": "race_class"}
    shown = {f"_{k}": F.coalesce(P(c).cast("string"), F.lit("-")) for k, c in texts.items()}
    known = P("horse_id").isNotNull() & P("race_date").isNotNull()
    rows = rows.withColumns(shown | {"_day": F.unix_date("race_date"), "_known": known, "_position": P("position").cast("double"), "_distance": P("distance_f").cast("double"), "_points": form_points(P("position"))})
    last = {f"last_5_{k}": (f"_{k}", 5) for k in texts} | {"last_10_positions": ("_positions", 10)}
    sums = ["total_races", "total_wins", "total_seconds", "total_thirds", "total_places", "_finished", "_places", *[f"{n}_{k}" for n in (*HISTORY_CONTEXTS, "distance") for k in ("runs", "wins", "places")], *[f"{n}_{k}" for n in RELATIONS for k in ("runs", "wins")]]
    schema = StructType([rows.schema[c] for c in dict.fromkeys(("race_id", "horse_id", *keep))] + [StructField(c, StringType()) for c in last] + [StructField(c, LongType()) for c in (*sums, "_score")] + [StructField("days_since_last_run", IntegerType())])
    tenths = [int(w * 10) for w in FORM_WEIGHTS.values()]
    wide = rows.mapInArrow(earlier_runs(contexts, "_distance", tolerance, last, tenths, schema.names), schema)
    # rounded as the SQL does, by the double times 100: the mean of 40 places can be 4.725, which as a double lies below the half
    wide = wide.withColumns({"avg_finish_position": F.floor(F.try_divide("_places", "_finished") * 100 + 0.5) / 100, "recent_form_score": F.round(P("_score") * 10.0 / (sum(FORM_WEIGHTS.values()) * 10), 2)})
    rates = {f"{n}_win_rate": rate(P(f"{n}_wins"), P(f"{n}_runs")) for n in (*HISTORY_CONTEXTS, "distance", *RELATIONS)}
    rates |= {"win_rate": rate(P("total_wins"), P("total_races")), "place_rate": rate(P("total_places"), P("total_races")), "has_form": P("total_races") > 0}
    return wide.select("race_id", "horse_id", *keep, *HISTORY, *[c for c in sums if c[0] != "_"], "avg_finish_position", "days_since_last_run", *[v.alias(k) for k, v in rates.items()])


#: What documents say about a runner and its people, beside the race's outcome.
DETAILS = ("number", "draw", "age", "sex", "weight_lbs", "headgear", "ofr", "rpr", "ts", "horse_name", "jockey_name", "trainer_name", "owner_name", "comment")


def with_runner_details(rows: DataFrame, runners: DataFrame, columns: Sequence[str] = DETAILS) -> DataFrame:
    """Feature rows with what the runners' documents carry (draw, ratings, names ...); null where there is no document. Ids
    are compared as text; of several rows of a runner the one with the largest columns counts."""
    keys = ("race_id", "horse_id")
    known = [c for c in columns if c in runners.columns]
    one = runners.groupBy(*[P(k).cast("string").alias(f"_{k}") for k in keys]).agg(F.max(F.struct(*known)).alias("_d"))
    out = rows.join(one, (P("race_id").cast("string") == P("_race_id")) & (P("horse_id").cast("string") == P("_horse_id")), "left")
    return out.select(*rows.columns, *[P(f"_d.{c}").alias(c) for c in known])


def feature_health(features: DataFrame, as_of: Column, keys: Sequence[str] = ("race_id", "horse_id", "jockey_id", "trainer_id")) -> DataFrame:
    """One row about a table of features: rows, latest date and its age with a state, share with form, missing
    keys, mean depth of the history, shares with a form score and with each kind of context."""
    n = F.count(F.lit(1))
    share = lambda c: F.round(F.count_if(c) * 100.0 / n, 2)
    lost = F.lit(False)
    for k in keys:
        lost |= P(k).isNull()
    out = features.agg(
        n.alias("n"), F.max("race_date").alias("latest"), F.datediff(as_of, F.max("race_date")).alias("age_days"), share(P("has_form")).alias("form_percent"), F.count_if(lost).alias("missing_keys"),
        F.round(F.avg("total_races"), 4).alias("mean_depth"), share(P("recent_form_score").isNotNull()).alias("score_percent"), share((P("course_runs") > 0) | (P("distance_runs") > 0)).alias("context_percent"),
    )
    return out.withColumn("state", F.when(P("age_days") <= 0, "FRESH").when(P("age_days") <= 1, "AGING").otherwise("STALE"))
