"""First, latest, top-k and running counts by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsers import AW_SURFACES, JUMP_SURFACES, form_points, form_weight, going_is, rate, surface_is

P = F.col


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 1, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each key. Spark prunes each task's groups before the shuffle."""
    n = rank or "_rank"
    out = df.withColumn(n, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(P(n) <= k)
    return out if rank else out.drop(n)


def last_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Wins, seconds and thirds in each horse's last ``n`` finished runs."""
    rows = top_by(runs.where(P("position").isNotNull()), ["horse_id"], [F.desc("race_date"), F.desc("race_id")], n)
    p = P("position")
    return rows.groupBy("horse_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"), F.count_if(p == 2).alias("seconds"), F.count_if(p == 3).alias("thirds"))


def form_lines(runs: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` runs of each horse, latest first, as arrays and text, and the form score."""
    rows = top_by(runs.where(P("position").isNotNull()), ["horse_id"], [F.desc("race_date"), F.desc("race_id")], n, rank="r")
    line = F.sort_array(F.collect_list(F.struct("r", "position", "race_date", "course_id", "distance_f", "race_class")))
    score = F.round(F.sum(form_points(P("position")) * form_weight(P("r"))) / 67 * 100, 2)
    out = rows.groupBy("horse_id").agg(line.alias("line"), score.alias("form_score"))
    shown = lambda c: F.array_join(F.transform("line", lambda x: x[c].cast("string")), ",")
    texts = {f"last_{c}": shown(c) for c in ("position", "race_date", "course_id", "distance_f", "race_class")}
    return out.select("horse_id", "form_score", *[v.alias(k) for k, v in texts.items()])


#: Contexts of a horse's record: name -> columns that must be equal.
CONTEXTS = {"career": (), "course": ("course_id",), "course_distance": ("course_id", "distance_f"), "distance": ("distance_f",), "jockey": ("jockey_id",)}


def runner_record(runs: DataFrame, before_race: bool = False) -> DataFrame:
    """Runs and wins of the same horse in each context, beside every run; all runs, or with
    ``before_race`` only those of earlier dates. Goings and surfaces count over the whole career. One
    sort for each of the contexts' keys replaces a scan of the horse's runs for every run."""
    out = {}
    runs = runs.repartition("horse_id")
    p = P("position")
    for name, keys in CONTEXTS.items():
        w = Window.partitionBy("horse_id", *keys)
        if before_race:
            w = w.orderBy(F.unix_date("race_date")).rangeBetween(Window.unboundedPreceding, -1)
        out[f"{name}_runs"] = F.count(p).over(w)
        out[f"{name}_wins"] = F.count_if(p == 1).over(w)
    w = Window.partitionBy("horse_id")
    w = w.orderBy(F.unix_date("race_date")).rangeBetween(Window.unboundedPreceding, -1) if before_race else w
    for kind in ("firm", "good", "soft", "heavy"):
        out[f"{kind}_runs"] = F.count_if(p.isNotNull() & going_is(P("going"), kind)).over(w)
    for name, kinds in (("aw", AW_SURFACES), ("jumps", JUMP_SURFACES)):
        out[f"{name}_runs"] = F.count_if(p.isNotNull() & surface_is(P("surface"), kinds)).over(w)
    return runs.select("race_id", "horse_id", *[v.alias(k) for k, v in out.items()])


#: What must be equal for an earlier run to count in a context of ``context_stats``.
STAT_CONTEXTS = {"course": "course_id", "surface": "surface", "going": "going", "class": "race_class", "jockey": "jockey_id", "trainer": "trainer_id"}


def context_stats(runs: DataFrame) -> DataFrame:
    """Beside every run the same horse's runs of earlier dates: how many, wins, average place, days
    since the last, and runs and wins in each context. Windows make no pairs of runs."""
    runs = runs.repartition("horse_id")  # once; each window sorts within the partition
    before = lambda *keys: Window.partitionBy("horse_id", *keys).orderBy(F.unix_date("race_date")).rangeBetween(Window.unboundedPreceding, -1)
    p, w = P("position"), before()
    out = {
        "career_runs": F.count(F.lit(1)).over(w), "career_wins": F.count_if(p == 1).over(w), "avg_finish": F.round(F.avg(p).over(w), 4),
        "days_since": F.datediff(P("race_date"), F.max("race_date").over(w)),
    }
    for name, column in STAT_CONTEXTS.items():
        out |= {f"{name}_runs": F.count(F.lit(1)).over(before(column)), f"{name}_wins": F.count_if(p == 1).over(before(column))}
    return runs.select("race_id", "horse_id", *[v.alias(k) for k, v in out.items()])


def with_context_rates(stats: DataFrame) -> DataFrame:
    """Win rates beside the counts of ``context_stats``; null where there were no runs."""
    return stats.withColumns({f"{k}_win_rate": rate(P(f"{k}_wins"), P(f"{k}_runs")) for k in ("career", *STAT_CONTEXTS)})


def form_before(runs: DataFrame, key: str, days: Sequence[int] = (14, 30)) -> DataFrame:
    """Beside every run the finished runs and wins of its entity on earlier days: all of them, and those of the last ``days``.

    For entities with very many runs (trainers): runs are summed up by entity and day first, the windows go over
    an entity's days, which the calendar bounds, and the sums are joined back by entity and day. Runs without
    the entity or a date have nulls."""
    finished = runs.where(P(key).isNotNull() & P("race_date").isNotNull())
    daily = finished.groupBy(key, "race_date").agg(F.count("position").alias("_n"), F.count_if(P("position") == 1).alias("_w"))
    before = Window.partitionBy(key).orderBy(F.unix_date("race_date"))
    frames = {"before": before.rangeBetween(Window.unboundedPreceding, -1)} | {f"{d}d": before.rangeBetween(-d, -1) for d in days}
    sums = daily.select(P(key).alias("_key"), P("race_date").alias("_day"), *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{name}_{frame}") for frame, w in frames.items() for name, c in (("runs", "_n"), ("wins", "_w"))])
    out = runs.select("race_id", "horse_id", key, "race_date").join(sums, (P(key) == P("_key")) & (P("race_date") == P("_day")), "left")
    names = [f"{name}_{frame}" for frame in frames for name in ("runs", "wins")]
    return out.select("race_id", "horse_id", key, *names, *[rate(P(f"wins_{frame}"), P(f"runs_{frame}")).alias(f"win_rate_{frame}") for frame in frames])


def rolling(runs: DataFrame, key: str, days: int = 365) -> DataFrame:
    """Finished runs and wins of the ``days`` before each run."""
    w = Window.partitionBy(key).orderBy(F.unix_date("race_date")).rangeBetween(-days, -1)
    return runs.select("race_id", "horse_id", F.count("position").over(w).alias("runs_window"), F.count_if(P("position") == 1).over(w).alias("wins_window"))


def top_categories(rows: DataFrame, key: str, category: str, k: int = 3) -> DataFrame:
    """The ``k`` categories with most wins of each key."""
    counts = rows.groupBy(key, category).agg(F.count(F.lit(1)).alias("runs"), F.count_if(P("position") == 1).alias("wins"))
    out = top_by(counts, [key], [F.desc("wins"), P(category)], k, rank="rank")
    return out.withColumn("win_rate", rate(P("wins"), P("runs")))


def upcoming(runs: DataFrame, entries: DataFrame, context: Sequence[str] = ("race_id", "race_date", "course_id", "race_class", "distance_f", "surface")) -> DataFrame:
    """One row for each race of ``entries``: its context, how many runners, and their mean win rate and form score."""
    wins = runs.groupBy("horse_id").agg(rate(F.count_if(P("position") == 1), F.count(F.lit(1))).alias("_w"))
    out = entries.join(wins, "horse_id", "left").join(form_lines(runs).select("horse_id", "form_score"), "horse_id", "left")
    return out.groupBy(*context).agg(F.count(F.lit(1)).alias("runners"), F.round(F.avg("_w"), 4).alias("mean_win_rate"), F.round(F.avg("form_score"), 4).alias("mean_form"))


def history_array(runs: DataFrame, columns: Sequence[str] = ("race_date", "race_id", "position", "course_id", "distance_f")) -> DataFrame:
    """horse_id, history: the horse's runs as an array, latest first."""
    return runs.groupBy("horse_id").agg(F.sort_array(F.collect_list(F.struct(*columns)), asc=False).alias("history"))
