"""Reports on whole tables: coverage, arrival, ratios, listings and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import did_not_finish, is_winner, position, rate

P = F.col


def _n() -> Column:
    return F.count(F.lit(1))


def counts_by(df: DataFrame, key: Column | str, name: str = "n") -> DataFrame:
    """Rows of each value."""
    return df.groupBy(key).agg(_n().alias(name))


def runs_of_pairs(runs: DataFrame, first: str, second: str) -> DataFrame:
    """How often two entities ran together, most often first."""
    return runs.groupBy(first, second).agg(_n().alias("runs")).orderBy(F.desc("runs"), first, second)


def lineage_summary(edges: DataFrame, keys: Sequence[str] = ("generation", "relation")) -> DataFrame:
    """Rows, ancestors and horses of each kind of line."""
    return edges.groupBy(*keys).agg(_n().alias("n"), F.countDistinct("ancestor_id").alias("ancestors"), F.countDistinct("horse_id").alias("horses"))


def best_of_progeny(edges: DataFrame) -> DataFrame:
    """Best position and last win of each ancestor's progeny."""
    return edges.groupBy("ancestor_id").agg(F.min("position").alias("bp"), F.max(F.when(P("position") == 1, P("race_date"))).alias("lw"))


def wins_of_ancestors(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation", "ancestor_id").agg(F.count_if(P("position") == 1).alias("wins"))


def busy_days(runs: DataFrame) -> DataFrame:
    """Days on which a horse ran more than once, and in which races."""
    races = F.array_join(F.transform(F.sort_array(F.collect_list("race_id")), lambda x: x.cast("string")), ",")
    return runs.groupBy("horse_id", "race_date").agg(_n().alias("n"), races.alias("races")).where("n > 1")


def runners_by_race(races: DataFrame, runs: DataFrame) -> DataFrame:
    """race_id, n of every race, those without runners too."""
    return races.select("race_id").join(runs.select("race_id", "horse_id"), "race_id", "left").groupBy("race_id").agg(F.count("horse_id").alias("n"))


def mean_runners(by_race: DataFrame) -> DataFrame:
    return by_race.agg(F.round(F.avg("n"), 4).alias("mean_runners"), F.count_if(P("n") == 0).alias("without"))


def race_coverage(by_race: DataFrame, expected: int = 3) -> DataFrame:
    """Races with and without runners, and how many runners are lacking to ``expected`` a race."""
    return by_race.agg(_n().alias("races"), F.count_if(P("n") > 0).alias("with_runners"), F.count_if(P("n") == 0).alias("without"), F.sum(F.greatest(F.lit(expected) - P("n"), F.lit(0))).alias("deficit"))


def entity_ratios(runs: DataFrame) -> DataFrame:
    races = F.countDistinct("race_id")
    return runs.agg(F.round(_n() / races, 4).alias("runners_per_race"), F.round(F.countDistinct("horse_id") / races, 4).alias("horses_per_race"))


def latest_value(runs: DataFrame, keys: Sequence[str], value: str, name: str, order: Sequence[str] = ("race_date", "race_id", "horse_id")) -> DataFrame:
    """The last row's value of each group."""
    return runs.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(name))


def position_texts(runs: DataFrame, raw: str = "position_raw") -> DataFrame:
    """Rows, winners and non-finishers of each raw position."""
    return runs.groupBy(raw).agg(_n().alias("n"), F.count_if(is_winner(position(P(raw)))).alias("winners"), F.count_if(did_not_finish(P(raw))).alias("dnf"))


def result_split(runs: DataFrame) -> DataFrame:
    """Entries without a result, results and their share."""
    out = runs.agg(_n().alias("n"), F.count_if(P("position").isNull()).alias("entries"), F.count("position").alias("results"))
    return out.withColumn("result_percent", rate(P("results"), P("n")))


def distinct_by_kind(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """kind, n: distinct values of each column."""
    row = df.agg(*[F.countDistinct(c).alias(k) for k, c in kinds.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), P(k).alias("n")) for k in kinds])))


def staleness(races: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Latest date of each key and its age."""
    return races.groupBy(key).agg(F.max("race_date").alias("latest")).withColumn("age_days", F.datediff(as_of, "latest"))


def success_rates(log: DataFrame, key: str, failed: Column) -> DataFrame:
    """Runs of each key and the share that did not fail."""
    return log.groupBy(key).agg(_n().alias("runs"), F.count_if(~failed).alias("successes")).withColumn("success_rate", rate(P("successes"), P("runs")))


def arrival_by_day(runs: DataFrame) -> DataFrame:
    return runs.groupBy("race_date").agg(_n().alias("runs"), F.count("position").alias("results"), F.countDistinct("race_id").alias("races"))


def feature_quality(runs: DataFrame, price: str = "sp_decimal") -> DataFrame:
    """Rows by day, those with a result and a price, mean price, last position."""
    complete = F.count_if(P("position").isNotNull() & (P(price) > 1))
    return runs.groupBy("race_date").agg(_n().alias("rows"), complete.alias("complete"), F.round(F.avg(price), 4).alias("mean_price"), F.max("position").cast("long").alias("last_position"))


def ancestor_coverage(horses: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """Distinct ancestors and how many of them ran."""
    ran = runs.select(P("horse_id").cast("string").alias(key), F.lit(1).alias("hit")).distinct()
    return horses.select(key).distinct().join(ran, key, "left").agg(_n().alias("ancestors"), F.count("hit").alias("found"))


def races_without_results(runs: DataFrame) -> DataFrame:
    return runs.groupBy("race_id").agg(F.count("position").alias("n")).where("n = 0").select("race_id")


def history_text(runs: DataFrame) -> DataFrame:
    """A horse's runs as text, latest first: date:position;..."""
    rows = runs.groupBy("horse_id").agg(F.sort_array(F.collect_list(F.struct("race_date", "race_id", "position_raw")), asc=False).alias("h"))
    return rows.select("horse_id", F.array_join(F.transform("h", lambda x: F.concat(x["race_date"].cast("string"), F.lit(":"), x["position_raw"])), ";").alias("history"))


def backfill_estimate(races: DataFrame) -> DataFrame:
    """Days from the first to the last race and races a day."""
    out = races.agg((F.datediff(F.max("race_date"), F.min("race_date")) + 1).alias("days"), _n().alias("races"))
    return out.withColumn("races_per_day", F.round(P("races") / P("days"), 4))


def row_minimum(df: DataFrame, table: str, fail: int, warn: int) -> DataFrame:
    return df.agg(F.lit(table).alias("table_name"), _n().alias("n")).withColumn("state", F.when(P("n") < fail, "fail").when(P("n") < warn, "warn").otherwise("pass"))


def null_categories(population: DataFrame, rules: DataFrame) -> DataFrame:
    """Columns and missing values by category; columns that ``rules`` (column_name, category; a small table) lacks are unexpected."""
    out = population.join(F.broadcast(rules), "column_name", "left")
    return out.groupBy(F.coalesce("category", F.lit("unexpected")).alias("category")).agg(_n().alias("columns"), F.sum("missing").alias("missing"))


def outcomes_by(runs: DataFrame, *keys: Column | str) -> DataFrame:
    return runs.groupBy(*keys).agg(_n().alias("runs"), F.count_if(P("position") == 1).alias("wins"))


def upcoming_win_rates(runs: DataFrame, entries: DataFrame) -> DataFrame:
    """Runners of each coming race and their mean win rate; horses that never ran don't count."""
    rates = runs.groupBy("horse_id").agg((F.count_if(P("position") == 1) * 100.0 / _n()).alias("w"))
    return entries.select("race_id", "horse_id").join(rates, "horse_id").groupBy("race_id").agg(_n().alias("runners"), F.round(F.avg("w"), 4).alias("mean_win_rate"))


def upcoming_form(form: DataFrame, entries: DataFrame) -> DataFrame:
    """Runners of each coming race and their mean form score."""
    rows = entries.select("race_id", "horse_id").join(form.select("horse_id", "form_score"), "horse_id", "left")
    return rows.groupBy("race_id").agg(_n().alias("runners"), F.round(F.avg("form_score"), 4).alias("mean_form"))


def update_days(log: DataFrame, key: str, time: str) -> DataFrame:
    """Updates of each key: how many, first and last day, on how many days."""
    return log.groupBy(key).agg(_n().alias("n"), F.to_date(F.min(time)).alias("first_day"), F.to_date(F.max(time)).alias("last_day"), F.countDistinct(F.to_date(time)).alias("days"))
