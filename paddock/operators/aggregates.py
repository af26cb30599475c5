"""Grouped statistics of entities, pairs, distances and venues. Each is one hash aggregation with
map-side partial sums, whatever the number of entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import rate

P = F.col


def outcome_counts(position: str = "position") -> list[Column]:
    p = P(position)
    return [F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"), F.count_if(p <= 3).alias("places"), F.count_if(p == 2).alias("seconds"), F.count_if(p == 3).alias("thirds")]


def with_rates(df: DataFrame, zero: float | None = None) -> DataFrame:
    return df.withColumns({"win_rate": rate(P("wins"), P("runs"), zero=zero), "place_rate": rate(P("places"), P("runs"), zero=zero)})


def lifetime(runs: DataFrame, key: str, finished_only: bool = False, extra: Sequence[Column] = (), zero: float | None = None) -> DataFrame:
    """Runs, wins, places, seconds, thirds and rates of each entity."""
    rows = runs.where(P("position").isNotNull()) if finished_only else runs
    return with_rates(rows.where(P(key).isNotNull()).groupBy(key).agg(*outcome_counts(), *extra), zero)


def recent_form(runs: DataFrame, key: str, as_of: Column, days: Sequence[int] = (14, 30)) -> DataFrame:
    """Runs, wins and win rate of the last days, for entities that ran in the longest window. Earlier
    rows are filtered before the shuffle."""
    rows = runs.where((P("race_date") >= F.date_sub(as_of, max(days))) & P("position").isNotNull())
    aggs = []
    for d in days:
        inside = P("race_date") >= F.date_sub(as_of, d)
        aggs += [F.count_if(inside).alias(f"runs_{d}d"), F.count_if(inside & (P("position") == 1)).alias(f"wins_{d}d")]
    out = rows.groupBy(key).agg(*aggs)
    return out.withColumns({f"win_rate_{d}d": rate(P(f"wins_{d}d"), P(f"runs_{d}d")) for d in days})


def last_activity(runs: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Last run, last win and the days since."""
    out = runs.groupBy(key).agg(F.max("race_date").alias("last_run"), F.max(F.when(P("position") == 1, P("race_date"))).alias("last_win"))
    return out.withColumns({"days_since_run": F.datediff(as_of, "last_run"), "days_since_win": F.datediff(as_of, "last_win")})


def market_indices() -> list[Column]:
    """Actual over expected wins by starting prices, and the profit of one unit on each run. Winners'
    own prices count."""
    price, won = P("sp_decimal"), P("position") == 1
    priced = P("sp_decimal") > 0
    return [
        F.round(F.try_divide(F.count_if(won & priced), F.sum(F.when(priced, 1 / price))), 2).alias("ae_index"),
        (F.coalesce(F.sum(F.when(won, price)), F.lit(0.0)) - F.count(F.lit(1))).alias("profit"),
    ]


def performance(runs: DataFrame, keys: Sequence[str], min_runs: int = 5, extra: Sequence[Column] = ()) -> DataFrame:
    """Finished runs by ``keys`` (an entity and a distance, a venue ...): outcomes, rates, indices."""
    out = runs.where(P("position").isNotNull()).groupBy(*keys).agg(*outcome_counts(), *market_indices(), *extra)
    return with_rates(out.where(P("runs") >= min_runs))


def performance_times(runs: DataFrame, keys: Sequence[str], seconds: str, min_runs: int = 5, latest: Sequence[str] = ("race_date", "race_id", "horse_id")) -> DataFrame:
    """``performance`` with the best, average and last time, and how many runs each going had, as a map and
    as text."""
    times = [F.min(seconds).alias("best_time"), F.round(F.avg(seconds), 2).alias("avg_time"), F.max_by(seconds, F.struct(*latest)).alias("last_time")]
    goings = breakdown_text(runs.where(P("position").isNotNull()), keys, "going")
    return performance(runs, keys, min_runs, times).join(goings, list(keys))


def unpivot_entities(runs: DataFrame, entities: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """One row for each entity of a run: entity_type, entity_id (as text) and the columns kept."""
    pairs = [F.struct(F.lit(kind).alias("entity_type"), P(c).cast("string").alias("entity_id")) for kind, c in entities.items()]
    return runs.select(F.explode(F.array(*pairs)).alias("e"), *keep).select("e.*", *keep).where(P("entity_id").isNotNull())


def pairs(runs: DataFrame, first: str, second: str, min_runs: int = 5) -> DataFrame:
    """Outcomes of two entities together."""
    rows = runs.where(P(first).isNotNull() & P(second).isNotNull())
    return with_rates(rows.groupBy(first, second).agg(*outcome_counts()).where(P("runs") >= min_runs))


def all_pairs(runs: DataFrame, kinds: Sequence[tuple[str, str]]) -> DataFrame:
    """pair_type, first_id, second_id (as text), runs, wins of all pairs of all ``kinds``, in one aggregation; runs that lack one of a kind's two ids
    don't count for it."""
    cells = F.array(*[F.struct(F.lit(f"{a.removesuffix('_id')}_{b.removesuffix('_id')}").alias("pair_type"), P(a).cast("string").alias("first_id"), P(b).cast("string").alias("second_id")) for a, b in kinds])
    rows = runs.select("position", F.inline(cells)).where(P("first_id").isNotNull() & P("second_id").isNotNull())
    return rows.groupBy("pair_type", "first_id", "second_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(P("position") == 1).alias("wins"))


def combinations(runs: DataFrame, keys: Sequence[str], min_runs: int = 2) -> DataFrame:
    """Outcomes of several entities together under a composite key, with first and last date."""
    out = runs.groupBy(*keys).agg(*outcome_counts(), F.min("race_date").alias("first_seen"), F.max("race_date").alias("last_seen"))
    return with_rates(out.where(P("runs") >= min_runs)).withColumn("combination", F.concat_ws("|", *keys))


def breakdown_text(runs: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Count of each category as a map, and as ordered text ``category=n;...``."""
    counts = runs.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("n"))
    entries = F.sort_array(F.collect_list(F.struct(P(category).alias("key"), P("n").alias("value"))))
    out = counts.groupBy(*keys).agg(entries.alias("e"))
    shown = F.array_join(F.transform("e", lambda x: F.concat(x["key"].cast("string"), F.lit("="), x["value"].cast("string"))), ";")
    return out.withColumns({"breakdown": F.map_from_entries("e"), "breakdown_text": shown}).drop("e")


def yearly_coverage(df: DataFrame, date: str) -> DataFrame:
    """Rows by year from the first to the last, years without rows included."""
    years = df.groupBy(F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    span = years.agg(F.explode(F.sequence(F.min("year"), F.max("year"))).alias("year"))
    return span.join(years, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"))


def completeness(counts: DataFrame, expected: int) -> DataFrame:
    """Share of the expected rows, in bands."""
    share = F.round(F.lit(100.0) * P("n") / expected, 2)
    return counts.select("year", "n", share.alias("percent"), F.when(share >= 90, "complete").when(share >= 50, "partial").otherwise("missing").alias("status"))


def entity_view(dimension: DataFrame, runs: DataFrame, key: str, as_of: Column) -> DataFrame:
    """Every row of ``dimension`` with lifetime counts and rates, recent form and last dates of its entity; counts and rates are zero where
    there are no runs, dates are null. Lifetimes count all runs, recent form finished ones."""
    stats = lifetime(runs, key).drop("seconds", "thirds").join(last_activity(runs, key, as_of).select(key, "last_run", "last_win"), key)
    form = recent_form(runs, key, as_of).drop("win_rate_14d", "win_rate_30d")
    out = dimension.join(stats, key, "left").join(form, key, "left")
    return out.na.fill(0, [c for c in (*stats.columns, *form.columns) if c not in (key, "last_run", "last_win")])


def arrival(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Races of the last ``days``: runners, results and whether all have come."""
    recent = runs.where(P("race_date") >= F.date_sub(as_of, days))
    return recent.groupBy("race_id", "race_date").agg(F.count(F.lit(1)).alias("runners"), F.count("position").alias("results"), (F.count("position") == F.count(F.lit(1))).alias("complete"))


def table_coverage(tables: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """table_name, n, first_day, last_day of each table (name, rows, date column)."""
    out = None
    for name, df, date in tables:
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.to_date(F.min(date)).alias("first_day"), F.to_date(F.max(date)).alias("last_day"))
        out = row if out is None else out.unionByName(row)
    return out


def update_dimension(dim: DataFrame, stats: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Dimension rows with new statistics where there are some, else what they had."""
    new = stats.select(key, *[P(c).alias(f"_new_{c}") for c in columns])
    out = dim.join(new, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"_new_{c}", c) if c in dim.columns else P(f"_new_{c}")).drop(f"_new_{c}")
    return out
