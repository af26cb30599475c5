"""Data-quality measures of whole tables: one aggregation a table, no sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import population_status

P = F.col


def column_population(df: DataFrame, columns: Sequence[str] | None = None, blank_is_null: bool = False) -> DataFrame:
    """column_name, n, filled, missing, percent, status of each column, in one pass."""
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    value = lambda c: F.nullif(P(c), F.lit("")) if blank_is_null and kinds[c] == "string" else P(c)
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(value(c)).alias(f"_{i}") for i, c in enumerate(names)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), P(f"_{i}").alias("filled")) for i, c in enumerate(names)])
    out = row.select("n", F.explode(cells).alias("x")).select("x.column_name", "n", "x.filled")
    percent = F.round(F.try_divide(P("filled") * 100.0, P("n")), 2)
    out = out.withColumns({"missing": P("n") - P("filled"), "percent": F.coalesce(percent, F.lit(0.0))})
    return out.withColumn("status", population_status(P("percent")))


def table_profile(population: DataFrame) -> DataFrame:
    full = F.count_if(P("percent") >= 80)
    out = population.agg(F.count(F.lit(1)).alias("columns"), full.alias("well_filled"), F.count_if(P("filled") == 0).alias("empty"))
    share = P("well_filled") / P("columns")
    return out.withColumn("status", F.when(share >= 0.8, "good").when(share >= 0.5, "fair").otherwise("poor"))


def severity(population: DataFrame) -> DataFrame:
    return population.select("column_name", "percent", F.when(P("percent") == 0, "HIGH").when(P("percent") < 10, "MEDIUM").otherwise("OK").alias("severity"))


def null_bands(population: DataFrame, bands: Sequence[tuple[float, str]] = ((50, "above_50"), (10, "above_10"), (0, "above_0"))) -> DataFrame:
    share = 100 - P("percent")
    out = F.lit("none")
    for limit, name in sorted(bands):
        out = F.when(share > limit, name).otherwise(out)
    return population.select("column_name", F.round(share, 2).alias("null_percent"), out.alias("band"))


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """How many rows meet each condition (null counts as not met)."""
    row = df.agg(*[F.count_if(c).alias(k) for k, c in conditions.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("check_name"), P(k).alias("n")) for k in conditions])).alias("x")).select("x.*")


def orphans(df: DataFrame, rules: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows whose reference has no parent, by reference; nulls aren't orphans."""
    parts = [df.where(P(c).isNotNull()).select(P(c).alias("k")).join(parent.select(P(key).alias("k")).distinct(), "k", "left_anti").agg(F.lit(c).alias("reference"), F.count(F.lit(1)).alias("n")) for c, parent, key in rules]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def reference_report(rules: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """rule, n_references, n_orphans (rows), orphan_keys (distinct) of each rule (name, child, column, parent, key); null references
    don't count.

    All rules go through one shuffle: each child and parent table is read once for all of its rules, keys are
    counted where they are read, and (rule, key) groups tell whether a parent has the key."""
    tables: dict[int, tuple[DataFrame, list]] = {}
    for name, child, column, parent, key in rules:
        tables.setdefault(id(child), (child, []))[1].append((name, column, 1))
        tables.setdefault(id(parent), (parent, []))[1].append((name, key, 0))
    rows = None
    for df, cells in tables.values():
        each = F.array(*[F.struct(F.lit(rule).alias("rule"), P(c).cast("string").alias("key"), F.lit(n).cast("long").alias("n")) for rule, c, n in cells])
        part = df.select(F.explode(each).alias("e")).select("e.*").where(P("key").isNotNull())
        rows = part if rows is None else rows.unionByName(part)
    keys = rows.groupBy("rule", "key").agg(F.sum("n").alias("n"), F.bool_or(P("n") == 0).alias("known"))
    lost = ~P("known")
    return keys.groupBy("rule").agg(F.sum("n").alias("n_references"), F.coalesce(F.sum(F.when(lost, P("n"))), F.lit(0)).alias("n_orphans"), F.count_if(lost).alias("orphan_keys"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(P("n") > 1)


def name_duplicates(df: DataFrame, name: str) -> DataFrame:
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("c"))
    return counts.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("distinct_names"), F.count_if(P("c") > 1).alias("repeated_names"))


def freshness(df: DataFrame, date: str, as_of: Column, threshold_days: int) -> DataFrame:
    age = F.datediff(as_of, F.max(date))
    return df.agg(F.max(date).alias("latest"), age.alias("age_days")).withColumn("state", F.when(P("age_days") <= threshold_days, "fresh").when(P("age_days") <= 1.5 * threshold_days, "warning").otherwise("stale"))


def overall_freshness(tables: Sequence[tuple[str, DataFrame, str, int]], as_of: Column) -> DataFrame:
    """table_name, latest, age_days, state of each table (name, rows, date column, threshold in days): fresh, warning up to one and a half times the
    threshold, stale, or empty."""
    out = None
    for name, df, date, days in tables:
        row = freshness(df, date, as_of, days).select(F.lit(name).alias("table_name"), "latest", "age_days", F.when(P("latest").isNull(), "empty").otherwise(P("state")).alias("state"))
        out = row if out is None else out.unionByName(row)
    return out


def health(states: DataFrame) -> DataFrame:
    """How many tables are in each state, the share of fresh ones, and pass (75 at least), warning (50) or fail."""
    kinds = [F.count_if(P("state") == s).alias(s) for s in ("fresh", "warning", "stale", "empty")]
    out = states.agg(F.count(F.lit(1)).alias("tables"), *kinds)
    share = F.when(P("tables") > 0, P("fresh") * 100.0 / P("tables")).otherwise(0.0)
    return out.withColumns({"health_score": F.round(share, 1), "result": F.when(share >= 75, "pass").when(share >= 50, "warning").otherwise("fail")})


def null_groups(population: DataFrame) -> DataFrame:
    """Columns of which half or more is null (count blanks as null in ``population``): entirely, mostly (90 or more) and
    partially (50 or more) null ones."""
    share = P("missing") * 100.0 / P("n")
    group = F.when(share == 100, "entirely").when(share >= 90, "mostly").when(share >= 50, "partially")
    return population.select("column_name", "missing", "n", group.alias("null_group")).where(P("null_group").isNotNull())


def latest_updates(log: DataFrame, tables: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last log row of each of ``tables`` (one column ``key``); ``never_updated`` where there is none."""
    last = log.groupBy(key).agg(F.max_by(F.struct(*[c for c in log.columns if c != key]), F.struct(*order)).alias("_l"))
    out = tables.select(key).distinct().join(last, key, "left")
    shown = [P(f"_l.{c}").alias(c) for c in log.columns if c not in (key, "status")]
    return out.select(key, *shown, F.when(P("_l").isNull(), "never_updated").otherwise(P("_l.status")).alias("status"))


def twin_columns(df: DataFrame, one: str, two: str) -> DataFrame:
    a, b = P(one).cast("string"), P(two).cast("string")
    return df.agg(F.count(one).alias("first_filled"), F.count(two).alias("second_filled"), F.count_if(a == b).alias("equal"), F.count_if(a != b).alias("different")).withColumn("advice", F.when(P("second_filled") == 0, "DROP").when(P("different") == 0, "MERGE").otherwise("KEEP"))


def coverage_gap(df: DataFrame, finished: str, value: str) -> DataFrame:
    """Rows, finished ones, those with a value, and how many finished ones more there are than values."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(finished).alias("finished"), F.count(value).alias("priced")).withColumn("gap", P("finished") - P("priced"))


def row_quality(df: DataFrame, name: str, region: str, regions: Sequence[str]) -> DataFrame:
    """A score of 100, less 30 if a name is missing, less 30 if a region is, less 20 if one is outside."""
    out = df.agg(F.count_if(F.coalesce(name, F.lit("")) == "").alias("nameless"), F.count_if(P(region).isNull()).alias("no_region"), F.count_if(~F.coalesce(P(region).isin(*regions), F.lit(False))).alias("outside"))
    less = F.when(P("nameless") > 0, 30).otherwise(0) + F.when(P("no_region") > 0, 30).otherwise(0) + F.when(P("outside") > 0, 20).otherwise(0)
    return out.withColumn("score", 100 - less)


def severity_of(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``severity`` of the expected columns; those that the table lacks are CRITICAL."""
    there, absent = [c for c in expected if c in df.columns], [c for c in expected if c not in df.columns]
    lost = df.sparkSession.createDataFrame([(c, None, "CRITICAL") for c in absent], "column_name string, percent double, severity string")
    return severity(column_population(df, there)).unionByName(lost)


def pass_bands(population: DataFrame, passed: float = 90, warned: float = 50) -> DataFrame:
    return population.select("column_name", "percent", F.when(P("percent") >= passed, "pass").when(P("percent") >= warned, "warn").otherwise("fail").alias("result"))


def twin_samples(df: DataFrame, one: str, two: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows whose twin columns are both filled and differ as text."""
    return df.where(P(one).cast("string") != P(two).cast("string")).select(*order, P(one).alias("first"), P(two).alias("second")).orderBy(*order).limit(n)


def differing(stored: DataFrame, actual: DataFrame, key: str, one: str, two: str, tolerance: float = 0) -> DataFrame:
    """Keys whose stored value differs from the actual one by more than ``tolerance``."""
    return stored.select(key, one).join(actual.select(key, two), key).where(F.abs(P(one) - P(two)) > tolerance)
