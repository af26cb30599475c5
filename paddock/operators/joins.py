"""Joins and set operations that Catalyst plans as hash or sort-merge joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsers import name_key

P = F.col


def active_since(runs: DataFrame, entities: DataFrame, key: str, since: Column) -> DataFrame:
    """Entities with a run since a date."""
    return entities.join(runs.where(P("race_date") >= since), key, "left_semi")


def absent(ids: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return ids.join(known, key, "left_anti")


def valid_references(df: DataFrame, columns: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Set each reference to null unless its parent holds it; ``nullified`` counts them by row."""
    out, lost = df, F.lit(0)
    for c, (parent, key) in columns.items():
        known = parent.select(P(key).alias(f"_{c}")).distinct()
        out = out.join(known, P(c) == P(f"_{c}"), "left")
        lost = lost + (P(c).isNotNull() & P(f"_{c}").isNull()).cast("int")
    out = out.withColumn("nullified", lost)
    for c in columns:
        out = out.withColumn(c, P(f"_{c}")).drop(f"_{c}")
    return out


def match_names(names: DataFrame, horses: DataFrame, name: str = "name", region: str = "region", key: str = "horse_id") -> DataFrame:
    """``names`` with the horse that has the name: by name and region (the smallest id), else by a name
    that one horse alone has; ambiguous names stay unmatched. ``match_method`` tells which."""
    both = horses.groupBy(name_key(P(name)).alias("_n"), F.lower(region).alias("_r")).agg(F.min(key).alias("_both"))
    alone = horses.groupBy(name_key(P(name)).alias("_m")).agg(F.min(key).alias("_alone"), F.count(F.lit(1)).alias("_c")).where("_c = 1").drop("_c")
    left = names.withColumns({"_kn": name_key(P(name)), "_kr": F.lower(region)})
    out = left.join(both, (P("_kn") == P("_n")) & (P("_kr") == P("_r")), "left").join(alone, P("_kn") == P("_m"), "left")
    return out.select(
        *names.columns, F.coalesce("_both", "_alone").alias("matched_id"),
        F.when(P("_both").isNotNull(), "name_region").when(P("_alone").isNotNull(), "name").otherwise("none").alias("match_method"),
    )


def prior_runs(runs: DataFrame, tolerance: float | None = None) -> DataFrame:
    """For each run the same horse's runs of earlier dates: how many, wins, last date; with ``tolerance``
    also those whose distance differs by no more than that share.

    Windows within the horse, no pairs of runs. A run is counted under each distance of its horse
    that it is near to, and the rows of a run's own distance remain."""
    rows = runs.repartition("horse_id")
    before = lambda *keys: Window.partitionBy("horse_id", *keys).orderBy(F.unix_date("race_date")).rangeBetween(Window.unboundedPreceding, -1)
    won = P("position") == 1
    out = rows.select("race_id", "horse_id", "race_date", "distance_f", "position", F.count(F.lit(1)).over(before()).alias("prior_runs"), F.count_if(won).over(before()).alias("prior_wins"), F.max("race_date").over(before()).alias("last_run"))
    names = ["race_id", "horse_id", "prior_runs", "prior_wins", "last_run"]
    if tolerance is not None:
        near = F.filter(F.collect_set("distance_f").over(Window.partitionBy("horse_id")), lambda g: P("distance_f").between(g * (1 - tolerance), g * (1 + tolerance)))
        out = out.withColumn("_g", near).withColumn("_g", F.explode(F.array_union("_g", F.array("distance_f"))))
        known = P("_g").isNotNull()
        out = out.withColumns({"near_runs": F.count_if(known).over(before("_g")), "near_wins": F.count_if(known & won).over(before("_g"))}).where(P("_g").eqNullSafe(P("distance_f")))
        names += ["near_runs", "near_wins"]
    return out.select(*names)


def reconcile(source: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of each key in two tables and which has more."""
    a, b = source.groupBy(key).agg(F.count(F.lit(1)).alias("a")), stored.groupBy(key).agg(F.count(F.lit(1)).alias("b"))
    out = a.join(b, key, "full_outer").select(key, F.coalesce("a", F.lit(0)).alias("source_n"), F.coalesce("b", F.lit(0)).alias("stored_n"))
    state = F.when(P("stored_n") == 0, "zero").when(P("source_n") == P("stored_n"), "match").when(P("source_n") > P("stored_n"), "source_more").otherwise("stored_more")
    return out.withColumn("state", state)


def add_coordinates(courses: DataFrame, coordinates: DataFrame, keys: Sequence[Column], other: Sequence[Column]) -> DataFrame:
    """Fill latitude and longitude by derived keys where both are missing. ``coordinates`` is a small file
    with one row for each key."""
    c = coordinates.select(*[k.alias(f"_o{i}") for i, k in enumerate(other)], P("latitude").alias("_lat"), P("longitude").alias("_lon"))
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond &= k == P(f"_o{i}")
    blank = P("latitude").isNull() & P("longitude").isNull()
    out = courses.join(c, cond, "left")
    return out.withColumns({"latitude": F.when(blank, P("_lat")).otherwise(P("latitude")), "longitude": F.when(blank, P("_lon")).otherwise(P("longitude"))}).select(*courses.columns)


def calendar_gaps(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """Dates between the first and the last without a row; with ``by`` of each key by itself."""
    days = df.groupBy(*by).agg(F.explode(F.sequence(F.min(date), F.max(date))).alias("day"))
    return days.join(df.select(*by, P(date).alias("day")).distinct(), [*by, "day"], "left_anti")


def month_chunks(start: str, end: str, spark) -> DataFrame:
    """A date range cut at calendar months."""
    one = spark.range(1).select(F.to_date(F.lit(start)).alias("s"), F.to_date(F.lit(end)).alias("e"))
    months = one.select("s", "e", F.explode(F.expr("sequence(trunc(s, 'MM'), e, interval 1 month)")).alias("m"))
    return months.select(F.greatest("s", F.to_date("m")).alias("chunk_start"), F.least("e", F.last_day("m")).alias("chunk_end"))
