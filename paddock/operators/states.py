"""Statistics that are kept up from day to day: one state for each entity and month, merged with changes.

A state holds counts and, for each day of its month, how many runs and wins there were. All of these can be
added and taken away again, so a result that replaces an entry is one row less and one more. Lifetimes,
recent form and last dates are read from the states; the runs are not looked at again. Tables of states
are partitioned by month, and a refresh reads and rewrites the months that its changes touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsers import rate
from ..sources.shared import staged
from ..sources.sinks import replace_partitions
from .aggregates import with_rates

P = F.col
COUNTS = ("runs", "wins", "places", "seconds", "thirds")
DAYS = ("run_days", "win_days")


def month_states(rows: DataFrame, key: str, weight: Column | None = None) -> DataFrame:
    """key, month (its first day, as text), counts, run_days, win_days (31 counts each). Rows count ``weight`` times, once
    by default. Rows without the key or a date are left out."""
    w = F.lit(1).cast("long") if weight is None else weight.cast("long")
    p, day = P("position"), F.dayofmonth("race_date")
    n = lambda c: F.sum(F.when(c, w).otherwise(0))
    conditions = {"runs": F.lit(True), "wins": p == 1, "places": p <= 3, "seconds": p == 2, "thirds": p == 3}
    days = {"run_days": F.lit(True), "win_days": p == 1}
    rows = rows.where(P(key).isNotNull() & P("race_date").isNotNull())
    return rows.groupBy(key, F.date_format("race_date", "yyyy-MM-01").alias("month")).agg(
        *[n(c).alias(name) for name, c in conditions.items()], *[F.array(*[n(c & (day == i)) for i in range(1, 32)]).alias(name) for name, c in days.items()]
    )


def changes(replaced: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """States that take ``replaced`` rows away and add ``new`` ones."""
    columns = [key, "race_date", "position"]
    rows = new.select(*columns, F.lit(1).alias("_w")).unionByName(replaced.select(*columns, F.lit(-1).alias("_w")))
    return month_states(rows, key, P("_w"))


def merge_states(stored: DataFrame, change: DataFrame, key: str) -> DataFrame:
    """Both added up, one row for each key and month."""
    other = change.select(P(key).alias("_k"), P("month").alias("_m"), *[P(c).alias(f"_{c}") for c in (*COUNTS, *DAYS)])
    out = stored.join(other, (P(key) == P("_k")) & (P("month") == P("_m")), "full_outer")
    zeros = F.array_repeat(F.lit(0).cast("long"), 31)
    counts = [(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in COUNTS]
    days = [F.zip_with(F.coalesce(c, zeros), F.coalesce(f"_{c}", zeros), lambda a, b: a + b).alias(c) for c in DAYS]
    return out.select(F.coalesce(key, "_k").alias(key), F.coalesce("month", "_m").alias("month"), *counts, *days)


def write_states(states: DataFrame, path: str) -> None:
    """Write states as a table by month; months that ``states`` has replace what was there."""
    replace_partitions(states.repartition("month"), path, ["month"])


def read_states(spark: SparkSession, path: str, key_type: str, key: str) -> DataFrame:
    counts, days = ", ".join(f"{c} bigint" for c in COUNTS), ", ".join(f"{c} array<bigint>" for c in DAYS)
    return spark.read.schema(f"`{key}` {key_type}, {counts}, {days}, month string").parquet(path)


def refresh_states(path: str, replaced: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Merge a day's changes into the table of states at ``path``; returns the changes. Months that these do not touch
    are neither read nor written."""
    change = staged(changes(replaced, new, key), "state-changes")
    months = sorted(r[0] for r in change.select("month").distinct().collect())  # a few; a table has one for each month at most
    if months:
        stored = read_states(change.sparkSession, path, change.schema[key].dataType.simpleString(), key).where(P("month").isin(months))
        write_states(staged(merge_states(stored, change, key), "states"), path)
    return change


def _last(days: str) -> Column:
    """The date of the last day that has any."""
    return F.date_add(F.to_date("month"), F.array_max(F.filter(F.transform(days, lambda n, i: F.when(n > 0, i)), lambda x: x.isNotNull())))


def lifetime_from_states(states: DataFrame, key: str) -> DataFrame:
    """``lifetime`` and ``last_activity`` of each entity."""
    out = states.groupBy(key).agg(*[F.sum(c).alias(c) for c in COUNTS], F.max(_last("run_days")).alias("last_run"), F.max(_last("win_days")).alias("last_win"))
    return with_rates(out.where(P("runs") > 0))


def recent_form_from_states(states: DataFrame, key: str, as_of, days: Sequence[int] = (14, 30)) -> DataFrame:
    """Runs, wins and win rate of the last days (whether finished or not), of entities that ran in the longest window. Only the months of
    that window are read."""
    rows = states.where(P("month") >= F.date_format(F.date_sub(F.lit(as_of), max(days)), "yyyy-MM-01"))

    def within(column: str, n: int) -> Column:
        inside = F.transform(column, lambda x, i: F.when(F.date_add(F.to_date("month"), i) >= F.date_sub(F.lit(as_of), n), x).otherwise(0))
        return F.sum(F.aggregate(inside, F.lit(0).cast("long"), lambda a, b: a + b))

    out = rows.groupBy(key).agg(*[within(c, d).alias(f"{name}_{d}d") for d in days for name, c in (("runs", "run_days"), ("wins", "win_days"))])
    out = out.where(P(f"runs_{max(days)}d") > 0)
    return out.withColumns({f"win_rate_{d}d": rate(P(f"wins_{d}d"), P(f"runs_{d}d")) for d in days})


# -- distinct values -------------------------------------------------------------------------------


def distinct_states(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The set of ``value`` (whole numbers) of each key and month: key, month, bucket, bits. A bitmap has 4 KB for 32,768
    neighbouring values before compression, whatever it holds, and needs no row of the runs any more."""
    rows = rows.where(P(key).isNotNull() & P("race_date").isNotNull() & P(value).isNotNull())
    groups = rows.groupBy(key, F.date_format("race_date", "yyyy-MM-01").alias("month"), F.bitmap_bucket_number(value).alias("bucket"))
    return groups.agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))


def merge_distinct(*states: DataFrame, key: str) -> DataFrame:
    """Sets of the same key, month and bucket united."""
    rows = states[0]
    for more in states[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(key, "month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_from_states(states: DataFrame, key: str, name: str) -> DataFrame:
    """How many distinct values each key has over all months, exactly."""
    return states.groupBy(key, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")).groupBy(key).agg(F.sum(F.bitmap_count("bits")).alias(name))
