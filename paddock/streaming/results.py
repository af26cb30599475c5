"""Results that arrive up to some days after the entries of a race, joined as two streams.

The state holds entries until their result has come or can't come in time any more, and results until no
entry of theirs can come any more; both ends follow from the watermarks and the time range of the join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

P = F.col
#: How long after the race a result counts.
WAIT = "7 days"


def _sides(entries: DataFrame, results: DataFrame, keys: Sequence[str], at: str, received: str, wait: str) -> tuple[DataFrame, DataFrame, Column]:
    right = results.select(*[P(k).alias(f"_{k}") for k in keys], *[c for c in results.columns if c not in keys])
    on = (P(received) >= P(at)) & (P(received) <= P(at) + F.expr(f"interval {wait}"))
    for k in keys:
        on &= P(k) == P(f"_{k}")
    return entries, right, on


def with_late_results(entries: DataFrame, results: DataFrame, keys: Sequence[str], at: str, received: str, wait: str = WAIT, late_entries: str = "1 day", late_results: str = "1 day") -> DataFrame:
    """Stream of entries with their result's columns. Results count from the race's time ``at`` until ``wait``
    after it; an entry whose result has not come by then comes out once, with nulls, when the watermark has
    passed. Rows that come later than ``late_entries`` or ``late_results`` behind the newest of their stream
    may be left out; ``rows_left_out`` counts them. Several results of an entry give several rows, in time order of
    arrival: merge them by key, as live_upsert does. No column but the keys may be in both."""
    left, right, on = _sides(entries.withWatermark(at, late_entries), results.withWatermark(received, late_results), keys, at, received, wait)
    return left.join(right, on, "left_outer").drop(*[f"_{k}" for k in keys])


def settled_results(entries: DataFrame, results: DataFrame, keys: Sequence[str], at: str, received: str, wait: str = WAIT, late_entries: str = "1 day", late_results: str = "1 day") -> DataFrame:
    """What ``with_late_results`` has put out when both tables have been streamed to their end in time order:
    entries with their results, and those without one whose time is over. The watermark of two streams
    is the older of theirs."""
    left, right, on = _sides(entries, results, keys, at, received, wait)
    ends = entries.agg((F.max(at) - F.expr(f"interval {late_entries}")).alias("m")).unionByName(results.agg((F.max(received) - F.expr(f"interval {late_results}")).alias("m")))
    mark = F.lit(ends.agg(F.min("m")).first()[0])
    joined = left.join(right, on, "left_outer")
    over = P(at) + F.expr(f"interval {wait}") < mark
    return joined.where(P(f"_{keys[0]}").isNotNull() | over).drop(*[f"_{k}" for k in keys])


def rows_left_out(query) -> int:
    """Rows that a streaming query has dropped because they came after the watermark, by its progress
    reports (spark.sql.streaming.numRecentProgressUpdates of them)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def rows_in_state(query) -> int:
    """Rows that the query's operators hold now."""
    last = query.lastProgress
    return sum(op["numRowsTotal"] for op in last["stateOperators"]) if last else 0
