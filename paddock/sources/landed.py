"""Runs written once, in folders by year and month and in buckets by horse.

Conditions on the date become conditions on the folders, which Spark prunes; windows and groups by horse find the
rows dealt out already and need no shuffle; what is too old goes with its folders."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

P = F.col
PARTS = ("race_year", "race_month")


def land(runs: DataFrame, name: str, path: str, buckets: int, by: str = "horse_id", date: str = "race_date") -> DataFrame:
    """Write ``runs`` as the table ``name`` at ``path`` and return it. Each task holds some buckets and writes one file
    a month for each."""
    rows = runs.withColumns({PARTS[0]: F.year(date), PARTS[1]: F.month(date)}).repartition(buckets, by)
    rows.write.format("parquet").mode("overwrite").option("path", path).partitionBy(*PARTS).bucketBy(buckets, by).sortBy(by, date).saveAsTable(name)
    return runs.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, schema: str, buckets: int, by: str = "horse_id", date: str = "race_date") -> DataFrame:
    """Make a landed table known to another session; ``schema`` is that of the runs."""
    parts = ", ".join(f"{p} int" for p in PARTS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, {parts}) USING parquet PARTITIONED BY ({', '.join(PARTS)}) CLUSTERED BY ({by}) SORTED BY ({by}, {date}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _month(day) -> tuple[Column, Column]:
    return F.year(F.lit(day)), F.month(F.lit(day))


def between(landed: DataFrame, first=None, last=None, date: str = "race_date") -> DataFrame:
    """Rows from ``first`` to ``last`` (dates, either may be absent); the folders outside are not read."""
    rows, (y, m) = landed, (P(c) for c in PARTS)
    if first is not None:
        a, b = _month(first)
        rows = rows.where(((y > a) | ((y == a) & (m >= b))) & (P(date) >= F.lit(first)))
    if last is not None:
        a, b = _month(last)
        rows = rows.where(((y < a) | ((y == a) & (m <= b))) & (P(date) <= F.lit(last)))
    return rows


def on_days_of(landed: DataFrame, days: DataFrame, date: str = "race_date") -> DataFrame:
    """Rows whose date is in ``days`` (a small table with column ``date``); its months prune folders while the query runs."""
    wanted = days.select(P(date).alias("_d"), F.year(date).alias("_y"), F.month(date).alias("_m")).distinct()
    return landed.join(wanted, (P(PARTS[0]) == P("_y")) & (P(PARTS[1]) == P("_m")) & (P(date) == P("_d")), "left_semi")


def drop_before(spark: SparkSession, name: str, first: datetime.date) -> Sequence[str]:
    """Drop the months before the one of ``first``, folders included; later months are not looked at. Returns what went."""
    from .shared import Files

    gone = []
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    files = Files(spark, location)
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():  # one row a month
        year, month = (int(x.split("=")[1]) for x in row[0].split("/"))
        if (year, month) < (first.year, first.month):
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({PARTS[0]} = {year}, {PARTS[1]} = {month})")
            files.remove(row[0])
            gone.append(row[0])
    return gone
