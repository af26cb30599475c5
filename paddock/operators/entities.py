"""Dimension tables out of runs and documents: extraction, enrichment, matching, what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsers import rate
from .joins import match_names

P = F.col
#: Bookmakers with their names and kinds.
BOOKMAKERS = (
    ("bet365", "Bet365", "online"),
    ("william_hill", "William Hill", "online"),
    ("ladbrokes", "Ladbrokes", "online"),
    ("coral", "Coral", "online"),
    ("paddy_power", "Paddy Power", "online"),
    ("betfair", "Betfair", "exchange"),
    ("betfair_sportsbook", "Betfair Sportsbook", "online"),
    ("skybet", "Sky Bet", "online"),
    ("betvictor", "BetVictor", "online"),
    ("betfred", "Betfred", "online"),
    ("888sport", "888sport", "online"),
    ("unibet", "Unibet", "online"),
    ("betway", "Betway", "online"),
    ("boylesports", "BoyleSports", "online"),
    ("betdaq", "Betdaq", "exchange"),
    ("matchbook", "Matchbook", "exchange"),
    ("smarkets", "Smarkets", "exchange"),
    ("spreadex", "Spreadex", "spread"),
    ("sporting_index", "Sporting Index", "spread"),
)


def bookmakers(spark: SparkSession) -> DataFrame:
    """code, name, type, is_active of each bookmaker: 19 rows, to be broadcast."""
    rows = spark.createDataFrame([(code, name, kind) for code, name, kind in BOOKMAKERS], "code string, name string, type string")
    return rows.withColumn("is_active", F.lit(True))


def regions(courses: DataFrame, code: str = "region_code", name: str = "region") -> DataFrame:
    """code, name of the regions that courses name, one row a code: the largest of several names. Courses that lack
    one of the two say nothing."""
    known = courses.where((F.coalesce(code, F.lit("")) != "") & (F.coalesce(name, F.lit("")) != ""))
    return known.groupBy(P(code).alias("code")).agg(F.max(name).alias("name"))


def extract_entities(runs: DataFrame, kinds: dict[str, tuple[str, str]], order: Sequence[str] = ("race_date", "race_id", "horse_id")) -> DataFrame:
    """entity_type, entity_id, name (the first that isn't missing), first_seen, runs. ``kinds``: the
    columns of id and name of each kind. Runs without an id are left out."""
    cells = F.array(*[F.struct(F.lit(kind).alias("entity_type"), P(i).cast("string").alias("entity_id"), P(n).cast("string").alias("name")) for kind, (i, n) in kinds.items()])
    rows = runs.select(*order, F.explode(cells).alias("e")).select(*order, "e.*").where(P("entity_id").isNotNull())
    named = F.min(F.when(P("name").isNotNull(), F.struct(*order, "name")))["name"]
    return rows.groupBy("entity_type", "entity_id").agg(named.alias("name"), F.min(order[0]).alias("first_seen"), F.count(F.lit(1)).alias("runs"))


def breeding_entities(horses: DataFrame, relations: Sequence[str], name: str = "name", region: str = "region") -> DataFrame:
    """relation, ancestor, matched_id, match_method: each ancestor name once, with the horse it names."""
    cells = F.array(*[F.struct(F.lit(r).alias("relation"), P(r).cast("string").alias("ancestor")) for r in relations])
    found = horses.select(F.explode(cells).alias("e")).select("e.*").where(P("ancestor").isNotNull()).distinct()
    asked = found.select("relation", P("ancestor").alias(name), F.lit(None).cast("string").alias(region))
    return match_names(asked, horses, name, region).select("relation", P(name).alias("ancestor"), "matched_id", "match_method")


def split_known(new: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is known, rows whose key is not)."""
    return new.join(known.select(key), key, "left_semi"), new.join(known.select(key), key, "left_anti")


def enrich(new: DataFrame, details: DataFrame, key: str, ancestors: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(new rows with their details, pedigree rows of those with any ancestor)."""
    full = new.join(details, key, "left")
    any_known = F.lit(False)
    for a in ancestors:
        any_known = any_known | P(a).isNotNull()
    return full, full.where(any_known).select(key, *ancestors)


def merge_keeping(old: DataFrame, new: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """Upsert in which ``keep`` columns that are all filled stay as they were; other columns take the new value
    where the new table has the row."""
    o = old.select(P(key).alias("_k"), F.lit(True).alias("_old"), *[P(c).alias(f"_o_{c}") for c in old.columns if c != key])
    n = new.withColumn("_new", F.lit(True))
    out = n.join(o, P(key) == P("_k"), "full_outer")
    filled = F.lit(True)
    for c in keep:
        filled &= P(f"_o_{c}").isNotNull()
    value = lambda c: F.when(P("_new").isNull() | (filled if c in keep else F.lit(False)), P(f"_o_{c}")).otherwise(P(c)) if c in new.columns else P(f"_o_{c}")
    return out.select(F.coalesce(key, "_k").alias(key), *[value(c).alias(c) for c in old.columns if c != key])


def without_statistics(dimension: DataFrame, column: str, marker: str | None = None, id_col: str = "id") -> DataFrame:
    """Rows whose statistic is null or zero, rows of tests (ids that start with ``marker``) left out."""
    out = dimension.where(P(column).isNull() | (P(column) == 0))
    return out if marker is None else out.where(~P(id_col).cast("string").startswith(marker))


def match_places(places: DataFrame, file: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """``places`` with latitude, longitude and reason. ``file`` (id, name, latitude, longitude) is matched by
    id, else by name whatever its case (the smallest id of equal names)."""
    at = F.struct("latitude", "longitude")
    by_id = file.groupBy(P("id").alias("_i")).agg(F.min(F.struct("name", at.alias("at")))["at"].alias("_a"))
    by_name = file.groupBy(F.lower("name").alias("_n")).agg(F.min(F.struct("id", at.alias("at")))["at"].alias("_b"))
    out = places.join(by_id, P(id_col) == P("_i"), "left").join(by_name, F.lower(name_col) == P("_n"), "left")
    found = F.coalesce("_a", "_b")
    missing = found["latitude"].isNull() | found["longitude"].isNull()
    reason = F.when(found.isNull(), "no match").when(missing, "no coordinates").when(P("_a").isNotNull(), "id").otherwise("name")
    return out.select(*places.columns, F.when(~missing, found["latitude"]).alias("latitude"), F.when(~missing, found["longitude"]).alias("longitude"), reason.alias("reason"))


#: Texts of a position that mean a win.
WON = ("1", "WON")


def entity_from_documents(documents: DataFrame, array: str, id_col: str, as_of: Column, date: str = "race_date", days: Sequence[int] = (14, 30)) -> DataFrame:
    """Record of each entity out of documents that nest their runners: runs, wins, last run and last win with the days since, and runs,
    wins and win rate of the last ``days``. The entity's first own runner of a race's array is the one that counts.

    A position wins if it is, as text without blanks around it, 1 or WON. The first runner is found
    within the array, so that one shuffle by entity is all there is."""
    own = lambda x: x[id_col]
    first = F.filter(array, lambda x, i: own(x).isNotNull() & ~F.exists(F.slice(array, F.lit(1), i), lambda y: own(y) == own(x)))
    rows = documents.select(P(date), F.explode(first).alias("x")).select(P(f"x.{id_col}").alias(id_col), P(date).alias("_d"), F.coalesce(F.trim(P("x.position").cast("string")).isin(*WON), F.lit(False)).alias("_won"))
    inside = {d: P("_d") >= F.date_sub(as_of, d) for d in days}
    recent = [x for d, c in inside.items() for x in (F.count_if(c).alias(f"runs_{d}d"), F.count_if(c & P("_won")).alias(f"wins_{d}d"))]
    out = rows.groupBy(id_col).agg(F.count(F.lit(1)).alias("runs"), F.count_if("_won").alias("wins"), F.max("_d").alias("last_run"), F.max(F.when(P("_won"), P("_d"))).alias("last_win"), *recent)
    since = {"days_since_run": F.datediff(as_of, "last_run"), "days_since_win": F.datediff(as_of, "last_win")}
    return out.withColumns(since | {f"win_rate_{d}d": rate(P(f"wins_{d}d"), P(f"runs_{d}d")) for d in days})


def races_without(rows: DataFrame, columns: Sequence[str], key: str = "race_id") -> DataFrame:
    """Races with a runner that lacks all of ``columns``."""
    lacking = F.lit(True)
    for c in columns:
        lacking &= P(c).isNull()
    return rows.where(lacking).select(key).distinct()


def fill_from_results(rows: DataFrame, results: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fill missing ``columns`` from the results' row of the same keys, where that row has any."""
    some = F.lit(False)
    for c in columns:
        some |= P(c).isNotNull()
    other = results.where(some).select(*keys, *[P(c).alias(f"_r_{c}") for c in columns])
    out = rows.join(other, list(keys), "left")
    return out.select(*[F.coalesce(c, f"_r_{c}").alias(c) if c in columns else P(c) for c in rows.columns])


def update_sequence(number: Column, least: int = 48) -> Column:
    """``n/total`` of a race's updates."""
    return F.concat(number.cast("string"), F.lit("/"), F.greatest(number, F.lit(least)).cast("string"))
