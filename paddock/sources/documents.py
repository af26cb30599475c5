"""Nested race documents (JSON) to flat race and runner tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsers as S
from ..operators.joins import add_coordinates

P = F.col

RUNNER = "horse_id string, horse string, jockey_id string, jockey string, trainer_id string, trainer string, trainer_location string, owner_id string, owner string, number string, draw string, sire_id string, sire string, dam_id string, dam string, damsire_id string, damsire string, age string, sex string, form string, rpr string, comment string"
RACE = "race_id string, course_id string, course string, region string, race_name string, date string, off_dt string, type string, surface string, going string, dist_m string, prize string, is_abandoned boolean"
CARD_SCHEMA = f"{RACE}, off_time string, race_class string, distance string, distance_f string, runners array<struct<{RUNNER}, lbs string, ofr string, ts string, is_scratched boolean>>, _corrupt_record string"
RESULT_SCHEMA = f"{RACE}, off string, class string, dist string, dist_f string, winning_time_detail string, runners array<struct<{RUNNER}, position string, btn string, ovr_btn string, sp string, sp_dec string, time string, `or` string, tsr string, weight_lbs string, weight string, headgear string, margin string, prize string, jockey_claim string, silk_url string>>, _corrupt_record string"


COURSE_SCHEMA = "id string, course string, region_code string, region string, _corrupt_record string"


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents with a fixed schema; lines that don't parse are dropped with no race id."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def _ids(c: str):
    return F.nullif(F.trim(P(c)), F.lit(""))


def course_rows(docs: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Course rows with coordinates by the name's key and the region; ``coordinates``: a small file of
    name, region, latitude, longitude."""
    rows = docs.where(_ids("id").isNotNull()).select(_ids("id").alias("id"), P("course").alias("name"), "region_code", "region", F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))
    return add_coordinates(rows, coordinates, [S.course_key(P("name")), F.upper("region")], [S.course_key(P("name")), F.upper("region")])


def card_races(docs: DataFrame) -> DataFrame:
    """Race rows of pre-race documents."""
    return docs.where(_ids("race_id").isNotNull()).select(
        _ids("race_id").alias("race_id"), _ids("course_id").alias("course_id"), P("course").alias("course_name"), "region", "race_name", P("date").try_cast("date").alias("race_date"),
        P("off_time"), P("type").alias("race_type"), S.race_class(P("race_class")).alias("race_class"), P("distance").alias("distance_text"), S.decimal(P("distance_f")).alias("distance_f"),
        F.coalesce(S.integer(P("dist_m")), S.metres(P("distance"))).alias("distance_m"), "surface", "going", S.money(P("prize")).alias("prize"),
        F.coalesce(F.size("runners"), F.lit(0)).alias("field_size"), F.lit(False).alias("has_result"), F.coalesce("is_abandoned", F.lit(False)).alias("is_abandoned"),
    )


def result_races(docs: DataFrame) -> DataFrame:
    """Race rows of results, with the time of the runner in first position."""
    winner = F.get(F.filter("runners", lambda r: F.trim(r["position"]) == "1"), F.lit(0))
    return docs.where(_ids("race_id").isNotNull()).select(
        _ids("race_id").alias("race_id"), _ids("course_id").alias("course_id"), P("course").alias("course_name"), "region", "race_name", P("date").try_cast("date").alias("race_date"),
        P("off").alias("off_time"), P("type").alias("race_type"), S.race_class(P("class")).alias("race_class"), P("dist").alias("distance_text"), S.decimal(P("dist_f")).alias("distance_f"),
        F.coalesce(S.integer(P("dist_m")), S.metres(P("dist"))).alias("distance_m"), "surface", "going", S.money(P("prize")).alias("prize"),
        F.coalesce(F.size("runners"), F.lit(0)).alias("field_size"), F.lit(True).alias("has_result"), F.coalesce("is_abandoned", F.lit(False)).alias("is_abandoned"), winner["time"].alias("winning_time"),
    )


def _runner_columns(weight: str, official: str, speed: str) -> list:
    ids = ("horse_id", "jockey_id", "trainer_id", "owner_id", "sire_id", "dam_id", "damsire_id")
    return [
        P("race_id"), *[_ids(c).alias(c) for c in ids], P("horse").alias("horse_name"), P("jockey").alias("jockey_name"), P("trainer").alias("trainer_name"), P("trainer_location"), P("owner").alias("owner_name"),
        P("number"), P("draw"), S.integer(P(weight)).alias("weight_lbs"), S.integer(P("age")).alias("age"), P("sex"), S.rating(P(official)).alias("ofr"), S.rating(P("rpr")).alias("rpr"), S.rating(P(speed)).alias("ts"),
    ]


def card_runners(docs: DataFrame) -> DataFrame:
    """One row for each runner of pre-race documents; runners without a horse id go."""
    rows = docs.where(_ids("race_id").isNotNull()).select(_ids("race_id").alias("race_id"), F.inline("runners"))
    return rows.where(_ids("horse_id").isNotNull()).select(*_runner_columns("lbs", "ofr", "ts"), F.coalesce("is_scratched", F.lit(False)).alias("is_scratched"))


def normalise_runners(rows: DataFrame) -> list:
    """All parsed result columns of a raw runner."""
    return [
        S.position(P("position")).alias("position"), P("position").alias("position_raw"), S.did_not_finish(P("position")).alias("did_not_finish"), S.beaten_distance(P("btn")).alias("distance_beaten"),
        S.text(P("sp")).alias("starting_price"), S.decimal(P("sp_dec")).alias("starting_price_decimal"), P("time").alias("finishing_time"), S.seconds(P("time")).alias("time_seconds"),
    ]


def _result_columns() -> list:
    """What results have beside the parsed outcome."""
    place = S.position(P("position"))
    return [
        S.text(P("weight")).alias("weight_st_lbs"), P("headgear"), F.when(place != 0, place.cast("string")).alias("position_str"), S.decimal(P("ovr_btn")).alias("ovr_btn"), S.decimal(P("margin")).alias("margin"),
        S.money(P("prize")).alias("prize_won"), S.text(P("comment")).alias("comment"), S.integer(P("jockey_claim")).alias("jockey_claim_lbs"), P("silk_url"),
    ]


def result_runners(docs: DataFrame, received: str | None = None) -> DataFrame:
    """One row for each runner of results: race and date, identification, details, pedigree ids, parsed outcomes."""
    rows = docs.where(_ids("race_id").isNotNull()).select(_ids("race_id").alias("race_id"), P("date").try_cast("date").alias("race_date"), F.inline("runners"))
    out = rows.where(_ids("horse_id").isNotNull()).select(P("race_date"), *_runner_columns("weight_lbs", "or", "tsr"), *normalise_runners(rows), *_result_columns())
    if received:
        out = out.withColumn("result_updated_at", F.when(P("position").isNotNull(), F.lit(received).cast("timestamp")))
    return out
