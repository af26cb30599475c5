"""Registered queries over tables that are kept up from batch to batch, and over whole rule lists, each
beside DuckDB SQL of the same result computed at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsers as S
from ..operators import aggregates as A
from ..operators import entities as E
from ..operators import features as X
from ..operators import quality as Q
from ..operators import states as T
from ..operators import windows as W
from ..sources import documents, landed, sinks
from ..sources.keyed_table import KeyedTable
from ..sources.shared import shared_folder
from ..streaming import results as R
from .feature_queries import _features_sql, _record_sql
from .register import query
from .views import Views

P = F.col
COUNTS = "count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, count(*) FILTER (WHERE position = 2) AS seconds, count(*) FILTER (WHERE position = 3) AS thirds"
RATES = "round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate, round(100.0::DOUBLE * count(*) FILTER (WHERE position <= 3) / count(*), 2) AS place_rate"

# -- keyed table -----------------------------------------------------------------------------------


def keyed_events(v: Views) -> KeyedTable:
    """The events merged in four batches, with a compaction between."""
    table = KeyedTable(v.spark, shared_folder(v.spark, "events-by-user"), ["user_id", "event_type"], "ts", ["event_id"], buckets=8)
    for part in range(4):
        table.apply(v.table("events").where(P("event_id") % 4 == part).select("user_id", "event_type", "event_id", "value", "ts"), f"part {part}")
        if part == 1:
            table.compact(most=4)
    table.vacuum()
    return table


query("keyed_table_latest", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, (event_id % 4) DESC, event_id DESC) AS r FROM events) WHERE r = 1", False)(
    lambda v: keyed_events(v).read().select("user_id", "event_type", "event_id", "value")
)
query("keyed_table_lookup", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, (event_id % 4) DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND (user_id, event_type) IN (SELECT user_id, event_type FROM events WHERE value > 90)", False)(
    lambda v: (lambda asked: keyed_events(v).lookup(asked).select("user_id", "event_type", "event_id", "value"))(v.table("events").where("value > 90").select("user_id", "event_type"))
)

# -- late results ------------------------------------------------------------------------------------

ENTRIES = "race_id, horse_id, race_date::TIMESTAMP AS off_at"
query(
    "settled_results",
    "WITH e AS (SELECT race_id, horse_id, race_date::TIMESTAMP AS off_at FROM runs), r AS (SELECT race_id AS rid, horse_id AS hid, position, race_date::TIMESTAMP + to_days((race_id % 9)::INT) AS received_at FROM runs WHERE position IS NOT NULL), m AS (SELECT least((SELECT max(off_at) FROM e), (SELECT max(received_at) FROM r)) - INTERVAL 1 DAY AS mark) SELECT e.race_id, e.horse_id, e.off_at, position, received_at FROM e LEFT JOIN r ON rid = race_id AND hid = horse_id AND received_at BETWEEN off_at AND off_at + INTERVAL 7 DAY, m WHERE rid IS NOT NULL OR off_at + INTERVAL 7 DAY < mark",
)(
    lambda v: R.settled_results(
        v.runs.select("race_id", "horse_id", P("race_date").cast("timestamp_ntz").alias("off_at")),
        v.runs.where("position is not null").select("race_id", "horse_id", "position", (P("race_date").cast("timestamp_ntz") + F.make_dt_interval((P("race_id") % 9).cast("int"))).alias("received_at")),
        ["race_id", "horse_id"], "off_at", "received_at",
    )
)

# -- states ------------------------------------------------------------------------------------------


def kept_states(v: Views, key: str) -> DataFrame:
    """States of all runs up to the last week, whose entries are then replaced by their results, a day at a time."""
    path = shared_folder(v.spark, f"states-{key}")
    rows = v.runs.select(key, "race_date", "position")
    last = F.date_sub(v.as_of, 6)
    entries = rows.withColumn("position", F.when(P("race_date") < last, P("position")))
    T.write_states(T.month_states(entries, key), path)
    for back in (6, 3, 0):
        days = rows.where(P("race_date").between(F.date_sub(v.as_of, back), F.date_sub(v.as_of, max(0, back - 2))))
        T.refresh_states(path, days.withColumn("position", F.lit(None).cast("int")), days, key)
    return T.read_states(v.spark, path, rows.schema[key].dataType.simpleString(), key)


for kind, key in (("jockey", "jockey_id"), ("owner", "owner_id")):
    query(f"states_lifetime_{kind}", f"SELECT {key}, {COUNTS}, max(race_date) AS last_run, max(race_date) FILTER (WHERE position = 1) AS last_win, {RATES} FROM runs GROUP BY {key}")(
        lambda v, key=key: T.lifetime_from_states(kept_states(v, key), key)
    )
recent = ", ".join(f"count(*) FILTER (WHERE race_date >= d - {n}) AS runs_{n}d, count(*) FILTER (WHERE race_date >= d - {n} AND position = 1) AS wins_{n}d" for n in (14, 30))
RECENT_RATES = ", ".join(f"CASE WHEN runs_{n}d > 0 THEN round(100.0::DOUBLE * wins_{n}d / runs_{n}d, 2) END AS win_rate_{n}d" for n in (14, 30))
query("states_recent_form", f"SELECT *, {RECENT_RATES} FROM (SELECT jockey_id, {recent} FROM runs, ended WHERE race_date >= d - 30 GROUP BY jockey_id)")(
    lambda v: T.recent_form_from_states(kept_states(v, "jockey_id"), "jockey_id", v.as_of)
)


def horse_sets(v: Views) -> DataFrame:
    """The owners' sets of horses by month, old months and the last one merged."""
    old, new = (v.runs.where(c) for c in (P("race_date") < F.date_sub(v.as_of, 30), P("race_date") >= F.date_sub(v.as_of, 40)))
    return T.merge_distinct(T.distinct_states(old, "owner_id", "horse_id"), T.distinct_states(new, "owner_id", "horse_id"), key="owner_id")


query("merged_total_horses", "SELECT owner_id, count(DISTINCT horse_id) AS total_horses FROM runs GROUP BY 1")(lambda v: T.distinct_from_states(horse_sets(v), "owner_id", "total_horses"))

# -- form before a race ------------------------------------------------------------------------------

FRAMES = {"before": "UNBOUNDED PRECEDING", "14d": "INTERVAL 14 DAY PRECEDING", "30d": "INTERVAL 30 DAY PRECEDING"}
for kind in ("jockey", "trainer"):
    cells = ", ".join(f"count(position) OVER (w RANGE BETWEEN {f} AND INTERVAL 1 DAY PRECEDING) AS runs_{n}, count(CASE WHEN position = 1 THEN 1 END) OVER (w RANGE BETWEEN {f} AND INTERVAL 1 DAY PRECEDING) AS wins_{n}" for n, f in FRAMES.items())
    shares = ", ".join(f"CASE WHEN runs_{n} > 0 THEN round(100.0::DOUBLE * wins_{n} / runs_{n}, 2) END AS win_rate_{n}" for n in FRAMES)
    cells = cells.replace("(w RANGE", f"(PARTITION BY {kind}_id ORDER BY race_date RANGE")
    query(f"form_before_{kind}", f"SELECT *, {shares} FROM (SELECT race_id, horse_id, {kind}_id, {cells} FROM runs)")(lambda v, key=f"{kind}_id": W.form_before(v.runs, key))

# -- landed runs -------------------------------------------------------------------------------------

# the same results as by recent_form_trainer, runner_statistics and feature_rows, without their scans and shuffles
query("landed_recent_form_trainer", f"SELECT *, {RECENT_RATES} FROM (SELECT trainer_id, {recent} FROM runs, ended WHERE position IS NOT NULL AND race_date >= d - 30 GROUP BY trainer_id)")(
    lambda v: A.recent_form(landed.between(v.landed, first=F.date_sub(v.as_of, 30)), "trainer_id", v.as_of)
)
query("landed_runner_statistics", _record_sql())(lambda v: X.runner_statistics(v.landed, v.as_of, dealt=True))
query("landed_feature_rows", _features_sql())(lambda v: X.feature_rows(v.landed, dealt=True))
query("landed_days_of_region", "SELECT race_id, horse_id, race_date FROM runs WHERE race_date IN (SELECT race_date FROM races, ended WHERE region = 'ASIA' AND race_date >= d - 20)")(
    lambda v: landed.on_days_of(v.landed, v.races.where((P("region") == "ASIA") & (P("race_date") >= F.date_sub(v.as_of, 20)))).select("race_id", "horse_id", "race_date")
)

# -- payloads and documents --------------------------------------------------------------------------

PAYLOAD = "SELECT race_id, horse_id, CASE WHEN race_id % 3 > 0 THEN (race_id % 60)::VARCHAR WHEN race_id % 6 = 0 THEN '9-4' END AS weight_lbs, position_raw AS t, sp_decimal::VARCHAR AS sp_dec, (horse_id % 40)::VARCHAR || '.5' AS ovr_btn, CASE WHEN horse_id % 2 = 0 THEN '7' ELSE '' END AS jockey_claim_lbs, going AS comment, prize_won, position FROM runs"


def payload_rows(v: Views) -> DataFrame:
    """Runs with a JSON payload; every fifth has its weight already, every seventh payload is broken."""
    cells = F.struct(
        F.when(P("race_id") % 3 > 0, (P("race_id") % 60).cast("string")).when(P("race_id") % 6 == 0, "9-4").alias("weight_lbs"), P("position_raw").alias("time"), P("sp_decimal").cast("string").alias("sp_dec"),
        F.concat((P("horse_id") % 40).cast("string"), F.lit(".5")).alias("ovr_btn"), F.when(P("horse_id") % 2 == 0, "7").otherwise("").alias("jockey_claim_lbs"), F.lit("9-7").alias("weight"), P("going").alias("comment"),
        F.concat(F.lit("https://silks/"), P("horse_id").cast("string")).alias("silk_url"), P("position_raw").alias("form_string"), F.concat(F.lit("£1,"), F.lpad((P("race_id") % 1000).cast("string"), 3, "0"), F.lit(".50")).alias("prize"),
    )
    payload = F.when(P("race_id") % 7 == 0, "{broken").otherwise(F.to_json(cells))
    return v.runs.select("race_id", "horse_id", F.when(P("horse_id") % 5 == 0, 1).cast("int").alias("weight"), payload.alias("payload"))


WHOLE = "race_id % 7 > 0"
query(
    "payload_fields",
    f"SELECT race_id, horse_id, coalesce(CASE WHEN horse_id % 5 = 0 THEN 1 END, CASE WHEN {WHOLE} AND race_id % 3 > 0 THEN (race_id % 60)::INT END)::INT AS weight, CASE WHEN {WHOLE} THEN position_raw END AS finishing_time, CASE WHEN {WHOLE} THEN sp_decimal END AS starting_price_decimal, CASE WHEN {WHOLE} THEN horse_id % 40 + 0.5::DOUBLE END AS overall_beaten_distance, CASE WHEN {WHOLE} AND horse_id % 2 = 0 THEN 7 END AS jockey_claim_lbs, CASE WHEN {WHOLE} THEN '9-7' END AS weight_stones_lbs, CASE WHEN {WHOLE} THEN going END AS race_comment, CASE WHEN {WHOLE} THEN 'https://silks/' || horse_id END AS jockey_silk_url, CASE WHEN {WHOLE} THEN position_raw END AS form, CASE WHEN {WHOLE} THEN 1000 + race_id % 1000 + 0.5::DOUBLE END AS prize_money_won FROM runs",
)(lambda v: sinks.typed_payloads(payload_rows(v), "payload").drop("payload"))


def result_documents(v: Views) -> DataFrame:
    """The runs nested by race as result documents, written as JSON text and parsed again."""
    text = lambda c: P(c).cast("string")
    runner = F.struct(text("horse_id").alias("horse_id"), text("jockey_id").alias("jockey_id"), F.lit(" ").alias("owner_id"), P("position_raw").alias("position"), text("sp_decimal").alias("sp_dec"), F.concat(F.lit("1:0"), text("rank"), F.lit(".5")).alias("time"), F.concat(F.lit("£"), text("prize_won")).alias("prize"), F.lit("-").alias("or"))
    rows = v.runs.withColumn("rank", F.coalesce("position", F.lit(9)))
    races = rows.groupBy("race_id", "race_date").agg(F.sort_array(F.collect_list(runner)).alias("runners"))
    line = F.to_json(F.struct(text("race_id").alias("race_id"), text("race_date").alias("date"), F.lit("Class 2").alias("class"), F.lit("1m2f").alias("dist"), "runners"))
    return races.select(F.from_json(line, documents.RESULT_SCHEMA).alias("d")).select("d.*")


def detailed_documents(v: Views) -> DataFrame:
    """Results that carry draw, ratings and names; every fourth race has none."""
    text = lambda c: P(c).cast("string")
    runner = F.struct(
        text("horse_id").alias("horse_id"), F.concat(F.lit("Horse "), text("horse_id")).alias("horse"), F.concat(F.lit("J "), text("jockey_id")).alias("jockey"), (P("horse_id") % 16).cast("string").alias("draw"),
        F.when(P("horse_id") % 3 == 0, "–").otherwise((40 + P("horse_id") % 60).cast("string")).alias("or"), (50 + P("horse_id") % 50).cast("string").alias("rpr"), F.lit("9-2").alias("weight"), F.lit("128").alias("weight_lbs"), F.when(P("horse_id") % 5 == 0, "b").alias("headgear"),
    )
    races = v.runs.where("race_id % 4 > 0").groupBy("race_id", "race_date").agg(F.collect_list(runner).alias("runners"))
    line = F.to_json(F.struct(text("race_id").alias("race_id"), text("race_date").alias("date"), "runners"))
    return races.select(F.from_json(line, documents.RESULT_SCHEMA).alias("d")).select("d.*")


HAS = "race_id % 4 > 0"
query(
    "feature_details",
    f"SELECT race_id, horse_id, count(*) OVER (PARTITION BY horse_id ORDER BY race_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS total_races, CASE WHEN {HAS} THEN (horse_id % 16)::VARCHAR END AS draw, CASE WHEN {HAS} AND horse_id % 3 > 0 THEN (40 + horse_id % 60)::INT END AS ofr, CASE WHEN {HAS} THEN (50 + horse_id % 50)::INT END AS rpr, CASE WHEN {HAS} THEN 128 END AS weight_lbs, CASE WHEN {HAS} AND horse_id % 5 = 0 THEN 'b' END AS headgear, CASE WHEN {HAS} THEN 'Horse ' || horse_id END AS horse_name, CASE WHEN {HAS} THEN 'J ' || jockey_id END AS jockey_name FROM runs",
)(
    lambda v: X.with_runner_details(X.feature_rows(v.runs).select("race_id", "horse_id", "total_races"), documents.result_runners(detailed_documents(v)), ("draw", "ofr", "rpr", "weight_lbs", "headgear", "horse_name", "jockey_name"))
)
query("documents_result_races", "SELECT race_id::VARCHAR AS race_id, race_date, 2 AS race_class, 2011 AS distance_m, count(*) AS field_size, max(CASE WHEN position = 1 THEN '1:01.5' END) AS winning_time FROM runs GROUP BY race_id, race_date")(
    lambda v: documents.result_races(result_documents(v)).select("race_id", "race_date", "race_class", "distance_m", "field_size", "winning_time")
)
query("documents_result_runners", "SELECT race_id::VARCHAR AS race_id, race_date, horse_id::VARCHAR AS horse_id, jockey_id::VARCHAR AS jockey_id, NULL::VARCHAR AS owner_id, position, position::VARCHAR AS position_str, position IS NULL AS did_not_finish, sp_decimal AS starting_price_decimal, 60.5 + coalesce(position, 9) AS time_seconds, prize_won FROM runs")(
    lambda v: documents.result_runners(result_documents(v)).select("race_id", "race_date", "horse_id", "jockey_id", "owner_id", "position", "position_str", "did_not_finish", "starting_price_decimal", "time_seconds", "prize_won")
)
def card_documents(v: Views) -> DataFrame:
    """The runs nested by race as pre-race documents; every tenth horse and every ninth race has a blank id."""
    text = lambda c: P(c).cast("string")
    runner = F.struct(F.when(P("horse_id") % 10 == 0, " ").otherwise(text("horse_id")).alias("horse_id"), text("jockey_id").alias("jockey_id"), F.lit("").alias("trainer_id"), F.lit("126").alias("lbs"), (P("horse_id") % 9).cast("string").alias("age"), F.lit("–").alias("ofr"), (P("horse_id") % 2 == 0).alias("is_scratched"))
    races = v.runs.groupBy("race_id", "race_date", "distance_f", "going").agg(F.sort_array(F.collect_list(runner)).alias("runners"))
    line = F.to_json(F.struct(F.when(P("race_id") % 9 == 0, "").otherwise(text("race_id")).alias("race_id"), text("race_date").alias("date"), F.lit("Class 4").alias("race_class"), F.concat(text("distance_f"), F.lit("f")).alias("distance"), text("distance_f").alias("distance_f"), "going", F.lit("£9,300").alias("prize"), "runners"))
    return races.select(F.from_json(line, documents.CARD_SCHEMA).alias("d")).select("d.*")


query("documents_card_races", "SELECT race_id::VARCHAR AS race_id, race_date, 4 AS race_class, distance_f::DOUBLE AS distance_f, (distance_f * 201)::INT AS distance_m, going, 9300.0::DOUBLE AS prize, count(*) AS field_size, false AS has_result FROM runs WHERE race_id % 9 > 0 GROUP BY race_id, race_date, distance_f, going")(
    lambda v: documents.card_races(card_documents(v)).select("race_id", "race_date", "race_class", "distance_f", "distance_m", "going", "prize", "field_size", "has_result")
)
query("documents_card_runners", "SELECT race_id::VARCHAR AS race_id, horse_id::VARCHAR AS horse_id, jockey_id::VARCHAR AS jockey_id, NULL::VARCHAR AS trainer_id, 126 AS weight_lbs, (horse_id % 9)::INT AS age, NULL::INT AS ofr, horse_id % 2 = 0 AS is_scratched FROM runs WHERE race_id % 9 > 0 AND horse_id % 10 > 0")(
    lambda v: documents.card_runners(card_documents(v)).select("race_id", "horse_id", "jockey_id", "trainer_id", "weight_lbs", "age", "ofr", "is_scratched")
)
query("documents_courses", "SELECT n_nationkey::VARCHAR AS id, n_name || '-AW' AS name, r_name AS region, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey + 0.5 END AS latitude, CASE WHEN n_nationkey % 3 > 0 THEN -n_nationkey - 0.5 END AS longitude FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 7 > 0", False)(
    lambda v: (lambda n: documents.course_rows(
        n.select(F.from_json(F.to_json(F.struct(F.when(P("n_nationkey") % 7 == 0, " ").otherwise(P("n_nationkey").cast("string")).alias("id"), F.concat("n_name", F.lit("-AW")).alias("course"), P("r_name").alias("region"))), documents.COURSE_SCHEMA).alias("d")).select("d.*"),
        n.where("n_nationkey % 3 > 0").select(P("n_name").alias("name"), F.lower("r_name").alias("region"), (P("n_nationkey") + 0.5).alias("latitude"), (-P("n_nationkey") - 0.5).alias("longitude")),
    ).select("id", "name", "region", "latitude", "longitude"))(v.table("nation").join(v.table("region"), P("n_regionkey") == P("r_regionkey")))
)
#: Raw texts of six kinds, dealt out by race, and what the parsers make of them.
TEXTS = {
    "strict_position": (S.strict_position, ("3rd", " 4 ", "PU", "7", "", "+2"), ("NULL", "4", "NULL", "7", "NULL", "2"), "INT"),
    "beaten": (S.beaten_distance, ("0", ".5", "2.75", "48", "nk", ""), ("'0'", "'0.5L'", "'2.75L'", "'48L'", "'nk'", "NULL"), "VARCHAR"),
    "price": (S.text, (" 7/2 ", "11/10J", "", "Evs", "  ", "4/1"), ("'7/2'", "'11/10J'", "NULL", "'Evs'", "NULL", "'4/1'"), "VARCHAR"),
    "rating": (S.rating, ("92", "–", "-", "N/A", "", " 70 "), ("92", "NULL", "NULL", "NULL", "NULL", "70"), "INT"),
    "decimal": (S.decimal, ("6.20", "3L", "27L", "-", "abc", "NaN"), ("6.2", "3", "27", "NULL", "NULL", "NULL"), "DOUBLE"),
    "seconds": (S.seconds, ("1:36.25", "3:10.5", "58.4", "x", "", "2:00"), ("96.25", "190.5", "58.4", "NULL", "NULL", "120"), "DOUBLE"),
    "furlongs": (S.furlongs, ("8f", "6.5f", "", "f", "12f", "7"), ("8", "6.5", "NULL", "NULL", "12", "7"), "DOUBLE"),
}
query(
    "parsed_runner_texts",
    "SELECT race_id, horse_id, " + ", ".join(f"([{', '.join(want)}]::{kind}[])[race_id % 6 + 1] AS {name}" for name, (_, _, want, kind) in TEXTS.items()) + ", position AS placed, CASE WHEN horse_id % 40 = 0 THEN '0' WHEN horse_id % 4 = 0 THEN (horse_id % 40 // 4) || 'L' ELSE (horse_id % 40 / 4.0)::DOUBLE || 'L' END AS margin FROM runs",
)(
    lambda v: v.runs.select(
        "race_id", "horse_id", *[parse(F.element_at(F.array(*map(F.lit, texts)), (P("race_id") % 6 + 1).cast("int"))).alias(name) for name, (parse, texts, _, _) in TEXTS.items()],
        S.strict_position(P("position_raw")).alias("placed"), S.beaten_distance((P("horse_id") % 40 / 4).cast("string")).alias("margin"),
    )
)
FIRST = "SELECT jockey_id, race_date, position_raw, row_number() OVER (PARTITION BY race_id, jockey_id ORDER BY horse_id) AS nth FROM runs"
query(
    "entity_from_documents",
    f"SELECT *, datediff('day', last_run, d)::INT AS days_since_run, datediff('day', last_win, d)::INT AS days_since_win, {RECENT_RATES} FROM (SELECT jockey_id, count(*) AS runs, count(*) FILTER (WHERE position_raw = '1') AS wins, max(race_date) AS last_run, max(race_date) FILTER (WHERE position_raw = '1') AS last_win, {recent.replace('AND position = 1', chr(65) + 'ND position_raw = ' + chr(39) + '1' + chr(39))} FROM ({FIRST}), ended WHERE nth = 1 GROUP BY 1), ended".replace("SELECT *, datediff", "SELECT * EXCLUDE (d), datediff"),
)(
    lambda v: E.entity_from_documents(
        v.runs.groupBy("race_id", "race_date").agg(F.sort_array(F.collect_list(F.struct("horse_id", "jockey_id", F.when((P("position") == 1) & (P("race_id") % 2 == 0), " WON ").otherwise(P("position_raw")).alias("position")))).alias("runners")), "runners", "jockey_id", v.as_of
    )
)

# -- rules and reports -------------------------------------------------------------------------------

KEYS = (
    ("customer.c_nationkey", "customer", "c_nationkey", "nation", "n_nationkey"), ("nation.n_regionkey", "nation", "n_regionkey", "region", "r_regionkey"), ("supplier.s_nationkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"), ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"), ("events.user_id", "events", "user_id", "customer", "c_custkey"), ("labels.doc_id", "labels", "doc_id", "documents", "doc_id"), ("documents.doc_id", "documents", "doc_id", "labels", "doc_id"),
)


def all_references(v: Views) -> DataFrame:
    tables = {t: v.table(t) for rule in KEYS for t in (rule[1], rule[3])}
    return Q.reference_report([(name, tables[child], column, tables[parent], key) for name, child, column, parent, key in KEYS])


query(
    "dq_all_references",
    " UNION ALL ".join(f"SELECT '{name}' AS rule, count({c}) AS n_references, count({c}) FILTER (WHERE {c} NOT IN (SELECT {k} FROM {parent})) AS n_orphans, count(DISTINCT {c}) FILTER (WHERE {c} NOT IN (SELECT {k} FROM {parent})) AS orphan_keys FROM {child}" for name, child, c, parent, k in KEYS),
    False,
)(all_references)
HEALTH = (("orders", "o_orderdate", 400), ("events", "ts", 3), ("lineitem", "l_shipdate", 1))
STATES = " UNION ALL ".join(f"SELECT '{t}' AS table_name, max({c})::DATE AS latest, datediff('day', max({c})::DATE, DATE '2024-02-02')::INT AS age_days, {n} AS n FROM {t}" for t, c, n in HEALTH)
STATES = f"SELECT table_name, latest, age_days, CASE WHEN age_days <= n THEN 'fresh' WHEN age_days <= 1.5 * n THEN 'warning' ELSE 'stale' END AS state FROM ({STATES})"


def freshness_states(v: Views) -> DataFrame:
    return Q.overall_freshness([(t, v.table(t).select(F.to_date(c).alias("day")), "day", n) for t, c, n in HEALTH], F.lit("2024-02-02").cast("date"))


query("dq_freshness_tables", STATES, False)(freshness_states)
query("dq_health", f"SELECT count(*) AS tables, count(*) FILTER (WHERE state = 'fresh') AS fresh, count(*) FILTER (WHERE state = 'warning') AS warning, count(*) FILTER (WHERE state = 'stale') AS stale, 0 AS empty, round(count(*) FILTER (WHERE state = 'fresh') * 100.0::DOUBLE / count(*), 1) AS health_score, CASE WHEN count(*) FILTER (WHERE state = 'fresh') * 100.0 / count(*) >= 75 THEN 'pass' WHEN count(*) FILTER (WHERE state = 'fresh') * 100.0 / count(*) >= 50 THEN 'warning' ELSE 'fail' END AS result FROM ({STATES})", False)(
    lambda v: Q.health(freshness_states(v))
)
THIN = {"none": "CAST(NULL AS VARCHAR)", "few": "CASE WHEN doc_id % 20 = 0 THEN 'x' ELSE '' END", "half": "CASE WHEN doc_id % 3 = 0 THEN 'x' END", "full": "'x'"}
query(
    "dq_null_groups",
    "SELECT column_name, missing, n, CASE WHEN missing = n THEN 'entirely' WHEN missing * 100.0 / n >= 90 THEN 'mostly' ELSE 'partially' END AS null_group FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count(nullif({x}, '')) AS missing, count(*) AS n FROM documents" for c, x in THIN.items()) + ") WHERE missing * 100.0 / n >= 50",
    False,
)(lambda v: Q.null_groups(Q.column_population(v.table("documents").select(*[F.expr(x.replace("VARCHAR", "STRING")).alias(c) for c, x in THIN.items()]), blank_is_null=True)))
query("latest_updates", "SELECT c_custkey AS user_id, event_id, value, coalesce(event_type, 'never_updated') AS status FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) e ON user_id = c_custkey AND r = 1", False)(
    lambda v: Q.latest_updates(v.table("events").select("user_id", "event_id", "value", "ts", P("event_type").alias("status")), v.table("customer").select(P("c_custkey").alias("user_id")), "user_id", ["ts", "event_id"]).drop("ts")
)
query(
    "fill_together",
    "SELECT s_suppkey AS id, CASE WHEN t THEN c_acctbal ELSE a END AS sire, CASE WHEN t THEN -c_acctbal ELSE b END AS dam, CASE WHEN t THEN NULL ELSE c END AS damsire FROM (SELECT *, c_custkey IS NOT NULL AND (a IS NULL OR b IS NULL OR c IS NULL) AS t FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END AS a, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END AS b, s_acctbal AS c FROM supplier) LEFT JOIN customer ON c_custkey = s_suppkey AND c_custkey % 4 > 0)",
    False,
)(
    lambda v: sinks.fill_missing(
        v.table("supplier").select(P("s_suppkey").alias("id"), F.when(P("s_suppkey") % 2 == 0, P("s_acctbal")).alias("sire"), F.when(P("s_suppkey") % 3 == 0, P("s_acctbal")).alias("dam"), P("s_acctbal").alias("damsire")),
        v.table("customer").where("c_custkey % 4 > 0").select(P("c_custkey").alias("id"), P("c_acctbal").alias("sire"), (-P("c_acctbal")).alias("dam"), F.lit(None).cast("double").alias("damsire")), "id", ["sire", "dam", "damsire"], together=True,
    )
)
query("region_dimension", "SELECT upper(substr(n_name, 1, 1)) AS code, max(n_name) AS name FROM nation GROUP BY 1", False)(lambda v: E.regions(v.table("nation").select(F.upper(F.substring("n_name", 1, 1)).alias("region_code"), P("n_name").alias("region"))))
KIND = "['bet365', 'betfair', 'spreadex', 'nobody'][user_id % 4 + 1]"
query("events_by_bookmaker", f"SELECT b.code, coalesce(b.name, 'unknown') AS name, b.type, count(*) AS n FROM (SELECT {KIND} AS code FROM events) e LEFT JOIN (VALUES ('bet365', 'Bet365', 'online'), ('betfair', 'Betfair', 'exchange'), ('spreadex', 'Spreadex', 'spread')) b(code, name, type) ON e.code = b.code GROUP BY ALL", False)(
    lambda v: v.table("events").select(F.element_at(F.array(*map(F.lit, ("bet365", "betfair", "spreadex", "nobody"))), (P("user_id") % 4 + 1).cast("int")).alias("c")).join(F.broadcast(E.bookmakers(v.spark)), P("c") == P("code"), "left")
    .groupBy("code", F.coalesce("name", F.lit("unknown")).alias("name"), "type").agg(F.count(F.lit(1)).alias("n"))
)
query(
    "entity_view_jockey",
    f"SELECT s_suppkey AS jockey_id, s_name AS name, coalesce(l.runs, 0) AS runs, coalesce(l.wins, 0) AS wins, coalesce(l.places, 0) AS places, coalesce(l.win_rate, 0) AS win_rate, coalesce(l.place_rate, 0) AS place_rate, coalesce(f.runs_14d, 0) AS runs_14d, coalesce(f.wins_14d, 0) AS wins_14d, coalesce(f.runs_30d, 0) AS runs_30d, coalesce(f.wins_30d, 0) AS wins_30d, l.last_run, l.last_win FROM supplier LEFT JOIN (SELECT jockey_id, {COUNTS}, {RATES}, max(race_date) AS last_run, max(race_date) FILTER (WHERE position = 1) AS last_win FROM runs GROUP BY 1) l ON l.jockey_id = s_suppkey LEFT JOIN (SELECT jockey_id, {recent} FROM runs, ended WHERE position IS NOT NULL AND race_date >= d - 30 GROUP BY 1) f ON f.jockey_id = s_suppkey",
)(lambda v: A.entity_view(v.table("supplier").select(P("s_suppkey").alias("jockey_id"), P("s_name").alias("name")), v.runs, "jockey_id", v.as_of))
BAND = "CASE WHEN distance_f * 220 < 1400 THEN 'sprint' WHEN distance_f * 220 < 1800 THEN 'mile' WHEN distance_f * 220 < 2400 THEN 'middle' ELSE 'staying' END"
query("top_at_band", f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY band ORDER BY win_rate DESC, runs DESC, jockey_id)::INT AS rank FROM (SELECT jockey_id, {BAND} AS band, count(*) AS runs, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate FROM runs WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 10)) WHERE rank <= 3")(
    lambda v: W.top_by(A.performance(v.runs.withColumn("band", S.distance_band(P("distance_f") * 220)), ["jockey_id", "band"], 10).select("jockey_id", "band", "runs", "win_rate"), ["band"], [F.desc("win_rate"), F.desc("runs"), P("jockey_id")], 3, rank="rank")
)
query("arrival_last_week", "SELECT race_id, race_date, count(*) AS runners, count(position) AS results, count(position) = count(*) AS complete FROM runs, ended WHERE race_date >= d - 7 GROUP BY race_id, race_date")(lambda v: A.arrival(v.runs, v.as_of))
query("upcoming_races", "SELECT u.race_id, u.race_date, u.course_id, u.race_class, u.distance_f, u.surface, count(*) AS runners, round(avg(w), 4) AS mean_win_rate, round(avg(score), 4) AS mean_form FROM (SELECT runs.* FROM runs, ended WHERE race_date = d) u LEFT JOIN (SELECT horse_id, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS w FROM runs GROUP BY 1) USING (horse_id) LEFT JOIN (SELECT horse_id, round(sum(CASE position WHEN 1 THEN 10 WHEN 2 THEN 7 WHEN 3 THEN 5 WHEN 4 THEN 3 ELSE 1 END * CASE r WHEN 1 THEN 2.0 WHEN 2 THEN 1.5 WHEN 3 THEN 1.2 ELSE 1.0 END::DOUBLE) / 67 * 100, 2) AS score FROM (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC) AS r FROM runs WHERE position IS NOT NULL) WHERE r <= 5 GROUP BY 1) USING (horse_id) GROUP BY ALL")(
    lambda v: W.upcoming(v.runs, v.runs.where(P("race_date") == v.as_of))
)
query("history_array_totals", "SELECT horse_id, count(*) AS n, max(race_date) AS latest, arg_max(race_id, (race_date, race_id)) AS latest_race, sum(coalesce(position, 0))::BIGINT AS positions FROM runs GROUP BY 1")(
    lambda v: W.history_array(v.runs).select("horse_id", F.size("history").cast("bigint").alias("n"), P("history")[0]["race_date"].alias("latest"), P("history")[0]["race_id"].alias("latest_race"), F.aggregate("history", F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["position"], F.lit(0))).alias("positions"))
)
query("course_ids_in_region", "SELECT DISTINCT CAST(course_id AS VARCHAR) AS course_id FROM races WHERE lower(region) IN ('europe', 'asia')")(lambda v: v.races.where(S.in_region(P("region"), ("europe", "asia"))).select(P("course_id").cast("string").alias("course_id")).distinct())
query("table_coverage", "SELECT 'orders' AS table_name, count(*) AS n, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders UNION ALL SELECT 'events', count(*), min(ts)::DATE, max(ts)::DATE FROM events UNION ALL SELECT 'lineitem', count(*), min(l_shipdate)::DATE, max(l_shipdate)::DATE FROM lineitem", False)(
    lambda v: A.table_coverage([(t, v.table(t), c) for t, c in (("orders", "o_orderdate"), ("events", "ts"), ("lineitem", "l_shipdate"))])
)
query("stored_progeny_checked", "SELECT damsire_id, stored, progeny FROM (SELECT damsire_id, count(*) AS progeny FROM horses GROUP BY 1) JOIN (SELECT damsire_id, count(DISTINCT horse_id) AS stored FROM horses JOIN runs USING (horse_id) WHERE race_date >= (SELECT d - 10 FROM ended) GROUP BY 1) USING (damsire_id) WHERE stored <> progeny")(
    lambda v: Q.differing(
        v.runs.where(P("race_date") >= F.date_sub(v.as_of, 10)).select("horse_id").distinct().join(v.horses, "horse_id").groupBy("damsire_id").agg(F.count(F.lit(1)).alias("stored")),
        v.horses.groupBy("damsire_id").agg(F.count(F.lit(1)).alias("progeny")), "damsire_id", "stored", "progeny",
    )
)
