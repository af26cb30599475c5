"""Registered queries of wide rows, profiles, entities and their checks, each beside DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsers as S
from ..operators import aggregates as A
from ..operators import entities as E
from ..operators import features as X
from ..operators import joins as J
from ..operators import pedigree as G
from ..operators import profiles as B
from ..operators import quality as Q
from ..operators import reports as R
from ..operators import windows as W
from ..sources import sinks
from .register import query
from .views import Views

P = F.col
CLASS_RATE = "CASE race_class WHEN 1 THEN 0.10 WHEN 2 THEN 0.11 WHEN 3 THEN 0.12 WHEN 4 THEN 0.13 WHEN 5 THEN 0.14 WHEN 6 THEN 0.15 WHEN 7 THEN 0.16 ELSE 0.125 END::DOUBLE"
DISTANCE_RATE = "CASE WHEN distance_f <= 7 THEN 0.12 WHEN distance_f <= 10 THEN 0.13 WHEN distance_f <= 14 THEN 0.12 ELSE 0.11 END::DOUBLE"
AW, JUMPS = "lower(surface) IN ('aw', 'all weather', 'tapeta', 'polytrack')", "lower(surface) IN ('hurdle', 'chase', 'nh flat')"

# -- wide rows of runs ----------------------------------------------------------------------------


def _record(name: str, condition: str, over: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {condition} AND {c}) OVER ({over}) AS {name}_{k}" for k, c in (("runs", "true"), ("wins", "position = 1"), ("2nds", "position = 2"), ("3rds", "position = 3")))


def _record_sql() -> str:
    horse = "PARTITION BY horse_id"
    parts = [_record(n, "true", f"{horse}, {', '.join(keys)}") for n, keys in X.RECORD_CONTEXTS.items()]
    parts += [_record(g, f"lower(going) LIKE '%{g}%'", horse) for g in X.GOINGS]
    parts += [_record("aw", AW, horse), _record("jumps", JUMPS, horse), _record("last_10", "nth <= 10", horse), _record("last_12m", "race_date >= d - 365", horse)]
    return (
        "SELECT *, round(100.0::DOUBLE * career_wins / career_runs, 2) AS career_win_percent, round(100.0::DOUBLE * career_places / career_runs, 2) AS career_place_percent FROM ("
        "SELECT race_id, horse_id, count(*) OVER h AS career_runs, count(*) FILTER (WHERE position = 1) OVER h AS career_wins, count(*) FILTER (WHERE position <= 3) OVER h AS career_places, round(sum(prize_won) OVER h, 2) AS career_prize, "
        + ", ".join(parts)
        + ", max(race_date) OVER h AS last_raced, max(race_date) FILTER (WHERE position = 1) OVER h AS last_won FROM (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC) AS nth FROM runs, ended WHERE position IS NOT NULL) WINDOW h AS (PARTITION BY horse_id))"
    )


query("runner_statistics", _record_sql())(lambda v: X.runner_statistics(v.runs, v.as_of))
query("top_performers", f"SELECT race_id, horse_id, career_runs, career_win_percent FROM ({_record_sql()}) WHERE career_win_percent >= 20 ORDER BY career_win_percent DESC, career_runs DESC, race_id, horse_id LIMIT 10")(
    lambda v: X.runner_statistics(v.runs, v.as_of).where("career_win_percent >= 20").select("race_id", "horse_id", "career_runs", "career_win_percent").orderBy(F.desc("career_win_percent"), F.desc("career_runs"), "race_id", "horse_id").limit(10)
)


def _features_sql() -> str:
    contexts = {n: f"b.{k[0]} = a.{k[0]}" for n, k in X.HISTORY_CONTEXTS.items()} | {"distance": "b.distance_f BETWEEN a.distance_f * 0.9 AND a.distance_f * 1.1"}
    relations = {n: " AND ".join(f"b.{k} = a.{k}" for k in keys) for n, keys in X.RELATIONS.items()}
    n = lambda c: f"count(*) FILTER (WHERE {c})"
    cells = ["count(b.horse_id) AS total_races"] + [f"{n(f'b.position = {i}')} AS total_{k}" for i, k in ((1, "wins"), (2, "seconds"), (3, "thirds"))] + [f"{n('b.position <= 3')} AS total_places"]
    cells += ["round(avg(b.position), 2) AS avg_finish_position", "datediff('day', max(b.race_date), any_value(a.race_date))::INT AS days_since_last_run"]
    rate = lambda part, whole: f"CASE WHEN {whole} > 0 THEN round(100.0::DOUBLE * {part} / {whole}, 2) END"
    for name, c in contexts.items():
        cells += [f"{n(c)} AS {name}_runs", f"{n(c + ' AND b.position = 1')} AS {name}_wins", f"{n(c + ' AND b.position <= 3')} AS {name}_places"]
    for name, c in relations.items():
        cells += [f"{n(c)} AS {name}_runs", f"{n(c + ' AND b.position = 1')} AS {name}_wins"]
    rates = [f"{rate(f'{k}_wins', f'{k}_runs')} AS {k}_win_rate" for k in (*contexts, *relations)] + [f"{rate('total_wins', 'total_races')} AS win_rate", f"{rate('total_places', 'total_races')} AS place_rate", "total_races > 0 AS has_form"]
    shown = lambda c: f"array_to_string(list_transform(h[1:5], lambda x: coalesce(x.{c}::VARCHAR, '-')), ',')"
    points = "CASE WHEN x.position = 1 THEN 10 WHEN x.position = 2 THEN 7 WHEN x.position = 3 THEN 5 WHEN x.position = 4 THEN 3 WHEN x.position > 4 THEN 1 ELSE 0 END"
    lists = [f"{shown(c)} AS last_5_{k}" for k, c in (("positions", "position"), ("dates", "race_date"), ("courses", "course_id"), ("distances", "distance_f"), ("classes", "race_class"))]
    lists += ["array_to_string(list_transform(h[1:10], lambda x: coalesce(x.position::VARCHAR, '-')), ',') AS last_10_positions", f"CASE WHEN total_races > 0 THEN round(list_sum(list_transform(h[1:5], lambda x, i: {points} * [20, 15, 12, 10, 10][i])) * 10.0::DOUBLE / 67.0, 2) END AS recent_form_score"]
    keep = ("race_date", "course_id", "region", "distance_f", "surface", "going", "race_class", "jockey_id", "trainer_id", "owner_id")
    inner = f"SELECT a.race_id, a.horse_id, {', '.join(f'any_value(a.{k}) AS {k}' for k in keep)}, {', '.join(cells)}, coalesce(list({{'race_date': b.race_date, 'race_id': b.race_id, 'position': b.position, 'course_id': b.course_id, 'distance_f': b.distance_f, 'race_class': b.race_class}} ORDER BY b.race_date DESC, b.race_id DESC) FILTER (WHERE b.horse_id IS NOT NULL), []) AS h FROM runs a LEFT JOIN runs b ON a.horse_id = b.horse_id AND b.race_date < a.race_date GROUP BY a.race_id, a.horse_id"
    return f"SELECT * EXCLUDE (h), {', '.join(rates + lists)} FROM ({inner})"


query("feature_rows", _features_sql())(lambda v: X.feature_rows(v.runs))
query(
    "feature_health",
    f"SELECT *, CASE WHEN age_days <= 0 THEN 'FRESH' WHEN age_days <= 1 THEN 'AGING' ELSE 'STALE' END AS state FROM (SELECT count(*) AS n, max(race_date) AS latest, datediff('day', max(race_date), any_value(d))::INT AS age_days, round(count(*) FILTER (WHERE has_form) * 100.0::DOUBLE / count(*), 2) AS form_percent, count(*) FILTER (WHERE race_id IS NULL OR horse_id IS NULL OR jockey_id IS NULL OR trainer_id IS NULL) AS missing_keys, round(avg(total_races), 4) AS mean_depth, round(count(recent_form_score) * 100.0::DOUBLE / count(*), 2) AS score_percent, round(count(*) FILTER (WHERE course_runs > 0 OR distance_runs > 0) * 100.0::DOUBLE / count(*), 2) AS context_percent FROM ({_features_sql()}), ended)",
)(lambda v: X.feature_health(X.feature_rows(v.runs), v.as_of))

# -- ancestors ------------------------------------------------------------------------------------

OWN = "count(*) AS own_runs, count(*) FILTER (WHERE position = 1) AS own_wins, count(*) FILTER (WHERE position <= 3) AS own_places, sum(prize_won) AS own_prize, min(position) AS best_position, round(avg(position), 2) AS own_avg_position, min(race_date) AS first_run, max(race_date) AS last_run, max(race_date) FILTER (WHERE position = 1) AS last_win"


def _top_sql(category: str, name: str, expected: str) -> str:
    cells = ", ".join(f"max({c}) FILTER (WHERE rank = {i}) AS {a}" for i in (1, 2, 3) for c, a in ((category, f"{name}_{i}"), ("runs", f"{name}_{i}_runs"), ("wins", f"{name}_{i}_wins"), ("win_rate", f"{name}_{i}_win_rate")))
    index = f"round(max(CASE WHEN rank = 1 THEN wins * 100.0::DOUBLE / (runs * {expected}) END), 3) AS {name}_index"
    return f"SELECT ancestor_id, {cells}, {index} FROM (SELECT *, round(100.0::DOUBLE * wins / runs, 2) AS win_rate, row_number() OVER (PARTITION BY ancestor_id ORDER BY wins DESC, {category}) AS rank FROM (SELECT ancestor_id, {category}, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM e GROUP BY ALL)) WHERE rank <= 3 GROUP BY ancestor_id"


def _profile_sql(relation: str) -> str:
    wins = "count(*) FILTER (WHERE position = 1"
    splits = ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}_runs, {wins} AND {c}) AS {k}_wins" for k, c in (("turf", "lower(surface) = 'turf'"), ("aw", AW), ("flat", f"NOT coalesce({JUMPS}, false)"), ("jump", JUMPS)))
    classes = ", ".join(f"{wins} AND race_class = {c}) AS class_{c}_wins" for c in range(1, 8))
    best = "CASE " + " ".join(f"WHEN class_{c}_wins > 0 AND class_{c}_wins = greatest({', '.join(f'class_{i}_wins' for i in range(1, 8))}) THEN {c}" for c in range(1, 8)) + " END AS best_class"
    base = f"SELECT ancestor_id, count(DISTINCT horse_id) AS progeny, count(*) AS runs, {wins}) AS wins, count(*) FILTER (WHERE position <= 3) AS places, count(*) FILTER (WHERE position = 2) AS seconds, count(*) FILTER (WHERE position = 3) AS thirds, sum(prize_won) AS prize, round(avg(position), 2) AS avg_position, {splits}, {classes}, round({wins}) * 100.0::DOUBLE / sum({CLASS_RATE}), 3) AS class_index, round({wins}) * 100.0::DOUBLE / sum({DISTANCE_RATE}), 3) AS distance_index FROM e GROUP BY ancestor_id"
    score = "round(CASE WHEN runs > 0 THEN 0.20 ELSE 0 END + " + " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 0.10 ELSE 0 END" for c in ("top_class_1", "top_class_2", "top_class_3", "top_distance_1", "top_distance_2", "top_distance_3")) + " + CASE WHEN class_index > 0 THEN 0.10 ELSE 0 END + CASE WHEN top_class_index > 0 THEN 0.05 ELSE 0 END + CASE WHEN top_distance_index > 0 THEN 0.05 ELSE 0 END, 2)::DOUBLE AS score"
    return (
        f"WITH e AS (SELECT * FROM lineage WHERE relation = '{relation}') SELECT *, {best}, {score}, round(100.0::DOUBLE * wins / runs, 2) AS win_rate, round(100.0::DOUBLE * places / runs, 2) AS place_rate, round(runs::DOUBLE / progeny, 2) AS runs_per_horse, round(wins::DOUBLE / progeny, 2) AS wins_per_horse "
        f"FROM ({base}) LEFT JOIN ({_top_sql('race_class', 'top_class', CLASS_RATE)}) USING (ancestor_id) LEFT JOIN ({_top_sql('distance_f', 'top_distance', DISTANCE_RATE)}) USING (ancestor_id) LEFT JOIN (SELECT CAST(horse_id AS VARCHAR) AS ancestor_id, {OWN} FROM runs GROUP BY horse_id) USING (ancestor_id)"
    )


for relation in ("sire", "dam", "damsire"):
    query(f"profile_{relation}", _profile_sql(relation))(lambda v, r=relation: B.ancestor_profiles(B.horse_careers(v.runs), v.horses, f"{r}_id"))
    key = f"{relation}_id"
    query(
        f"all_progeny_{relation}",
        f"SELECT {key}, count(*) AS progeny, count(r) AS runners, coalesce(sum(r), 0)::BIGINT AS runs, coalesce(sum(w), 0)::BIGINT AS wins, coalesce(sum(pl), 0)::BIGINT AS places, round(sum(s)::DOUBLE / sum(f), 2) AS avg_position, CASE WHEN sum(r) > 0 THEN round(100.0::DOUBLE * sum(w) / sum(r), 2) END AS win_rate, CASE WHEN sum(r) > 0 THEN round(100.0::DOUBLE * sum(pl) / sum(r), 2) END AS place_rate FROM horses LEFT JOIN (SELECT horse_id, count(*) AS r, count(*) FILTER (WHERE position = 1) AS w, count(*) FILTER (WHERE position <= 3) AS pl, sum(position) AS s, count(position) AS f FROM runs GROUP BY 1) USING (horse_id) GROUP BY {key}",
    )(lambda v, k=key: B.all_progeny(v.horses, v.runs, k))
query(
    "career_and_progeny",
    "SELECT h.horse_id, coalesce(o.r, 0) AS own_runs, coalesce(o.w, 0) AS own_wins, coalesce(o.p, 0) AS own_places, o.a AS own_avg_position, coalesce(k.progeny, 0) AS progeny, coalesce(k.runners, 0) AS progeny_runners, coalesce(k.runs, 0)::BIGINT AS progeny_runs, coalesce(k.wins, 0)::BIGINT AS progeny_wins, coalesce(k.places, 0)::BIGINT AS progeny_places, k.a AS progeny_avg_position FROM horses h LEFT JOIN (SELECT horse_id, count(*) AS r, count(*) FILTER (WHERE position = 1) AS w, count(*) FILTER (WHERE position <= 3) AS p, round(avg(position), 2) AS a FROM runs GROUP BY 1) o ON o.horse_id = h.horse_id LEFT JOIN (SELECT damsire_id, count(*) AS progeny, count(r) AS runners, sum(r) AS runs, sum(w) AS wins, sum(p) AS places, round(sum(s)::DOUBLE / sum(f), 2) AS a FROM horses LEFT JOIN (SELECT horse_id, count(*) AS r, count(*) FILTER (WHERE position = 1) AS w, count(*) FILTER (WHERE position <= 3) AS p, sum(position) AS s, count(position) AS f FROM runs GROUP BY 1) USING (horse_id) GROUP BY 1) k ON k.damsire_id = CAST(h.horse_id AS VARCHAR)",
)(lambda v: B.career_and_progeny(B.horse_careers(v.runs), v.horses, B.all_progeny(v.horses, v.runs, "damsire_id"), "damsire_id"))
query("top_ancestors", "SELECT relation, ancestor_id, wins FROM (SELECT *, row_number() OVER (PARTITION BY relation ORDER BY wins DESC, ancestor_id) AS r FROM (SELECT relation, ancestor_id, count(*) FILTER (WHERE position = 1) AS wins FROM lineage GROUP BY ALL)) WHERE r <= 5")(lambda v: W.top_by(R.wins_of_ancestors(v.lineage), ["relation"], [F.desc("wins"), P("ancestor_id")], 5))
query("pedigree_listing", "SELECT race_id, horse_id, generation, relation, ancestor_id FROM lineage ORDER BY race_id, horse_id, generation, relation")(
    lambda v: v.lineage.select("race_id", "horse_id", "generation", "relation", "ancestor_id").orderBy("race_id", "horse_id", "generation", "relation")
)
query("descendant_runs", "SELECT h.damsire_id AS ancestor_id, CASE WHEN r.position IS NULL THEN 'unplaced' ELSE 'placed' END AS outcome, r.race_id, r.horse_id, r.race_date FROM runs r JOIN horses h USING (horse_id) WHERE CAST(h.damsire_id AS BIGINT) IN (SELECT horse_id FROM runs WHERE position = 1)")(
    lambda v: v.runs.join(v.horses, "horse_id").join(v.runs.where("position = 1").select(P("horse_id").cast("string").alias("damsire_id")).distinct(), "damsire_id", "left_semi")
    .select(P("damsire_id").alias("ancestor_id"), F.when(P("position").isNull(), "unplaced").otherwise("placed").alias("outcome"), "race_id", "horse_id", "race_date")
)
query("best_sires_by_rate", "SELECT ancestor_id, runs, win_rate FROM (SELECT ancestor_id, count(*) AS runs, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate FROM lineage WHERE relation = 'sire' GROUP BY 1) WHERE runs >= 100 ORDER BY win_rate DESC, ancestor_id LIMIT 10")(
    lambda v: G.progeny_stats(v.lineage.where("relation = 'sire'")).where("runs >= 100").select("ancestor_id", "runs", "win_rate").orderBy(F.desc("win_rate"), "ancestor_id").limit(10)
)
query("good_on_track_and_as_producers", "SELECT ancestor_id, own_wins, wins FROM (SELECT ancestor_id, count(*) FILTER (WHERE position = 1) AS wins FROM lineage WHERE relation = 'damsire' GROUP BY 1) JOIN (SELECT CAST(horse_id AS VARCHAR) AS ancestor_id, count(*) FILTER (WHERE position = 1) AS own_wins FROM runs GROUP BY 1) USING (ancestor_id) WHERE own_wins > 0 AND wins > 0")(
    lambda v: B.ancestor_profiles(B.horse_careers(v.runs), v.horses, "damsire_id").where("own_wins > 0 and wins > 0").select("ancestor_id", "own_wins", "wins")
)

# -- performance ----------------------------------------------------------------------------------

TIMES = "distance_f * 12 + coalesce(position, 9)"
query(
    "performance_distance_times",
    f"SELECT jockey_id, distance_f, runs, best_time, avg_time, last_time, going_text FROM (SELECT jockey_id, distance_f, count(*) AS runs, min({TIMES})::DOUBLE AS best_time, round(avg({TIMES}), 2) AS avg_time, arg_max({TIMES}, (race_date, race_id, horse_id))::DOUBLE AS last_time FROM runs WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 5) JOIN (SELECT jockey_id, distance_f, string_agg(going || '=' || n, ';' ORDER BY going) AS going_text FROM (SELECT jockey_id, distance_f, going, count(*) AS n FROM runs WHERE position IS NOT NULL GROUP BY ALL) GROUP BY ALL) USING (jockey_id, distance_f)",
)(lambda v: A.performance_times(v.runs.withColumn("seconds", F.expr(TIMES).cast("double")), ["jockey_id", "distance_f"], "seconds").select("jockey_id", "distance_f", "runs", "best_time", "avg_time", "last_time", P("breakdown_text").alias("going_text")))
query("performance_venue_trainer", "SELECT trainer_id, course_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, round((count(*) FILTER (WHERE position = 1)) / sum(1 / sp_decimal), 2) AS ae_index FROM runs WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 5")(
    lambda v: A.performance(v.runs, ["trainer_id", "course_id"]).select("trainer_id", "course_id", "runs", "wins", "places", "ae_index")
)
query("distance_bands_of_entities", "SELECT jockey_id, CASE WHEN distance_f * 220 < 1400 THEN 'sprint' WHEN distance_f * 220 < 1800 THEN 'mile' WHEN distance_f * 220 < 2400 THEN 'middle' ELSE 'staying' END AS band, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs GROUP BY ALL")(lambda v: R.outcomes_by(v.runs, "jockey_id", S.distance_band(P("distance_f") * 220).alias("band")))
# -- entities -------------------------------------------------------------------------------------

KINDS = {"jockey": ("jockey_id", "jockey_name"), "owner": ("owner_id", "owner_name"), "horse": ("horse_id", "horse_name"), "trainer": ("trainer_id", "trainer_name")}
NAMED = "SELECT r.*, s_name AS jockey_name, c_name AS owner_name, p_name AS horse_name, n_name AS trainer_name FROM runs r JOIN supplier ON s_suppkey = jockey_id JOIN customer ON c_custkey = owner_id JOIN part ON p_partkey = horse_id JOIN nation ON n_nationkey = trainer_id"


def named_runs(v: Views) -> DataFrame:
    out = v.runs
    for table, key, own, name in (("supplier", "s_suppkey", "jockey_id", "s_name"), ("customer", "c_custkey", "owner_id", "c_name"), ("part", "p_partkey", "horse_id", "p_name"), ("nation", "n_nationkey", "trainer_id", "n_name")):
        out = out.join(v.table(table).select(P(key).alias(own), P(name).alias({"s": "jockey_name", "c": "owner_name", "p": "horse_name", "n": "trainer_name"}[name[0]])), own)
    return out


query("extract_entities", " UNION ALL ".join(f"SELECT '{k}' AS entity_type, CAST({i} AS VARCHAR) AS entity_id, arg_min({n}, (race_date, race_id, horse_id)) AS name, min(race_date) AS first_seen, count(*) AS runs FROM ({NAMED}) GROUP BY {i}" for k, (i, n) in KINDS.items()))(
    lambda v: E.extract_entities(named_runs(v), KINDS)
)
query("breeding_entities", "WITH x AS (SELECT DISTINCT 'sire_id' AS relation, sire_id AS ancestor FROM horses UNION SELECT DISTINCT 'dam_id', dam_id FROM horses UNION SELECT DISTINCT 'damsire_id', damsire_id FROM horses), n AS (SELECT lower(trim(name)) AS k, min(horse_id) AS id, count(*) AS c FROM horses GROUP BY 1) SELECT relation, ancestor, CASE WHEN c = 1 THEN id END AS matched_id, CASE WHEN c = 1 THEN 'name' ELSE 'none' END AS match_method FROM x LEFT JOIN n ON lower(trim(ancestor)) = k")(
    lambda v: E.breeding_entities(v.horses.withColumn("region", F.lit(None).cast("string")), ["sire_id", "dam_id", "damsire_id"])
)
query("enriched_pedigrees", "SELECT p_partkey AS horse_id, p_name AS sire_id, CAST(p_size AS VARCHAR) AS damsire_id FROM part WHERE p_partkey IN (SELECT horse_id FROM runs GROUP BY 1 HAVING min(race_date) >= (SELECT d - 900 FROM ended))")(
    lambda v: E.enrich(v.runs.groupBy("horse_id").agg(F.min("race_date").alias("f")).where(P("f") >= F.date_sub(v.as_of, 900)).select("horse_id"), v.horses.select("horse_id", "sire_id", "damsire_id"), "horse_id", ["sire_id", "damsire_id"])[1]
)
query("new_horses", "SELECT horse_id FROM horses WHERE horse_id NOT IN (SELECT horse_id FROM runs)")(lambda v: E.split_known(v.horses.select("horse_id"), v.runs, "horse_id")[1])
query("known_horses", "SELECT horse_id FROM horses WHERE horse_id IN (SELECT horse_id FROM runs)")(lambda v: E.split_known(v.horses.select("horse_id"), v.runs, "horse_id")[0])
query("merge_keeping", "SELECT s_suppkey AS id, CASE WHEN c_custkey IS NULL OR (s_suppkey % 2 = 0 AND s_suppkey % 3 = 0) THEN CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal END ELSE c_acctbal END AS latitude, CASE WHEN c_custkey IS NULL OR (s_suppkey % 2 = 0 AND s_suppkey % 3 = 0) THEN CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal END ELSE -c_acctbal END AS longitude FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey UNION ALL SELECT c_custkey, c_acctbal, -c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)", False)(
    lambda v: E.merge_keeping(
        v.table("supplier").select(P("s_suppkey").alias("id"), F.when(P("s_suppkey") % 2 == 0, P("s_acctbal")).alias("latitude"), F.when(P("s_suppkey") % 3 == 0, P("s_acctbal")).alias("longitude")),
        v.table("customer").select(P("c_custkey").alias("id"), P("c_acctbal").alias("latitude"), (-P("c_acctbal")).alias("longitude")), "id", ["latitude", "longitude"],
    )
)
query("statistics_of_new_entities", "SELECT jockey_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs WHERE jockey_id IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 0) GROUP BY 1")(
    lambda v: A.lifetime(v.runs.join(E.without_statistics(v.table("supplier"), "s_nationkey").select(P("s_suppkey").alias("jockey_id")), "jockey_id", "left_semi"), "jockey_id").select("jockey_id", "runs", "wins")
)
query("match_places", "WITH f AS (SELECT s_suppkey AS id, upper(n_name) AS name, CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal END AS latitude, s_acctbal AS longitude FROM supplier JOIN nation ON n_nationkey = s_nationkey), a AS (SELECT id, min((name, latitude, longitude)) AS x FROM f GROUP BY id), b AS (SELECT lower(name) AS n, arg_min((latitude, longitude), id) AS x FROM f GROUP BY 1), m AS (SELECT n_nationkey + 995 AS id, n_name AS name FROM nation) SELECT m.id, m.name, CASE WHEN lat IS NOT NULL THEN lat END AS latitude, CASE WHEN lat IS NOT NULL THEN lon END AS longitude, CASE WHEN hit IS NULL THEN 'no match' WHEN lat IS NULL OR lon IS NULL THEN 'no coordinates' ELSE hit END AS reason FROM (SELECT m.*, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN b.n IS NOT NULL THEN 'name' END AS hit, CASE WHEN a.id IS NOT NULL THEN (a.x)[2] ELSE (b.x)[1] END AS lat, CASE WHEN a.id IS NOT NULL THEN (a.x)[3] ELSE (b.x)[2] END AS lon FROM m LEFT JOIN a USING (id) LEFT JOIN b ON lower(m.name) = b.n) m", False)(
    lambda v: E.match_places(
        v.table("nation").select((P("n_nationkey") + 995).alias("id"), P("n_name").alias("name")),
        v.table("supplier").join(v.table("nation"), P("s_nationkey") == P("n_nationkey")).select(P("s_suppkey").alias("id"), F.upper("n_name").alias("name"), F.when(P("s_suppkey") % 5 > 0, P("s_acctbal")).alias("latitude"), P("s_acctbal").alias("longitude")),
    )
)
RATED = "SELECT race_id, horse_id, CASE WHEN race_id % 3 > 0 THEN position END AS ofr, CASE WHEN race_id % 5 > 0 THEN position END AS rpr FROM runs"
query("races_without_ratings", f"SELECT DISTINCT race_id FROM ({RATED}) WHERE ofr IS NULL AND rpr IS NULL")(lambda v: E.races_without(rated(v), ["ofr", "rpr"]))
query("ratings_from_results", f"SELECT race_id, horse_id, coalesce(ofr, position) AS ofr, coalesce(rpr, position * 2) AS rpr FROM ({RATED}) JOIN runs USING (race_id, horse_id)")(
    lambda v: E.fill_from_results(rated(v), v.runs.select("race_id", "horse_id", P("position").alias("ofr"), (P("position") * 2).alias("rpr")), ["race_id", "horse_id"], ["ofr", "rpr"])
)
query("update_sequence", "SELECT event_id, n || '/' || greatest(n, 48) AS sequence FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)", False)(
    lambda v: W.top_by(v.table("events").select("user_id", "event_id", "ts"), ["user_id"], [P("ts"), P("event_id")], 1 << 30, rank="n").select("event_id", E.update_sequence(P("n")).alias("sequence"))
)


def rated(v: Views) -> DataFrame:
    return v.runs.select("race_id", "horse_id", F.when(P("race_id") % 3 > 0, P("position")).alias("ofr"), F.when(P("race_id") % 5 > 0, P("position")).alias("rpr"))


# -- late data and quality ------------------------------------------------------------------------

query("reconciled_week", "SELECT event_id, event_type, CASE WHEN event_id % 2 = 0 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY THEN value * 2 ELSE value END AS value FROM events", False)(
    lambda v: sinks.reconcile_recent(v.table("events").select("event_id", "event_type", "ts", "value"), v.table("events").where("event_id % 2 = 0").select("event_id", "event_type", "ts", (P("value") * 2).alias("value")), ["event_id"], "ts", v.table("events").agg(F.max("ts")).first()[0], 7).select("event_id", "event_type", "value")
)
query("entities_not_known", "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)", False)(
    lambda v: J.absent(v.table("events").select("user_id").distinct(), v.table("customer").select(P("c_custkey").alias("user_id")), "user_id")
)
query("price_gap", "SELECT count(*) AS total, count(position) AS finished, count(*) FILTER (WHERE sp_decimal > 3) AS priced, count(position) - count(*) FILTER (WHERE sp_decimal > 3) AS gap FROM runs")(
    lambda v: Q.coverage_gap(v.runs.withColumn("price", F.when(P("sp_decimal") > 3, P("sp_decimal"))), "position", "price")
)
query("row_quality_score", "SELECT 100 - CASE WHEN count(*) FILTER (WHERE coalesce(n_name, '') = '') > 0 THEN 30 ELSE 0 END - CASE WHEN count(*) FILTER (WHERE region IS NULL) > 0 THEN 30 ELSE 0 END - CASE WHEN count(*) FILTER (WHERE region IN ('EUROPE', 'ASIA')) < count(*) THEN 20 ELSE 0 END AS score FROM (SELECT n_name, r_name AS region FROM nation JOIN region ON r_regionkey = n_regionkey)", False)(
    lambda v: Q.row_quality(v.table("nation").join(v.table("region"), P("n_regionkey") == P("r_regionkey")), "n_name", "r_name", ("EUROPE", "ASIA")).select("score")
)
query("course_keys", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'newmarket' WHEN c_custkey % 4 = 1 THEN 'limerick' WHEN c_custkey % 4 = 2 THEN 'stratford' ELSE lower(c_mktsegment) END AS k FROM customer", False)(
    lambda v: v.table("customer").select("c_custkey", S.course_key(F.expr("case c_custkey % 4 when 0 then 'Newmarket-July' when 1 then 'Limerick Junction-Right' when 2 then 'Stratford-upon-Avon' else c_mktsegment || '-' || element_at(array('AW', 'RH', 'left', 'GB', 'ire'), cast(c_custkey % 5 + 1 as int)) end")).alias("k"))
)
query("breeding_regions", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'gb' WHEN 1 THEN 'ire' WHEN 2 THEN 'xyz' END AS region FROM part", False)(
    lambda v: v.table("part").select("p_partkey", S.breeding_region(F.expr("p_name || element_at(array(' (UK)', ' (IRE) ', ' (XYZ)', ' (gb)'), cast(p_partkey % 4 + 1 as int))")).alias("region"))
)
query("odd_positions", "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN 5 WHEN 1 THEN 12 WHEN 2 THEN NULL WHEN 3 THEN 1 WHEN 4 THEN 4 WHEN 5 THEN NULL ELSE NULL END AS position FROM lineitem", False)(
    lambda v: v.table("lineitem").select("l_orderkey", "l_linenumber", S.position(F.expr("element_at(array('DIED AS 5', 'died as a 12', 'DIED', '1st', ' 4 ', 'PU3', ''), cast(l_linenumber % 7 + 1 as int))")).alias("position"))
)
query("odd_distances", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 4022 WHEN 1 THEN NULL WHEN 2 THEN 1200 WHEN 3 THEN 1306 ELSE NULL END AS metres FROM orders", False)(
    lambda v: v.table("orders").select("o_orderkey", S.metres(F.expr("element_at(array('2m4f', 'm', '1200', '6.5f', ''), cast(o_orderkey % 5 + 1 as int))")).alias("metres"))
)
query("home_regions", "SELECT n_nationkey, regexp_matches(n_name, '(?i)great britain|united kingdom|uk|england|scotland|wales|northern ireland|ireland|irish') AS home FROM nation", False)(lambda v: v.table("nation").select("n_nationkey", S.in_country(P("n_name")).alias("home")))

# -- rules that the named queries above leave open ---------------------------------------------------

query("coordinates_by_name", "SELECT n_nationkey AS course_id, n_name || '-AW' AS name, r_name AS region, CASE WHEN n_nationkey % 3 = 0 THEN 1.5 ELSE n_nationkey + 0.5 END::DOUBLE AS latitude, CASE WHEN n_nationkey % 3 = 0 THEN 2.5 ELSE -n_nationkey - 0.5 END::DOUBLE AS longitude FROM nation JOIN region ON r_regionkey = n_regionkey", False)(
    lambda v: J.add_coordinates(
        v.table("nation").join(v.table("region"), P("n_regionkey") == P("r_regionkey")).select(P("n_nationkey").alias("course_id"), F.concat("n_name", F.lit("-AW")).alias("name"), P("r_name").alias("region"), F.when(P("n_nationkey") % 3 == 0, 1.5).alias("latitude"), F.when(P("n_nationkey") % 3 == 0, 2.5).alias("longitude")),
        v.table("nation").join(v.table("region"), P("n_regionkey") == P("r_regionkey")).select(F.lower("n_name").alias("k"), F.lower("r_name").alias("r"), (P("n_nationkey") + 0.5).alias("latitude"), (-P("n_nationkey") - 0.5).alias("longitude")),
        [S.course_key(P("name")), F.upper("region")], [P("k"), F.upper("r")],
    )
)
query("owners_by_location", "SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE regexp_matches(n_name, '(?i)great britain|united kingdom|uk|england|scotland|wales|northern ireland|ireland|irish') OR c_mktsegment = 'BUILDING'", False)(
    lambda v: v.table("customer").join(v.table("nation"), P("c_nationkey") == P("n_nationkey")).withColumn("place", F.when(P("c_mktsegment") == "BUILDING", "").otherwise(P("n_name"))).where(S.in_country(P("place")) | (P("place") == "")).select("c_custkey")
)
query("distances_filled", "SELECT race_id, CASE WHEN race_id % 2 = 0 THEN 1 ELSE distance_f * 201 END AS distance_m FROM races")(
    lambda v: v.races.select("race_id", F.coalesce(F.when(P("race_id") % 2 == 0, 1), S.metres(F.concat(P("distance_f").cast("string"), F.lit("f")))).alias("distance_m"))
)
query("incremental_merge", "SELECT s_suppkey AS jockey_id, coalesce(a.runs, o.runs) AS runs, coalesce(a.wins, o.wins) AS wins FROM supplier LEFT JOIN (SELECT jockey_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs, ended WHERE race_date < d - 3 GROUP BY 1) o ON o.jockey_id = s_suppkey LEFT JOIN (SELECT jockey_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs WHERE jockey_id IN (SELECT jockey_id FROM runs, ended WHERE race_date >= d - 3) GROUP BY 1) a ON a.jockey_id = s_suppkey")(
    lambda v: A.update_dimension(
        v.table("supplier").select(P("s_suppkey").alias("jockey_id")).join(A.lifetime(v.runs.where(P("race_date") < F.date_sub(v.as_of, 3)), "jockey_id").select("jockey_id", "runs", "wins"), "jockey_id", "left"),
        A.lifetime(J.active_since(v.runs, v.runs, "jockey_id", F.date_sub(v.as_of, 3)), "jockey_id"), "jockey_id", ["runs", "wins"],
    )
)
query("lifetime_with_defaults", "SELECT s_suppkey AS jockey_id, count(race_id) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, CASE WHEN count(race_id) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(race_id), 2) ELSE 0 END AS win_rate, CASE WHEN count(race_id) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (WHERE position <= 3) / count(race_id), 2) ELSE 0 END AS place_rate FROM supplier LEFT JOIN runs ON jockey_id = s_suppkey AND course_id = 3 GROUP BY s_suppkey")(
    lambda v: v.table("supplier").select(P("s_suppkey").alias("jockey_id")).join(A.lifetime(v.runs.where("course_id = 3"), "jockey_id").drop("seconds", "thirds"), "jockey_id", "left").na.fill(0)
)
query("upcoming_form", "SELECT u.race_id, count(*) AS runners, round(avg(score), 4) AS mean_form FROM (SELECT race_id, horse_id FROM runs, ended WHERE race_date = d) u LEFT JOIN (SELECT horse_id, round(sum(CASE position WHEN 1 THEN 10 WHEN 2 THEN 7 WHEN 3 THEN 5 WHEN 4 THEN 3 ELSE 1 END * CASE r WHEN 1 THEN 2.0 WHEN 2 THEN 1.5 WHEN 3 THEN 1.2 ELSE 1.0 END::DOUBLE) / 67 * 100, 2) AS score FROM (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC) AS r FROM runs WHERE position IS NOT NULL) WHERE r <= 5 GROUP BY 1) USING (horse_id) GROUP BY u.race_id")(lambda v: R.upcoming_form(W.form_lines(v.runs), v.runs.where(P("race_date") == v.as_of)))
query("update_days", "SELECT event_type, count(*) AS n, min(ts)::DATE AS first_day, max(ts)::DATE AS last_day, count(DISTINCT ts::DATE) AS days FROM events GROUP BY 1", False)(lambda v: R.update_days(v.table("events"), "event_type", "ts"))
query("distinct_ids", " UNION ALL ".join(f"SELECT DISTINCT '{k}' AS entity_type, CAST({i} AS VARCHAR) AS entity_id FROM runs" for k, (i, _) in KINDS.items()))(
    lambda v: A.unpivot_entities(v.runs, {k: i for k, (i, _) in KINDS.items()}, []).distinct()
)
BLANKS = ["text", "lang", "source"]
query("blank_as_null", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n, count(nullif({c}, '')) AS filled FROM documents" for c in BLANKS), False)(
    lambda v: Q.column_population(v.table("documents"), BLANKS, blank_is_null=True).select("column_name", "n", "filled")
)
query("severity_with_missing", "SELECT column_name, CASE WHEN percent = 0 THEN 'HIGH' WHEN percent < 10 THEN 'MEDIUM' ELSE 'OK' END AS severity FROM (SELECT 'text' AS column_name, count(text) * 100.0 / count(*) AS percent FROM documents UNION ALL SELECT 'lang', count(lang) * 100.0 / count(*) FROM documents) UNION ALL SELECT 'rating', 'CRITICAL'", False)(
    lambda v: Q.severity_of(v.table("documents"), ["text", "lang", "rating"]).select("column_name", "severity")
)
query("coverage_bands", "SELECT 'position' AS column_name, CASE WHEN count(position) >= 0.9 * count(*) THEN 'pass' WHEN count(position) >= 0.5 * count(*) THEN 'warn' ELSE 'fail' END AS result FROM runs UNION ALL SELECT 'going', CASE WHEN count(going) >= 0.9 * count(*) THEN 'pass' WHEN count(going) >= 0.5 * count(*) THEN 'warn' ELSE 'fail' END FROM runs")(
    lambda v: Q.pass_bands(Q.column_population(v.runs, ["position", "going"])).select("column_name", "result")
)
query("stored_rates_checked", "SELECT jockey_id, stored, win_rate FROM (SELECT jockey_id, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS stored FROM runs, ended WHERE race_date < d - 365 GROUP BY 1) JOIN (SELECT jockey_id, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate FROM runs GROUP BY 1) USING (jockey_id) WHERE abs(stored - win_rate) > 0.1")(
    lambda v: A.lifetime(v.runs.where(P("race_date") < F.date_sub(v.as_of, 365)), "jockey_id").select("jockey_id", P("win_rate").alias("stored")).join(A.lifetime(v.runs, "jockey_id").select("jockey_id", "win_rate"), "jockey_id").where(F.abs(P("stored") - P("win_rate")) > 0.1)
)
query("twin_samples", "SELECT l_orderkey, l_linenumber, l_discount AS first, l_tax AS second FROM lineitem WHERE l_discount <> l_tax ORDER BY l_orderkey, l_linenumber LIMIT 5", False)(
    lambda v: Q.twin_samples(v.table("lineitem"), "l_discount", "l_tax", ["l_orderkey", "l_linenumber"])
)
