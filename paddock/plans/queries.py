"""Registered queries over the given tables, each beside DuckDB SQL with the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsers as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import pedigree as G
from ..operators import quality as Q
from ..operators import reports as R
from ..operators import windows as W
from ..sources import sinks
from ..streaming import live
from . import feature_queries, pedigree_queries, state_queries  # noqa: F401 - they register their queries
from .register import QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]
P = F.col
COUNTS = "count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, count(*) FILTER (WHERE position = 2) AS seconds, count(*) FILTER (WHERE position = 3) AS thirds"
RATES = "round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate, round(100.0::DOUBLE * count(*) FILTER (WHERE position <= 3) / count(*), 2) AS place_rate"
MARKET = "round((count(*) FILTER (WHERE position = 1)) / sum(1 / sp_decimal), 2) AS ae_index, coalesce(sum(sp_decimal) FILTER (WHERE position = 1), 0) - count(*) AS profit"
ENTITIES = {"jockey": "jockey_id", "trainer": "trainer_id", "owner": "owner_id"}

# -- entity statistics ---------------------------------------------------------------------------

for kind, key in ENTITIES.items():
    query(f"lifetime_{kind}", f"SELECT {key}, {COUNTS}, {RATES} FROM runs GROUP BY {key}")(lambda v, key=key: A.lifetime(v.runs, key))
    query(f"lifetime_finished_{kind}", f"SELECT {key}, {COUNTS}, {RATES} FROM runs WHERE position IS NOT NULL GROUP BY {key}")(lambda v, key=key: A.lifetime(v.runs, key, finished_only=True))
    recent = ", ".join(f"count(*) FILTER (WHERE race_date >= d - {n}) AS runs_{n}d, count(*) FILTER (WHERE race_date >= d - {n} AND position = 1) AS wins_{n}d" for n in (14, 30))
    query(
        f"recent_form_{kind}",
        f"SELECT *, CASE WHEN runs_14d > 0 THEN round(100.0::DOUBLE * wins_14d / runs_14d, 2) END AS win_rate_14d, CASE WHEN runs_30d > 0 THEN round(100.0::DOUBLE * wins_30d / runs_30d, 2) END AS win_rate_30d FROM (SELECT {key}, {recent} FROM runs, ended WHERE position IS NOT NULL AND race_date >= d - 30 GROUP BY {key})",
    )(lambda v, key=key: A.recent_form(v.runs, key, v.as_of))
    query(
        f"last_activity_{kind}",
        f"SELECT {key}, max(race_date) AS last_run, max(race_date) FILTER (WHERE position = 1) AS last_win, datediff('day', max(race_date), any_value(d))::INT AS days_since_run, datediff('day', max(race_date) FILTER (WHERE position = 1), any_value(d))::INT AS days_since_win FROM runs, ended GROUP BY {key}",
    )(lambda v, key=key: A.last_activity(v.runs, key, v.as_of))

query("lifetime_owner_horses", f"SELECT owner_id, {COUNTS}, count(DISTINCT horse_id) AS total_horses, bool_or(race_date >= d - 30) AS active_last_30d, {RATES} FROM runs, ended GROUP BY owner_id")(
    lambda v: A.lifetime(v.runs, "owner_id", extra=[F.countDistinct("horse_id").alias("total_horses"), F.bool_or(P("race_date") >= F.date_sub(v.as_of, 30)).alias("active_last_30d")])
)
query("incremental_lifetime", f"SELECT jockey_id, {COUNTS}, {RATES} FROM runs WHERE jockey_id IN (SELECT jockey_id FROM runs, ended WHERE race_date >= d - 3) GROUP BY jockey_id")(
    lambda v: A.lifetime(J.active_since(v.runs, v.runs, "jockey_id", F.date_sub(v.as_of, 3)), "jockey_id")
)
AS_TEXT = "CASE WHEN position_raw = '1' AND race_id % 2 = 0 THEN 'won' WHEN position_raw = '1' THEN '1st' WHEN position_raw = '2' THEN '2nd' WHEN position_raw = '3' THEN '3rd' ELSE position_raw END"
query("lifetime_text_positions", f"SELECT jockey_id, count(*) AS runs, count(*) FILTER (WHERE t IN ('won', '1st')) AS wins, count(*) FILTER (WHERE t IN ('won', '1st', '2nd', '3rd')) AS places FROM (SELECT jockey_id, {AS_TEXT} AS t FROM runs) GROUP BY jockey_id")(
    lambda v: A.lifetime(v.runs.withColumn("position", S.text_position(F.expr(AS_TEXT))), "jockey_id").select("jockey_id", "runs", "wins", "places")
)
query(
    "lifetime_all_suppliers",
    "SELECT s_suppkey AS jockey_id, count(race_id) AS runs, count(*) FILTER (WHERE position = 1) AS wins, CASE WHEN count(race_id) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(race_id), 2) ELSE 0 END AS win_rate FROM supplier LEFT JOIN runs ON s_suppkey = jockey_id AND position IS NOT NULL GROUP BY s_suppkey",
)(
    lambda v: v.table("supplier").select(P("s_suppkey").alias("jockey_id")).join(v.runs.where("position is not null"), "jockey_id", "left").groupBy("jockey_id")
    .agg(F.count("race_id").alias("runs"), F.count_if(P("position") == 1).alias("wins")).withColumn("win_rate", S.rate(P("wins"), P("runs"), zero=0.0))
)
query("update_dimension", "SELECT s_suppkey, s_name, coalesce(c, -1) AS runs FROM supplier LEFT JOIN (SELECT jockey_id, count(*) AS c FROM runs WHERE position = 1 GROUP BY 1) ON jockey_id = s_suppkey")(
    lambda v: A.update_dimension(
        v.table("supplier").select("s_suppkey", "s_name", F.lit(-1).cast("long").alias("runs")),
        v.runs.where("position = 1").groupBy(P("jockey_id").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("runs")), "s_suppkey", ["runs"],
    )
)

# -- distance, venue, pairs -----------------------------------------------------------------------

UNPIVOT = "SELECT 'jockey' AS entity_type, CAST(jockey_id AS VARCHAR) AS entity_id, * FROM runs UNION ALL SELECT 'trainer', CAST(trainer_id AS VARCHAR), * FROM runs UNION ALL SELECT 'owner', CAST(owner_id AS VARCHAR), * FROM runs"
KEEP = ["position", "sp_decimal", "distance_f", "course_id", "race_id", "horse_id", "going"]
query("performance_distance", f"SELECT entity_type, entity_id, distance_f, {COUNTS}, {MARKET}, {RATES} FROM ({UNPIVOT}) WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 5")(
    lambda v: A.performance(A.unpivot_entities(v.runs, ENTITIES, KEEP), ["entity_type", "entity_id", "distance_f"])
)
query("performance_venue", f"SELECT jockey_id, course_id, {COUNTS}, {MARKET}, {RATES} FROM runs WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 5")(
    lambda v: A.performance(v.runs, ["jockey_id", "course_id"])
)
query("market_by_class_distance", f"SELECT race_class, distance_f, {COUNTS}, {MARKET}, {RATES} FROM runs WHERE position IS NOT NULL GROUP BY ALL")(
    lambda v: A.performance(v.runs, ["race_class", "distance_f"], min_runs=1)
)
for one, two, low in (("jockey_id", "horse_id", 2), ("trainer_id", "horse_id", 3), ("owner_id", "horse_id", 2), ("jockey_id", "trainer_id", 5)):
    query(f"pairs_{one[:-3]}_{two[:-3]}", f"SELECT {one}, {two}, {COUNTS}, {RATES} FROM runs GROUP BY ALL HAVING count(*) >= {low}")(lambda v, one=one, two=two, low=low: A.pairs(v.runs, one, two, low))
query(
    "combinations_four",
    f"SELECT jockey_id, trainer_id, course_id, race_class, {COUNTS}, min(race_date) AS first_seen, max(race_date) AS last_seen, {RATES}, concat_ws('|', jockey_id, trainer_id, course_id, race_class) AS combination FROM runs GROUP BY ALL HAVING count(*) >= 2",
)(lambda v: A.combinations(v.runs, ["jockey_id", "trainer_id", "course_id", "race_class"]))
FOUR = ["jockey_id", "trainer_id", "owner_id", "horse_id"]
query(
    "combinations_four_entities",
    f"SELECT jockey_id, trainer_id, owner_id, horse_id, {COUNTS}, min(race_date) AS first_seen, max(race_date) AS last_seen, {RATES}, concat_ws('|', jockey_id, trainer_id, owner_id, horse_id) AS combination FROM runs WHERE jockey_id IS NOT NULL AND trainer_id IS NOT NULL AND owner_id IS NOT NULL AND horse_id IS NOT NULL GROUP BY ALL HAVING count(*) >= 2",
)(lambda v: A.combinations(v.runs.dropna(subset=FOUR), FOUR))
query("going_breakdown", "SELECT jockey_id, string_agg(going || '=' || n, ';' ORDER BY going) AS breakdown_text FROM (SELECT jockey_id, going, count(*) AS n FROM runs GROUP BY ALL) GROUP BY jockey_id")(
    lambda v: A.breakdown_text(v.runs, ["jockey_id"], "going").drop("breakdown")
)
query("top_at_distance", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY distance_f ORDER BY win_rate DESC, runs DESC, jockey_id)::INT AS rank FROM (SELECT jockey_id, distance_f, count(*) AS runs, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate FROM runs WHERE position IS NOT NULL GROUP BY ALL HAVING count(*) >= 10)) WHERE rank <= 3")(
    lambda v: W.top_by(A.performance(v.runs, ["jockey_id", "distance_f"], 10).select("jockey_id", "distance_f", "runs", "win_rate"), ["distance_f"], [F.desc("win_rate"), F.desc("runs"), P("jockey_id")], 3, rank="rank")
)
query("top_pairs", "SELECT jockey_id, horse_id, count(*) AS runs FROM runs GROUP BY ALL ORDER BY runs DESC, jockey_id, horse_id")(lambda v: R.runs_of_pairs(v.runs, "jockey_id", "horse_id"))
PAIRS = (("jockey_id", "horse_id"), ("trainer_id", "horse_id"), ("owner_id", "horse_id"), ("jockey_id", "trainer_id"))
query("top_pairs_all", "SELECT jockey_id, horse_id, count(*) AS runs FROM runs GROUP BY ALL ORDER BY runs DESC, jockey_id, horse_id")(
    lambda v: v.runs.groupBy("jockey_id", "horse_id").agg(F.count(F.lit(1)).alias("runs")).orderBy(F.desc("runs"), "jockey_id", "horse_id")
)
query(
    "top_pairs_of_all_kinds",
    "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{a[:-3]}_{b[:-3]}' AS pair_type, CAST({a} AS VARCHAR) AS first_id, CAST({b} AS VARCHAR) AS second_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs GROUP BY ALL" for a, b in PAIRS) + ") ORDER BY runs DESC, pair_type, first_id, second_id",
)(lambda v: A.all_pairs(v.runs, PAIRS).orderBy(F.desc("runs"), "pair_type", "first_id", "second_id"))
query("distance_bands", "SELECT CASE WHEN y < 1400 THEN 'sprint' WHEN y < 1800 THEN 'mile' WHEN y < 2400 THEN 'middle' ELSE 'staying' END AS band, count(*) AS n FROM (SELECT distance_f * 220 AS y FROM races) GROUP BY 1")(lambda v: R.counts_by(v.races, S.distance_band(S.yards(F.concat(P("distance_f").cast("string"), F.lit("f")))).alias("band")))
# -- pedigree -------------------------------------------------------------------------------------

CLASSES = ", ".join(f"count(*) FILTER (WHERE position = 1 AND race_class = {c}) AS class_{c}_wins" for c in range(1, 8))
BEST = "CASE " + " ".join(f"WHEN class_{c}_wins = m AND m > 0 THEN {c}" for c in range(1, 8)) + " END AS best_class"
PROGENY = (
    "SELECT *, round(100.0::DOUBLE * wins / runs, 2) AS win_rate, round(100.0::DOUBLE * places / runs, 2) AS place_rate, round(runs::DOUBLE / progeny, 2) AS runs_per_horse, round(wins::DOUBLE / progeny, 2) AS wins_per_horse FROM ("
    "SELECT * EXCLUDE (m), " + BEST + " FROM (SELECT *, greatest(" + ", ".join(f"class_{c}_wins" for c in range(1, 8)) + ") AS m FROM ("
    "SELECT ancestor_id, count(DISTINCT horse_id) AS progeny, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, sum(prize_won) AS prize, " + CLASSES + " FROM lineage WHERE relation = '{}' GROUP BY ancestor_id)))"
)
OWN = "count(*) AS own_runs, count(*) FILTER (WHERE position = 1) AS own_wins, count(*) FILTER (WHERE position <= 3) AS own_places, sum(prize_won) AS own_prize, min(position) AS best_position, round(avg(position), 2) AS avg_position, min(race_date) AS first_run, max(race_date) AS last_run, max(race_date) FILTER (WHERE position = 1) AS last_win"
for relation in ("sire", "dam", "damsire"):
    query(f"progeny_{relation}", PROGENY.format(relation))(lambda v, r=relation: G.progeny_stats(v.lineage.where(P("relation") == r)))
query("own_career", f"SELECT horse_id, {OWN} FROM runs GROUP BY horse_id")(lambda v: G.own_career(v.runs).withColumn("best_position", P("best_position").cast("long")))
query("lineage_edges", "SELECT race_id, horse_id, generation, relation, ancestor_id, concat_ws('_', race_id, horse_id, generation, relation) AS lineage_id FROM lineage")(
    lambda v: v.lineage.select("race_id", "horse_id", "generation", "relation", "ancestor_id", "lineage_id")
)
query("lineage_summary", "SELECT generation, relation, count(*) AS n, count(DISTINCT ancestor_id) AS ancestors, count(DISTINCT horse_id) AS horses FROM lineage GROUP BY ALL")(lambda v: R.lineage_summary(v.lineage))
query("lineage_duplicates", "SELECT horse_id, relation, count(*) AS n FROM lineage GROUP BY ALL HAVING count(*) > 1")(lambda v: Q.duplicates(v.lineage, ["horse_id", "relation"]))
query("ancestor_with_own_career", f"SELECT h.horse_id, coalesce(own_runs, 0) AS own_runs, coalesce(own_wins, 0) AS own_wins, coalesce(progeny, 0) AS progeny FROM horses h LEFT JOIN (SELECT horse_id, {OWN} FROM runs GROUP BY 1) o ON o.horse_id = h.horse_id LEFT JOIN (SELECT ancestor_id, count(DISTINCT horse_id) AS progeny FROM lineage WHERE relation = 'damsire' GROUP BY 1) p ON p.ancestor_id = CAST(h.horse_id AS VARCHAR)")(
    lambda v: v.horses.select("horse_id").join(G.own_career(v.runs).select("horse_id", "own_runs", "own_wins"), "horse_id", "left")
    .join(v.lineage.where("relation = 'damsire'").groupBy("ancestor_id").agg(F.countDistinct("horse_id").alias("progeny")), P("horse_id").cast("string") == P("ancestor_id"), "left")
    .select("horse_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own_runs", "own_wins", "progeny")])
)
for category, column in (("class", "race_class"), ("distance", "distance_f")):
    query(
        f"sire_top_{category}",
        f"SELECT *, round(100.0::DOUBLE * wins / runs, 2) AS win_rate FROM (SELECT *, row_number() OVER (PARTITION BY sire_id ORDER BY wins DESC, {column})::INT AS rank FROM (SELECT sire_id, {column}, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM runs JOIN horses USING (horse_id) GROUP BY ALL)) WHERE rank <= 3",
    )(lambda v, c=column: W.top_categories(v.runs.join(v.horses, "horse_id"), "sire_id", c))
query("sire_class_index", "SELECT sire_id, count(*) AS runs, round(count(*) FILTER (WHERE position = 1) * 100.0::DOUBLE / sum(CASE race_class WHEN 1 THEN 0.10 WHEN 2 THEN 0.11 WHEN 3 THEN 0.12 WHEN 4 THEN 0.13 WHEN 5 THEN 0.14 WHEN 6 THEN 0.15 WHEN 7 THEN 0.16 ELSE 0.125 END::DOUBLE), 3) AS ae_index FROM runs JOIN horses USING (horse_id) GROUP BY ALL")(
    lambda v: G.expected_index(v.runs.join(v.horses, "horse_id"), "sire_id", G.class_rate(P("race_class")))
)
query("sire_distance_index", "SELECT sire_id, count(*) AS runs, round(count(*) FILTER (WHERE position = 1) * 100.0::DOUBLE / sum(CASE WHEN distance_f <= 7 THEN 0.12 WHEN distance_f <= 10 THEN 0.13 WHEN distance_f <= 14 THEN 0.12 ELSE 0.11 END::DOUBLE), 3) AS ae_index FROM runs JOIN horses USING (horse_id) GROUP BY ALL")(
    lambda v: G.expected_index(v.runs.join(v.horses, "horse_id"), "sire_id", G.distance_rate(P("distance_f")))
)
query("sire_quality_score", "SELECT ancestor_id, round(CASE WHEN bp IS NOT NULL THEN 0.6 ELSE 0 END + CASE WHEN lw IS NOT NULL THEN 0.4 ELSE 0 END, 2)::DOUBLE AS score FROM (SELECT ancestor_id, min(position) AS bp, max(race_date) FILTER (WHERE position = 1) AS lw FROM lineage WHERE relation = 'damsire' GROUP BY 1)")(lambda v: R.best_of_progeny(v.lineage.where("relation = 'damsire'")).select("ancestor_id", G.completeness_score({"bp": 0.6, "lw": 0.4}).alias("score")))
query("top_sires", "SELECT ancestor_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM lineage WHERE relation = 'sire' GROUP BY 1 HAVING count(*) >= 100 ORDER BY wins DESC, ancestor_id LIMIT 10")(
    lambda v: G.progeny_stats(v.lineage.where("relation = 'sire'")).where("runs >= 100").select("ancestor_id", "runs", "wins").orderBy(F.desc("wins"), "ancestor_id").limit(10)
)
query("top_dams", "SELECT ancestor_id, runs, wins, round(100.0::DOUBLE * wins / runs, 2) AS win_rate FROM (SELECT ancestor_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM lineage WHERE relation = 'dam' GROUP BY 1) WHERE runs >= 50 ORDER BY win_rate DESC, wins DESC, ancestor_id LIMIT 10")(
    lambda v: G.progeny_stats(v.lineage.where("relation = 'dam'")).where("runs >= 50").select("ancestor_id", "runs", "wins", "win_rate").orderBy(F.desc("win_rate"), F.desc("wins"), "ancestor_id").limit(10)
)
query("popular_sire_runners", "WITH top AS (SELECT ancestor_id FROM lineage WHERE relation = 'sire' GROUP BY 1 ORDER BY count(DISTINCT horse_id) DESC, ancestor_id LIMIT 1) SELECT race_id, horse_id, race_date FROM lineage WHERE relation = 'sire' AND ancestor_id IN (SELECT ancestor_id FROM top) ORDER BY race_date DESC, race_id, horse_id LIMIT 10")(
    lambda v: v.lineage.where("relation = 'sire'").join(v.lineage.where("relation = 'sire'").groupBy("ancestor_id").agg(F.countDistinct("horse_id").alias("n")).orderBy(F.desc("n"), "ancestor_id").limit(1), "ancestor_id", "left_semi")
    .select("race_id", "horse_id", "race_date").orderBy(F.desc("race_date"), "race_id", "horse_id").limit(10)
)
query("descendants_of", "SELECT DISTINCT ancestor_id, horse_id, relation FROM lineage WHERE relation LIKE '%sire%'")(lambda v: G.descendants(v.lineage))

# -- joins and sets -------------------------------------------------------------------------------

query("prior_runs", "SELECT a.race_id, a.horse_id, count(b.horse_id) AS prior_runs, count(*) FILTER (WHERE b.position = 1) AS prior_wins, max(b.race_date) AS last_run, count(*) FILTER (WHERE b.distance_f BETWEEN a.distance_f * 0.9 AND a.distance_f * 1.1) AS near_runs, count(*) FILTER (WHERE b.position = 1 AND b.distance_f BETWEEN a.distance_f * 0.9 AND a.distance_f * 1.1) AS near_wins FROM runs a LEFT JOIN runs b ON a.horse_id = b.horse_id AND b.race_date < a.race_date GROUP BY ALL")(
    lambda v: J.prior_runs(v.runs, 0.1)
)
query("races_without_runners", "SELECT race_id FROM races WHERE race_id NOT IN (SELECT race_id FROM runs)")(lambda v: J.absent(v.races.select("race_id"), v.runs.select("race_id"), "race_id"))
query("active_horses", "SELECT horse_id FROM horses WHERE horse_id IN (SELECT horse_id FROM runs, ended WHERE race_date >= d - 30)")(lambda v: J.active_since(v.runs, v.horses.select("horse_id"), "horse_id", F.date_sub(v.as_of, 30)))
query("valid_references", "SELECT d.doc_id, l.doc_id AS label_id, (l.doc_id IS NULL)::INT AS nullified FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)", False)(
    lambda v: J.valid_references(v.table("documents").select("doc_id", P("doc_id").alias("label_id")), {"label_id": (v.table("labels"), "doc_id")})
)
query("match_names", "WITH h AS (SELECT p_partkey AS horse_id, lower(trim(p_name)) AS n, lower(p_brand) AS r FROM part), b AS (SELECT n, r, min(horse_id) AS id FROM h GROUP BY ALL), a AS (SELECT n, min(horse_id) AS id FROM h GROUP BY n HAVING count(*) = 1), q AS (SELECT DISTINCT p_name AS name, p_brand AS region FROM part) SELECT q.name, q.region, coalesce(b.id, a.id) AS matched_id, CASE WHEN b.id IS NOT NULL THEN 'name_region' WHEN a.id IS NOT NULL THEN 'name' ELSE 'none' END AS match_method FROM q LEFT JOIN b ON lower(trim(q.name)) = b.n AND lower(q.region) = b.r LEFT JOIN a ON lower(trim(q.name)) = a.n", False)(
    lambda v: J.match_names(v.table("part").select(P("p_name").alias("name"), P("p_brand").alias("region")).distinct(), v.table("part").select(P("p_partkey").alias("horse_id"), P("p_name").alias("name"), P("p_brand").alias("region")))
)
query("reconcile_counts", "SELECT race_id, coalesce(a, 0) AS source_n, coalesce(b, 0) AS stored_n, CASE WHEN b IS NULL THEN 'zero' WHEN a = b THEN 'match' WHEN a > coalesce(b, 0) THEN 'source_more' ELSE 'stored_more' END AS state FROM (SELECT race_id, count(*) AS a FROM races GROUP BY 1) FULL JOIN (SELECT race_id, count(*) AS b FROM runs GROUP BY 1) USING (race_id)")(
    lambda v: J.reconcile(v.races, v.runs, "race_id")
)
query("course_coordinates", "SELECT n_nationkey AS course_id, n_name AS name, r_regionkey + 0.5::DOUBLE AS latitude, r_regionkey - 0.5::DOUBLE AS longitude FROM nation LEFT JOIN region ON n_regionkey = r_regionkey", False)(
    lambda v: J.add_coordinates(
        v.table("nation").select(P("n_nationkey").alias("course_id"), P("n_name").alias("name"), P("n_regionkey").alias("rk"), F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude")),
        v.table("region").select("r_regionkey", (P("r_regionkey") + 0.5).alias("latitude"), (P("r_regionkey") - 0.5).alias("longitude")), [P("rk")], [P("r_regionkey")],
    ).drop("rk")
)
query("calendar_gaps", "SELECT day FROM (SELECT unnest(generate_series(min(race_date), max(race_date), INTERVAL 1 DAY))::DATE AS day FROM races) WHERE day NOT IN (SELECT race_date FROM races)")(
    lambda v: J.calendar_gaps(v.races, "race_date")
)
query("calendar_gaps_all", "SELECT day FROM (SELECT unnest(generate_series(min(race_date), max(race_date), INTERVAL 1 DAY))::DATE AS day FROM races) WHERE day NOT IN (SELECT race_date FROM races)")(
    lambda v: J.calendar_gaps(v.races, "race_date")
)
query(
    "calendar_gaps_by_region",
    "WITH x AS (SELECT region, min(race_date) AS a, max(race_date) AS b FROM races GROUP BY 1), y AS (SELECT region, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM x) SELECT region, day FROM y WHERE (region, day) NOT IN (SELECT region, race_date FROM races)",
)(lambda v: J.calendar_gaps(v.races, "race_date", by=["region"]))
query("month_chunks", "SELECT greatest(m, d0)::DATE AS chunk_start, least(last_day(m), d1)::DATE AS chunk_end FROM (SELECT min(race_date) AS d0, max(race_date) AS d1, unnest(generate_series(date_trunc('month', min(race_date)), max(race_date)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS m FROM races)")(
    lambda v: (lambda r: J.month_chunks(str(r[0]), str(r[1]), v.spark))(v.races.agg(F.min("race_date"), F.max("race_date")).first())
)
query("distinct_entities", f"SELECT DISTINCT entity_type, entity_id FROM ({UNPIVOT})")(lambda v: A.unpivot_entities(v.runs, ENTITIES, []).distinct())
query("multi_race_days", "SELECT horse_id, race_date, count(*) AS n, string_agg(race_id, ',' ORDER BY race_id) AS races FROM runs GROUP BY ALL HAVING count(*) > 1")(lambda v: R.busy_days(v.runs))
query("runners_per_race", "SELECT round(avg(n), 4) AS mean_runners, count(*) FILTER (WHERE n = 0) AS without FROM (SELECT race_id, count(horse_id) AS n FROM races LEFT JOIN runs USING (race_id) GROUP BY race_id)")(lambda v: R.mean_runners(R.runners_by_race(v.races, v.runs)))
query("entity_ratios", "SELECT round(count(*)::DOUBLE / count(DISTINCT race_id), 4) AS runners_per_race, round(count(DISTINCT horse_id)::DOUBLE / count(DISTINCT race_id), 4) AS horses_per_race FROM runs")(lambda v: R.entity_ratios(v.runs))
query("region_filter", "SELECT region, count(*) AS n FROM races WHERE lower(region) IN ('europe', 'asia') GROUP BY region")(lambda v: R.counts_by(v.races.where(S.in_region(P("region"), ("europe", "asia"))), "region"))
query("region_name_filter", "SELECT DISTINCT course_id FROM races WHERE regexp_matches(region, '(?i)amer|afr') OR coalesce(region, '') = ''")(
    lambda v: v.races.where(S.in_country(P("region"), ("amer", "afr")) | (F.coalesce("region", F.lit("")) == "")).select("course_id").distinct()
)
query("since_date_races", "SELECT races.* FROM races, ended WHERE race_date >= d - 60 AND race_date <= d - 10")(lambda v: v.races.where((P("race_date") >= F.date_sub(v.as_of, 60)) & (P("race_date") <= F.date_sub(v.as_of, 10))))

# -- windows and features -------------------------------------------------------------------------

query("first_seen_entities", "SELECT jockey_id, race_id, horse_id FROM (SELECT *, row_number() OVER (PARTITION BY jockey_id ORDER BY race_date, race_id, horse_id) AS r FROM runs) WHERE r = 1")(
    lambda v: W.top_by(v.runs.select("jockey_id", "race_date", "race_id", "horse_id"), ["jockey_id"], [P("race_date"), P("race_id"), P("horse_id")]).drop("race_date")
)
query("latest_event", "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1", False)(
    lambda v: W.top_by(v.table("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")
)
query("last_ten_runs", "SELECT horse_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position = 2) AS seconds, count(*) FILTER (WHERE position = 3) AS thirds FROM (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC) AS r FROM runs WHERE position IS NOT NULL) WHERE r <= 10 GROUP BY horse_id")(lambda v: W.last_runs(v.runs))
FORM = "CASE position WHEN 1 THEN 10 WHEN 2 THEN 7 WHEN 3 THEN 5 WHEN 4 THEN 3 ELSE 1 END * CASE r WHEN 1 THEN 2.0 WHEN 2 THEN 1.5 WHEN 3 THEN 1.2 ELSE 1.0 END::DOUBLE"
query("form_lines", f"SELECT horse_id, round(sum({FORM}) / 67 * 100, 2) AS form_score, " + ", ".join(f"string_agg({c}, ',' ORDER BY r) AS last_{c}" for c in ("position", "race_date", "course_id", "distance_f", "race_class")) + " FROM (SELECT *, row_number() OVER (PARTITION BY horse_id ORDER BY race_date DESC, race_id DESC) AS r FROM runs WHERE position IS NOT NULL) WHERE r <= 5 GROUP BY horse_id")(lambda v: W.form_lines(v.runs))


def _record_sql(before: bool) -> str:
    out = []
    frame = " ORDER BY race_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING" if before else ""
    for name, keys in W.CONTEXTS.items():
        over = f"OVER (PARTITION BY {', '.join(('horse_id', *keys))}{frame})"
        out += [f"count(position) {over} AS {name}_runs", f"count(CASE WHEN position = 1 THEN 1 END) {over} AS {name}_wins"]
    over = f"OVER (PARTITION BY horse_id{frame})"
    out += [f"count(CASE WHEN position IS NOT NULL AND lower(going) LIKE '%{k}%' THEN 1 END) {over} AS {k}_runs" for k in ("firm", "good", "soft", "heavy")]
    out += [f"count(CASE WHEN position IS NOT NULL AND lower(surface) IN {kinds} THEN 1 END) {over} AS {name}_runs" for name, kinds in (("aw", "('aw', 'all weather', 'tapeta', 'polytrack')"), ("jumps", "('hurdle', 'chase', 'nh flat')"))]
    return f"SELECT race_id, horse_id, {', '.join(out)} FROM runs"


query("runner_record", _record_sql(False))(lambda v: W.runner_record(v.runs))
query("runner_record_before_race", _record_sql(True))(lambda v: W.runner_record(v.runs, before_race=True))
query("rolling_year", "SELECT race_id, horse_id, count(position) OVER w AS runs_window, count(CASE WHEN position = 1 THEN 1 END) OVER w AS wins_window FROM runs WINDOW w AS (PARTITION BY horse_id ORDER BY race_date RANGE BETWEEN INTERVAL 365 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)")(lambda v: W.rolling(v.runs, "horse_id"))
query("last_price_in_group", "SELECT jockey_id, distance_f, arg_max(sp_decimal, (race_date, race_id, horse_id)) AS last_price FROM runs GROUP BY ALL")(lambda v: R.latest_value(v.runs, ["jockey_id", "distance_f"], "sp_decimal", "last_price"))
query("sample_by_region", "SELECT region, race_id FROM (SELECT region, race_id, row_number() OVER (PARTITION BY region ORDER BY race_id) AS r FROM races) WHERE r <= 3")(lambda v: W.top_by(v.races.select("region", "race_id"), ["region"], [P("race_id")], 3))
CONTEXT_STATS = {"course": "b.course_id = a.course_id", "surface": "b.surface = a.surface", "going": "b.going = a.going", "class": "b.race_class = a.race_class", "jockey": "b.jockey_id = a.jockey_id", "trainer": "b.trainer_id = a.trainer_id"}
query("ml_context_stats", "SELECT a.race_id, a.horse_id, count(b.horse_id) AS career_runs, count(*) FILTER (WHERE b.position = 1) AS career_wins, round(avg(b.position), 4) AS avg_finish, datediff('day', max(b.race_date), any_value(a.race_date))::INT AS days_since, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}_runs, count(*) FILTER (WHERE {c} AND b.position = 1) AS {k}_wins" for k, c in CONTEXT_STATS.items()) + " FROM runs a LEFT JOIN runs b ON a.horse_id = b.horse_id AND b.race_date < a.race_date GROUP BY a.race_id, a.horse_id")(lambda v: W.context_stats(v.runs))
CONTEXT_RATES = ", ".join(f"CASE WHEN {k}_runs > 0 THEN round(100.0::DOUBLE * {k}_wins / {k}_runs, 2) END AS {k}_win_rate" for k in ("career", *CONTEXT_STATS))
query("ml_context_stats_all", "SELECT a.race_id, a.horse_id, count(b.horse_id) AS career_runs, count(*) FILTER (WHERE b.position = 1) AS career_wins, round(avg(b.position), 4) AS avg_finish, datediff('day', max(b.race_date), any_value(a.race_date))::INT AS days_since, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}_runs, count(*) FILTER (WHERE {c} AND b.position = 1) AS {k}_wins" for k, c in CONTEXT_STATS.items()) + " FROM runs a LEFT JOIN runs b ON a.horse_id = b.horse_id AND b.race_date < a.race_date GROUP BY a.race_id, a.horse_id")(lambda v: W.context_stats(v.runs))
query("ml_context_rates", f"SELECT *, {CONTEXT_RATES} FROM (" + "SELECT a.race_id, a.horse_id, count(b.horse_id) AS career_runs, count(*) FILTER (WHERE b.position = 1) AS career_wins, round(avg(b.position), 4) AS avg_finish, datediff('day', max(b.race_date), any_value(a.race_date))::INT AS days_since, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}_runs, count(*) FILTER (WHERE {c} AND b.position = 1) AS {k}_wins" for k, c in CONTEXT_STATS.items()) + " FROM runs a LEFT JOIN runs b ON a.horse_id = b.horse_id AND b.race_date < a.race_date GROUP BY a.race_id, a.horse_id" + ")")(lambda v: W.with_context_rates(W.context_stats(v.runs)))
query("upcoming_summary", "SELECT r.race_id, count(*) AS runners, round(avg(w), 4) AS mean_win_rate FROM (SELECT race_id, horse_id FROM runs, ended WHERE race_date = d) r JOIN (SELECT horse_id, 100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*) AS w FROM runs GROUP BY 1) USING (horse_id) GROUP BY r.race_id")(lambda v: R.upcoming_win_rates(v.runs, v.runs.where(P("race_date") == v.as_of)))
# -- sources, sinks, parsers ----------------------------------------------------------------------

query("payload_field", "SELECT event_id, CASE WHEN regexp_matches(json_extract_string(props, '$.k'), '^[0-9]+$') THEN try_cast(json_extract_string(props, '$.k') AS INT) END AS k FROM events", False)(
    lambda v: sinks.typed_payload(v.table("events").select("event_id", "props", F.lit(None).cast("int").alias("k")), "k", "props", "$.k", r"^[0-9]+$", "int").drop("props")
)
query("upsert_latest", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, (event_id % 2) DESC, event_id DESC) AS r FROM events) WHERE r = 1", False)(
    lambda v: sinks.upsert(v.table("events").where("event_id % 2 = 0"), v.table("events").where("event_id % 2 = 1"), ["user_id", "event_type"], "ts", ["event_id"]).select("user_id", "event_type", "event_id", "value")
)
query("fill_missing", "SELECT d.doc_id, coalesce(CASE WHEN d.doc_id % 3 > 0 THEN d.n_chars END, l.quality) AS n FROM documents d LEFT JOIN labels l USING (doc_id)", False)(
    lambda v: sinks.fill_missing(v.table("documents").select("doc_id", F.when(P("doc_id") % 3 > 0, P("n_chars")).alias("n")), v.table("labels").select("doc_id", P("quality").cast("long").alias("n")), "doc_id", ["n"])
)
query("retention", "SELECT race_id FROM races, ended WHERE race_date >= d - 365")(lambda v: sinks.keep_since(v.races, "race_date", v.as_of, 365).select("race_id"))
query("out_of_region_dry_run", "SELECT region, race_id FROM (SELECT region, race_id, row_number() OVER (PARTITION BY region ORDER BY race_id) AS r FROM races WHERE NOT region IN ('EUROPE', 'ASIA')) WHERE r <= 3")(
    lambda v: sinks.drop_outside(v.races.select("region", "race_id"), P("region").isin("EUROPE", "ASIA"), "region", 3, "race_id")
)
query("merge_twins", "SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_linenumber > 3 THEN l_tax END, l_discount) AS tax FROM lineitem", False)(
    lambda v: sinks.merge_twins(v.table("lineitem").select("l_orderkey", "l_linenumber", F.when(P("l_linenumber") > 3, P("l_tax")).alias("tax"), P("l_discount").alias("tax2")), {"tax": "tax2"})
)
query("parsed_positions", "SELECT position_raw, count(*) AS n, count(*) FILTER (WHERE position = 1) AS winners, count(*) FILTER (WHERE position_raw IN ('PU', 'F')) AS dnf FROM runs GROUP BY position_raw")(lambda v: R.position_texts(v.runs))
query("parsed_class", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) AS race_class FROM orders", False)(lambda v: v.table("orders").select("o_orderkey", S.race_class(F.concat(F.lit("Class "), F.substring("o_orderpriority", 1, 1))).alias("race_class")))
query("parsed_money", "SELECT o_orderkey, o_totalprice AS prize FROM orders", False)(lambda v: v.table("orders").select("o_orderkey", S.money(F.concat(F.lit("£"), F.format_string("%.2f", "o_totalprice"))).alias("prize")))
query("parsed_distance", "SELECT race_id, (distance_f // 8) * 1609 + (distance_f % 8) * 201 AS metres, distance_f * 220 AS yards FROM races")(
    lambda v: v.races.select("race_id", F.concat((P("distance_f") / 8).cast("int"), F.lit("m"), P("distance_f") % 8, F.lit("f")).alias("t")).select("race_id", S.metres(P("t")).alias("metres"), S.yards(P("t")).alias("yards"))
)
query("name_keys", "SELECT c_custkey, lower(trim(regexp_replace(c_name, '\\s+', ' ', 'g'))) AS k FROM customer", False)(lambda v: v.table("customer").select("c_custkey", S.name_key(P("c_name")).alias("k")))
query("horse_age", "SELECT race_id, datesub('year', DATE '1990-06-15', race_date)::INT AS age FROM races")(lambda v: v.races.select("race_id", S.age_years(P("race_date"), F.lit("1990-06-15").cast("date")).alias("age")))
query("update_phase", "SELECT race_id, CASE WHEN h < 0 THEN 'post' WHEN h < 24 THEN 'race_day' ELSE 'pre' END AS phase FROM (SELECT race_id, race_id % 60 - 20 AS h FROM races)")(lambda v: v.races.select("race_id", S.update_phase(P("race_id") % 60 - 20).alias("phase")))
query("event_windows", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL", False)(
    lambda v: live.event_windows(v.table("events").withColumn("ts", P("ts").cast("timestamp")), "ts", "event_type", "1 hour", "7 days").select("event_type", P("window_start").cast("timestamp_ntz").alias("window_start"), "n", F.round("total", 4).alias("total"))
)

# -- data quality ---------------------------------------------------------------------------------

POPULATION = "SELECT '{0}' AS column_name, count(*) AS n, count({0}) AS filled, count(*) - count({0}) AS missing, round(count({0}) * 100.0::DOUBLE / count(*), 2) AS percent FROM runs"
RUN_COLUMNS = ["race_id", "horse_id", "position", "prize_won", "going"]
POP_SQL = "SELECT *, CASE WHEN percent = 0 THEN 'empty' WHEN percent < 20 THEN 'sparse' WHEN percent < 80 THEN 'partial' WHEN percent < 100 THEN 'good' ELSE 'complete' END AS status FROM (" + " UNION ALL ".join(POPULATION.format(c) for c in RUN_COLUMNS) + ")"
query("dq_population", POP_SQL)(lambda v: Q.column_population(v.runs, RUN_COLUMNS))
query("dq_profile", f"SELECT *, CASE WHEN well_filled / columns >= 0.8 THEN 'good' WHEN well_filled / columns >= 0.5 THEN 'fair' ELSE 'poor' END AS status FROM (SELECT count(*) AS columns, count(*) FILTER (WHERE percent >= 80) AS well_filled, count(*) FILTER (WHERE filled = 0) AS empty FROM ({POP_SQL}))")(lambda v: Q.table_profile(Q.column_population(v.runs, RUN_COLUMNS)))
query("dq_severity", f"SELECT column_name, percent, CASE WHEN percent = 0 THEN 'HIGH' WHEN percent < 10 THEN 'MEDIUM' ELSE 'OK' END AS severity FROM ({POP_SQL})")(lambda v: Q.severity(Q.column_population(v.runs, RUN_COLUMNS)))
query("dq_null_bands", f"SELECT column_name, round(100 - percent, 2) AS null_percent, CASE WHEN 100 - percent > 50 THEN 'above_50' WHEN 100 - percent > 10 THEN 'above_10' WHEN 100 - percent > 0 THEN 'above_0' ELSE 'none' END AS band FROM ({POP_SQL})")(lambda v: Q.null_bands(Q.column_population(v.runs, RUN_COLUMNS)))
query("dq_conditions", "SELECT 'no_position' AS check_name, count(*) FILTER (WHERE position IS NULL) AS n FROM runs UNION ALL SELECT 'outside_region', count(*) FILTER (WHERE region NOT IN ('EUROPE', 'ASIA')) FROM runs UNION ALL SELECT 'winner_without_prize', count(*) FILTER (WHERE position = 1 AND prize_won = 0) FROM runs")(
    lambda v: Q.condition_counts(v.runs, {"no_position": P("position").isNull(), "outside_region": ~P("region").isin("EUROPE", "ASIA"), "winner_without_prize": (P("position") == 1) & (P("prize_won") == 0)})
)
query("dq_orphans", "SELECT 'doc_id' AS reference, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)", False)(lambda v: Q.orphans(v.table("documents"), [("doc_id", v.table("labels"), "doc_id")]))
query("dq_duplicate_lines", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1", False)(lambda v: Q.duplicates(v.table("lineitem"), ["l_orderkey", "l_linenumber"]))
query("dq_duplicate_names", "SELECT sum(c)::BIGINT AS total, count(*) AS distinct_names, count(*) FILTER (WHERE c > 1) AS repeated_names FROM (SELECT p_name, count(*) AS c FROM part GROUP BY 1)", False)(lambda v: Q.name_duplicates(v.table("part"), "p_name"))
query("dq_freshness", "SELECT max(ts)::DATE AS latest, datediff('day', max(ts)::DATE, DATE '2024-02-02')::INT AS age_days, CASE WHEN datediff('day', max(ts)::DATE, DATE '2024-02-02') <= 2 THEN 'fresh' WHEN datediff('day', max(ts)::DATE, DATE '2024-02-02') <= 3 THEN 'warning' ELSE 'stale' END AS state FROM events", False)(
    lambda v: Q.freshness(v.table("events").select(F.to_date("ts").alias("day")), "day", F.lit("2024-02-02").cast("date"), 2)
)
query("dq_twins", "SELECT count(l_discount) AS first_filled, count(l_tax) AS second_filled, count(*) FILTER (WHERE l_discount = l_tax) AS equal, count(*) FILTER (WHERE l_discount <> l_tax) AS different, CASE WHEN count(l_tax) = 0 THEN 'DROP' WHEN count(*) FILTER (WHERE l_discount <> l_tax) = 0 THEN 'MERGE' ELSE 'KEEP' END AS advice FROM lineitem", False)(lambda v: Q.twin_columns(v.table("lineitem"), "l_discount", "l_tax"))
query("dq_recomputed_rate", "SELECT jockey_id, win_rate, round(win_rate + CASE WHEN jockey_id % 5 = 0 THEN 1 ELSE 0 END, 2) AS stored FROM (SELECT jockey_id, round(100.0::DOUBLE * count(*) FILTER (WHERE position = 1) / count(*), 2) AS win_rate FROM runs GROUP BY 1) WHERE jockey_id % 5 = 0")(
    lambda v: A.lifetime(v.runs, "jockey_id").select("jockey_id", "win_rate", F.round(P("win_rate") + F.when(P("jockey_id") % 5 == 0, 1).otherwise(0), 2).alias("stored")).where(F.abs(P("stored") - P("win_rate")) > 0.1)
)
query("dq_region_distribution", "SELECT upper(region) AS region, count(*) AS n FROM races GROUP BY 1")(lambda v: R.counts_by(v.races, F.upper("region").alias("region")))
query("yearly_coverage", "SELECT year, coalesce(n, 0) AS n FROM (SELECT unnest(range(min(year(race_date)), max(year(race_date)) + 1))::INT AS year FROM races) LEFT JOIN (SELECT year(race_date)::INT AS year, count(*) AS n FROM races GROUP BY 1) USING (year)")(lambda v: A.yearly_coverage(v.races, "race_date"))
query("yearly_completeness", "SELECT year(race_date)::INT AS year, count(*) AS n, round(100.0::DOUBLE * count(*) / 2500, 2) AS percent, CASE WHEN round(100.0::DOUBLE * count(*) / 2500, 2) >= 90 THEN 'complete' WHEN round(100.0::DOUBLE * count(*) / 2500, 2) >= 50 THEN 'partial' ELSE 'missing' END AS status FROM races GROUP BY 1")(lambda v: A.completeness(A.yearly_coverage(v.races, "race_date"), 2500))
query("result_split", "SELECT count(*) AS n, count(*) FILTER (WHERE position IS NULL) AS entries, count(position) AS results, round(100.0::DOUBLE * count(position) / count(*), 2) AS result_percent FROM runs")(lambda v: R.result_split(v.runs))
query("coverage_union", "SELECT 'sire' AS kind, count(DISTINCT sire_id) AS n FROM horses UNION ALL SELECT 'dam', count(DISTINCT dam_id) FROM horses UNION ALL SELECT 'damsire', count(DISTINCT damsire_id) FROM horses")(lambda v: R.distinct_by_kind(v.horses, {"sire": "sire_id", "dam": "dam_id", "damsire": "damsire_id"}))
query("run_history", "SELECT race_id, horse_id, race_date, course_id, position FROM runs")(lambda v: v.runs.select("race_id", "horse_id", "race_date", "course_id", "position"))
query("run_history_all", "SELECT race_id, horse_id, race_date, course_id, position FROM runs WHERE position IS NOT NULL ORDER BY horse_id, race_date DESC, race_id DESC")(
    lambda v: v.runs.where("position is not null").select("race_id", "horse_id", "race_date", "course_id", "position").orderBy("horse_id", F.desc("race_date"), F.desc("race_id"))
)
query("breeding_multiplier", "SELECT ancestor_id, progeny_wins, own_wins, round(progeny_wins::DOUBLE / own_wins, 2) AS multiplier FROM (SELECT ancestor_id, count(*) AS progeny_wins FROM lineage WHERE relation = 'damsire' AND position = 1 GROUP BY 1) JOIN (SELECT CAST(horse_id AS VARCHAR) AS ancestor_id, count(*) AS own_wins FROM runs WHERE position = 1 GROUP BY 1) USING (ancestor_id)")(
    lambda v: G.breeding_multiplier(v.lineage.where("relation = 'damsire'"), G.own_career(v.runs))
)
query("breeding_multiplier_own_wins", "SELECT ancestor_id, progeny_wins, own_wins, round(progeny_wins::DOUBLE / own_wins, 2) AS multiplier FROM (SELECT ancestor_id, count(*) AS progeny_wins FROM lineage WHERE relation = 'damsire' AND position = 1 GROUP BY 1) JOIN (SELECT CAST(horse_id AS VARCHAR) AS ancestor_id, count(*) AS own_wins FROM runs WHERE position = 1 GROUP BY 1) USING (ancestor_id)")(
    lambda v: G.breeding_multiplier(v.lineage.where("relation = 'damsire'"), G.own_career(v.runs))
)
query("staleness_by_region", "SELECT region, max(race_date) AS latest, datediff('day', max(race_date), any_value(d))::INT AS age_days FROM races, ended GROUP BY region")(lambda v: R.staleness(v.races, "region", v.as_of))
# -- logs, coverage and reports -------------------------------------------------------------------

query("marker_rows_excluded", "SELECT c_custkey FROM customer WHERE c_name NOT LIKE 'Customer#0000001%'", False)(lambda v: v.table("customer").where(~P("c_name").startswith("Customer#0000001")).select("c_custkey"))
query("run_log_statistics", "SELECT user_id, count(*) AS runs, count(*) FILTER (WHERE event_type <> 'error') AS successes, round(100.0::DOUBLE * count(*) FILTER (WHERE event_type <> 'error') / count(*), 2) AS success_rate FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1", False)(lambda v: R.success_rates(v.table("events").where(P("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")), "user_id", P("event_type") == "error"))
query("update_history", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id LIMIT 20", False)(
    lambda v: v.table("events").where("event_type = 'error'").orderBy(F.desc("ts"), "event_id").limit(20).select("event_id", "user_id", "event_type")
)
query("result_arrival", "SELECT race_date, count(*) AS runs, count(position) AS results, count(DISTINCT race_id) AS races FROM runs GROUP BY race_date")(lambda v: R.arrival_by_day(v.runs))
query("feature_quality", "SELECT race_date, count(*) AS rows, count(*) FILTER (WHERE position IS NOT NULL AND sp_decimal > 1) AS complete, round(avg(sp_decimal), 4) AS mean_price, max(position) AS last_position FROM runs GROUP BY race_date")(lambda v: R.feature_quality(v.runs))
query("ancestor_coverage", "SELECT count(DISTINCT damsire_id) AS ancestors, count(DISTINCT damsire_id) FILTER (WHERE damsire_id IN (SELECT CAST(horse_id AS VARCHAR) FROM runs)) AS found FROM horses")(lambda v: R.ancestor_coverage(v.horses, v.runs, "damsire_id"))
query("races_without_results", "SELECT race_id FROM runs GROUP BY race_id HAVING count(position) = 0")(lambda v: R.races_without_results(v.runs))
query("history_text", "SELECT horse_id, string_agg(race_date || ':' || position_raw, ';' ORDER BY race_date DESC, race_id DESC) AS history FROM runs GROUP BY horse_id")(lambda v: R.history_text(v.runs))
query("regions_from_courses", "SELECT region, min(course_id) AS course_id FROM races WHERE region IS NOT NULL GROUP BY region")(lambda v: W.top_by(v.races.where("region is not null").select("region", "course_id"), ["region"], [P("course_id")]))
query("race_coverage", "SELECT count(*) AS races, count(*) FILTER (WHERE n > 0) AS with_runners, count(*) FILTER (WHERE n = 0) AS without, sum(greatest(3 - n, 0))::BIGINT AS deficit FROM (SELECT race_id, count(horse_id) AS n FROM races LEFT JOIN runs USING (race_id) GROUP BY race_id)")(lambda v: R.race_coverage(R.runners_by_race(v.races, v.runs)))
query("backfill_estimate", "SELECT datediff('day', min(race_date), max(race_date))::INT + 1 AS days, count(*) AS races, round(count(*)::DOUBLE / (datediff('day', min(race_date), max(race_date)) + 1), 4) AS races_per_day FROM races")(lambda v: R.backfill_estimate(v.races))
query("row_minimum", "SELECT 'runs' AS table_name, count(*) AS n, CASE WHEN count(*) < 1000 THEN 'fail' WHEN count(*) < 2000 THEN 'warn' ELSE 'pass' END AS state FROM runs")(lambda v: R.row_minimum(v.runs, "runs", 1000, 2000))
RULES = [("position", "post_race"), ("prize_won", "post_race"), ("going", "optional")]
query("dq_null_categories", f"SELECT coalesce(category, 'unexpected') AS category, count(*) AS columns, sum(missing)::BIGINT AS missing FROM ({POP_SQL}) LEFT JOIN (VALUES ('position', 'post_race'), ('prize_won', 'post_race'), ('going', 'optional')) r(column_name, category) USING (column_name) GROUP BY 1")(lambda v: R.null_categories(Q.column_population(v.runs, RUN_COLUMNS), v.spark.createDataFrame(RULES, "column_name string, category string")))
query("position_from_payload", "SELECT event_id, coalesce(CASE WHEN event_id % 3 = 0 THEN event_id::INT END, try_cast(json_extract_string(props, '$.k') AS INT)) AS position FROM events", False)(
    lambda v: v.table("events").select("event_id", S.coalesced_position([F.when(P("event_id") % 3 == 0, P("event_id"))], P("props"), "$.k").alias("position"))
)
query("rolling_form_windows", "SELECT jockey_id, w AS window_start, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins FROM (SELECT jockey_id, position, unnest(generate_series((epoch(race_date)::BIGINT // 864000 - 2) * 864000, (epoch(race_date)::BIGINT // 864000) * 864000, 864000)) AS w FROM runs) GROUP BY ALL")(
    lambda v: live.rolling_form(v.runs.withColumn("at", P("race_date").cast("timestamp")), "jockey_id", "at", slide="10 days").select("jockey_id", F.unix_timestamp("window_start").alias("window_start"), "runs", "wins")
)
