"""Registered queries over several generations, each beside a recursive DuckDB query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pedigree as G
from . import views
from .register import query

P = F.col


def closure_query(name: str, sql: str):
    return query(name, f"WITH RECURSIVE {views.ANCESTRY_SQL}, {views.SQL} {sql.strip()}", with_views=False)


TOTALS = "(SELECT horse_id, count(*) AS runs, count(*) FILTER (WHERE position = 1) AS wins, count(*) FILTER (WHERE position <= 3) AS places, sum(prize_won) AS prize FROM runs GROUP BY 1)"
PATHS = "(SELECT ancestor_id, path, count(*) AS progeny, sum(runs)::BIGINT AS runs, sum(wins)::BIGINT AS wins, sum(places)::BIGINT AS places, sum(prize) AS prize, round(100.0::DOUBLE * sum(wins) / sum(runs), 2) AS win_rate FROM ancestry JOIN {totals} t USING (horse_id) GROUP BY ALL)".format(totals=TOTALS)
INBRED = "(SELECT horse_id, ancestor_id, count(*) AS n_paths, string_agg(path, ',' ORDER BY path) AS paths, list_sort(list(generation))[1] || 'x' || list_sort(list(generation))[2] AS \"cross\" FROM ancestry GROUP BY ALL HAVING count(*) > 1)"

closure_query("ancestry_paths", "SELECT * FROM ancestry")(lambda v: v.ancestry)
closure_query("inbred_horses", f"SELECT * FROM {INBRED}")(lambda v: G.inbreeding(v.ancestry))
closure_query("inbred_runners", "SELECT race_id, horse_id, ancestor_id FROM runs JOIN ancestry USING (horse_id) WHERE path IN ('sire', 'dam.sire') GROUP BY ALL HAVING count(DISTINCT path) = 2")(
    lambda v: G.inbred(G.runner_lineage(v.runs, v.ancestry.where(P("path").isin("sire", "dam.sire"))).withColumn("relation", F.when(P("path") == "sire", "sire").otherwise("damsire")))
)
closure_query("inbred_runners_lineage", f"SELECT DISTINCT race_id, horse_id, ancestor_id, n_paths, paths FROM runs JOIN {INBRED} USING (horse_id)")(
    lambda v: v.runs.select("race_id", "horse_id").join(G.inbreeding(v.ancestry).drop("cross"), "horse_id")
)
closure_query("lineage_by_path", "SELECT generation, path, count(*) AS runners, count(DISTINCT ancestor_id) AS ancestors, count(DISTINCT horse_id) AS horses FROM runs JOIN ancestry USING (horse_id) GROUP BY ALL")(
    lambda v: G.horse_totals(v.runs).join(v.ancestry, "horse_id").groupBy("generation", "path").agg(F.sum("runs").alias("runners"), F.countDistinct("ancestor_id").alias("ancestors"), F.countDistinct("horse_id").alias("horses"))
)
closure_query("grandparent_lineage", "SELECT race_id, horse_id, ancestor_id, generation, path, concat_ws('_', race_id, horse_id, path) AS lineage_id FROM runs JOIN ancestry USING (horse_id) WHERE generation <= 2")(
    lambda v: G.runner_lineage(v.runs, v.ancestry.where("generation <= 2"))
)
closure_query("progeny_by_path", f"SELECT * FROM {PATHS}")(lambda v: G.progeny_by_path(v.ancestry, G.horse_totals(v.runs)))
closure_query("progeny_runs_of_sires_and_dams", "SELECT ancestor_id, path, race_id, horse_id, race_date, position FROM runs JOIN ancestry USING (horse_id) WHERE path IN ('sire', 'dam')")(
    lambda v: G.progeny_runs(v.runs, v.ancestry, ["sire", "dam"])
)
closure_query("grand_progeny_runs", "SELECT ancestor_id, path, race_id, horse_id, race_date, position FROM runs JOIN ancestry USING (horse_id) WHERE path IN ('sire.sire', 'sire.dam', 'dam.sire', 'dam.dam')")(
    lambda v: G.progeny_runs(v.runs, v.ancestry, ["sire.sire", "sire.dam", "dam.sire", "dam.dam"])
)
closure_query("descendants_by_generation", "SELECT ancestor_id, generation, count(DISTINCT horse_id) AS descendants, count(*) AS lines FROM ancestry WHERE path LIKE '%sire%' GROUP BY ALL")(
    lambda v: G.descendants_by_generation(v.ancestry)
)
for relation in ("sire", "dam"):
    closure_query(
        f"proven_{relation}s",
        f"SELECT ancestor_id, own_runs, own_wins, progeny, wins, round(wins::DOUBLE / own_wins, 2) AS multiplier FROM {PATHS} JOIN (SELECT horse_id AS ancestor_id, count(*) AS own_runs, count(*) FILTER (WHERE position = 1) AS own_wins FROM runs GROUP BY 1) USING (ancestor_id) WHERE path = '{relation}' AND wins > 0 AND own_wins > 0",
    )(lambda v, r=relation: G.proven_producers(v.ancestry, G.own_career(v.runs), G.horse_totals(v.runs), r))
closure_query(
    "multipliers_by_path",
    f"SELECT ancestor_id, path, progeny_wins, own_wins, round(progeny_wins::DOUBLE / own_wins, 2) AS multiplier FROM (SELECT ancestor_id, path, wins AS progeny_wins FROM {PATHS} WHERE wins > 0) JOIN (SELECT horse_id AS ancestor_id, count(*) FILTER (WHERE position = 1) AS own_wins FROM runs GROUP BY 1) USING (ancestor_id) WHERE own_wins > 0",
)(lambda v: G.multipliers_by_path(v.ancestry, G.own_career(v.runs), G.horse_totals(v.runs)))
