"""Ancestors of runners and their statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import rate
from ..sources.shared import staged

P = F.col
#: Expected win rates by class 1 to 7, the default, and by distance in furlongs.
CLASS_RATES = {1: 0.10, 2: 0.11, 3: 0.12, 4: 0.13, 5: 0.14, 6: 0.15, 7: 0.16}
DEFAULT_RATE = 0.125
DISTANCE_RATES = ((7, 0.12), (10, 0.13), (14, 0.12), (None, 0.11))


def lineage(runs: DataFrame, unique: bool = False) -> DataFrame:
    """One row for each runner and ancestor (sire and dam in generation 1, damsire in 2), unique by
    runner and path. ``unique`` says that no runner has two rows, which spares their comparison."""
    runs = runs if unique else runs.dropDuplicates(["race_id", "horse_id"])
    kinds = ((1, "sire", "sire_id", "sire"), (1, "dam", "dam_id", "dam"), (2, "damsire", "damsire_id", "dam.sire"))
    edges = F.array(*[F.struct(F.lit(g).alias("generation"), F.lit(r).alias("relation"), P(c).alias("ancestor_id"), F.lit(p).alias("path")) for g, r, c, p in kinds])
    more = [c for c in ("surface", "distance_f") if c in runs.columns]
    out = runs.select("race_id", "horse_id", "position", "prize_won", "race_date", "race_class", *more, F.explode(edges).alias("e")).select("*", "e.*").drop("e")
    key = F.concat_ws("_", "race_id", "horse_id", "generation", "relation")
    return out.where(P("ancestor_id").isNotNull()).withColumn("lineage_id", key)


def class_rate(c: Column) -> Column:
    out = F.lit(DEFAULT_RATE)
    for k, v in CLASS_RATES.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def distance_rate(f: Column) -> Column:
    out = F.lit(DISTANCE_RATES[-1][1])
    for limit, value in reversed(DISTANCE_RATES[:-1]):
        out = F.when(f <= limit, value).otherwise(out)
    return out


def progeny_stats(edges: DataFrame, key: str = "ancestor_id", extra: Sequence[Column] = ()) -> DataFrame:
    """Progeny that ran, their runs, wins, places, prize, wins by class, best class and averages."""
    p = P("position")
    by_class = [F.count_if((p == 1) & (P("race_class") == c)).alias(f"class_{c}_wins") for c in CLASS_RATES]
    out = edges.groupBy(key).agg(
        F.countDistinct("horse_id").alias("progeny"), F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"), F.count_if(p <= 3).alias("places"),
        F.sum(F.coalesce("prize_won", F.lit(0.0))).alias("prize"), *by_class, *extra,
    )
    return with_progeny_rates(out)


def with_progeny_rates(out: DataFrame) -> DataFrame:
    """Add best_class (most wins, the better of equal ones), rates and averages by horse."""
    classes = F.array(*[F.struct(P(f"class_{c}_wins").alias("w"), F.lit(-c).alias("c")) for c in CLASS_RATES])
    best = F.array_max(F.filter(classes, lambda x: x["w"] > 0))
    return out.withColumns({"best_class": -best["c"], "win_rate": rate(P("wins"), P("runs")), "place_rate": rate(P("places"), P("runs")), "runs_per_horse": F.round(F.try_divide(P("runs").cast("double"), P("progeny")), 2), "wins_per_horse": F.round(F.try_divide(P("wins").cast("double"), P("progeny")), 2)})


def own_career(runs: DataFrame, key: str = "horse_id") -> DataFrame:
    p = P("position")
    return runs.groupBy(key).agg(
        F.count(F.lit(1)).alias("own_runs"), F.count_if(p == 1).alias("own_wins"), F.count_if(p <= 3).alias("own_places"), F.sum(F.coalesce("prize_won", F.lit(0.0))).alias("own_prize"),
        F.min("position").alias("best_position"), F.round(F.avg("position"), 2).alias("avg_position"), F.min("race_date").alias("first_run"), F.max("race_date").alias("last_run"),
        F.max(F.when(p == 1, P("race_date"))).alias("last_win"),
    )


def breeding_multiplier(edges: DataFrame, careers: DataFrame, digits: int = 2) -> DataFrame:
    """Wins of an ancestor's progeny over the wins of its own career, where both have some. Both sides
    are one row a horse when they meet."""
    progeny = edges.groupBy("ancestor_id").agg(F.count_if(P("position") == 1).alias("progeny_wins")).where(P("progeny_wins") > 0)
    own = careers.where(P("own_wins") > 0).select(P("horse_id").cast("string").alias("ancestor_id"), "own_wins")
    return progeny.join(own, "ancestor_id").withColumn("multiplier", F.round(P("progeny_wins") / P("own_wins"), digits))


def inbred(edges: DataFrame) -> DataFrame:
    """Runners with the same ancestor as sire and as damsire."""
    rows = edges.where(P("relation").isin("sire", "damsire")).groupBy("race_id", "horse_id", "ancestor_id").agg(F.countDistinct("relation").alias("_n"))
    return rows.where("_n = 2").drop("_n")


#: Columns of a horse's parents, by the step that a path takes.
PARENTS = {"sire": "sire_id", "dam": "dam_id"}


def ancestry(horses: DataFrame, depth: int = 4, parents: dict[str, str] = PARENTS, id_col: str = "horse_id") -> DataFrame:
    """Every ancestor of every horse up to ``depth`` generations: horse_id, ancestor_id, generation, path
    (``sire``, ``dam.sire``, ``sire.sire.dam`` ...), one row for each horse and path.

    One generation after the other is joined with the parents and written to the shared folder; it ends
    early where none is left. Parents that are null end a path, and so does an ancestor that already stands
    on it, so circles in the data end too. Rows that repeat a horse count once; of contradicting ones the
    largest parent counts. Ids are compared as they are: parents must have the type of the horses."""
    steps = horses.where(P(id_col).isNotNull()).groupBy(P(id_col).alias("_child")).agg(*[F.max(c).alias(f"_{i}") for i, c in enumerate(parents.values())])
    cells = F.array(*[F.struct(F.lit(step).alias("step"), P(f"_{i}").alias("parent")) for i, step in enumerate(parents)])
    steps = staged(steps.select("_child", F.inline(cells)).where(P("parent").isNotNull() & (P("parent") != P("_child"))), "parents")
    level = staged(steps.select(P("_child").alias("horse_id"), P("parent").alias("ancestor_id"), F.lit(1).alias("generation"), P("step").alias("path"), F.array("_child", "parent").alias("_chain")), "generation-1")
    found = level
    for generation in range(2, depth + 1):
        onward = level.join(steps, P("ancestor_id") == P("_child")).where(~F.array_contains("_chain", P("parent")))
        level = staged(onward.select("horse_id", P("parent").alias("ancestor_id"), F.lit(generation).alias("generation"), F.concat_ws(".", "path", "step").alias("path"), F.array_append("_chain", P("parent")).alias("_chain")), f"generation-{generation}")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found.drop("_chain")


def runner_lineage(runs: DataFrame, closure: DataFrame) -> DataFrame:
    """Lineage of every runner: race_id, horse_id, ancestor_id, generation, path, lineage_id, unique by runner and path."""
    runners = runs.select("race_id", "horse_id").distinct()
    key = F.concat_ws("_", "race_id", "horse_id", "path")
    return runners.join(closure, "horse_id").withColumn("lineage_id", key)


def inbreeding(closure: DataFrame) -> DataFrame:
    """Horses with one ancestor on several paths: horse_id, ancestor_id, n_paths, paths (in order, joined by commas), and the
    two nearest generations of it as ``cross`` (3x4)."""
    each = closure.groupBy("horse_id", "ancestor_id").agg(F.sort_array(F.collect_set(F.struct("generation", "path"))).alias("_at")).where(F.size("_at") > 1)
    near = F.concat(P("_at")[0]["generation"].cast("string"), F.lit("x"), P("_at")[1]["generation"].cast("string"))
    return each.select("horse_id", "ancestor_id", F.size("_at").cast("long").alias("n_paths"), F.array_join(F.sort_array(P("_at.path")), ",").alias("paths"), near.alias("cross"))


def horse_totals(runs: DataFrame) -> DataFrame:
    """Runs, wins, places and prize of each horse: what ancestors are credited with, one row a horse."""
    p = P("position")
    return runs.groupBy("horse_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"), F.count_if(p <= 3).alias("places"), F.sum(F.coalesce("prize_won", F.lit(0.0))).alias("prize"))


def progeny_by_path(closure: DataFrame, totals: DataFrame, paths: Sequence[str] | None = None) -> DataFrame:
    """ancestor_id, path, progeny that ran, their runs, wins, places, prize and win rate; of some paths or of all.
    Runs are summed up by horse before they meet the ancestors."""
    rows = closure if paths is None else closure.where(P("path").isin(*paths))
    out = rows.join(totals, "horse_id").groupBy("ancestor_id", "path").agg(F.count(F.lit(1)).alias("progeny"), *[F.sum(c).alias(c) for c in ("runs", "wins", "places", "prize")])
    return out.withColumn("win_rate", rate(P("wins"), P("runs")))


def progeny_runs(runs: DataFrame, closure: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Run list of the progeny (or grand-progeny) of every ancestor by the paths asked for."""
    wanted = closure.where(P("path").isin(*paths)).select("horse_id", "ancestor_id", "path")
    return runs.join(wanted, "horse_id").select("ancestor_id", "path", "race_id", "horse_id", "race_date", "position")


def descendants_by_generation(closure: DataFrame, like: str = "%sire%") -> DataFrame:
    """ancestor_id, generation, descendants, and how many paths lead to them, over paths that are like ``like``."""
    rows = closure.where(P("path").like(like))
    return rows.groupBy("ancestor_id", "generation").agg(F.countDistinct("horse_id").alias("descendants"), F.count(F.lit(1)).alias("lines"))


def multipliers_by_path(closure: DataFrame, careers: DataFrame, totals: DataFrame, digits: int = 2) -> DataFrame:
    """ancestor_id, path, progeny_wins, own_wins, multiplier of ancestors that won themselves and whose descendants on that path
    did."""
    own = careers.where(P("own_wins") > 0).select(P("horse_id").alias("ancestor_id"), "own_wins")
    progeny = progeny_by_path(closure, totals).where(P("wins") > 0).select("ancestor_id", "path", P("wins").alias("progeny_wins"))
    return progeny.join(own, "ancestor_id").withColumn("multiplier", F.round(P("progeny_wins") / P("own_wins"), digits))


def proven_producers(closure: DataFrame, careers: DataFrame, totals: DataFrame, path: str = "dam") -> DataFrame:
    """Ancestors on ``path`` that won themselves and whose progeny did: ancestor_id, own_runs, own_wins, progeny, wins,
    multiplier (progeny wins over own wins), most first."""
    own = careers.where(P("own_wins") > 0).select(P("horse_id").alias("ancestor_id"), "own_runs", "own_wins")
    out = progeny_by_path(closure, totals, [path]).where(P("wins") > 0).join(own, "ancestor_id")
    return out.select("ancestor_id", "own_runs", "own_wins", "progeny", "wins", F.round(P("wins") / P("own_wins"), 2).alias("multiplier"))


def descendants(edges: DataFrame, ancestors: DataFrame | None = None) -> DataFrame:
    """ancestor_id, horse_id, relation of horses by sire or damsire; of some ancestors or of all."""
    rows = edges.where(P("relation").isin("sire", "damsire"))
    rows = rows if ancestors is None else rows.join(ancestors, "ancestor_id", "left_semi")
    return rows.select("ancestor_id", "horse_id", "relation").distinct()


def expected_index(rows: DataFrame, key: str, expected: Column, digits: int = 3) -> DataFrame:
    """100 x wins over expected wins."""
    value = F.round(F.try_divide(F.count_if(P("position") == 1) * 100.0, F.sum(expected)), digits)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("runs"), value.alias("ae_index"))


def completeness_score(weights: dict[str, float]) -> Column:
    """Sum of the weights of the columns that are filled."""
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.when(P(c).isNotNull(), w).otherwise(0.0)
    return F.round(out, 2)
