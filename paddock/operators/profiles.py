"""One wide row for each ancestor: progeny, best classes and distances, indices, own career, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsers import AW_SURFACES, JUMP_SURFACES, rate, surface_is
from ..sources.shared import staged
from .pedigree import CLASS_RATES, class_rate, distance_rate, with_progeny_rates
from .windows import top_by

P = F.col
#: Weights of the profile's completeness.
SCORE_WEIGHTS = {"runs": 0.20, "top_class_1": 0.10, "top_class_2": 0.10, "top_class_3": 0.10, "top_distance_1": 0.10, "top_distance_2": 0.10, "top_distance_3": 0.10, "class_index": 0.10, "top_class_index": 0.05, "top_distance_index": 0.05}


#: What is summed up in a cell.
SUMS = ("progeny", "runs", "wins", "seconds", "thirds", "places", "position_sum", "position_n", "prize")
CELL = ("race_class", "distance_f", "surface")


def horse_careers(runs: DataFrame) -> DataFrame:
    """One row a horse: own career (own_*, best_position, first_run, last_run, last_win) and ``cells``, its outcomes by
    class, distance and surface. The runs are dealt out by horse once."""
    p = P("position")
    cells = runs.repartition("horse_id").groupBy("horse_id", *CELL).agg(
        F.lit(0).cast("long").alias("progeny"), F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"), F.count_if(p == 2).alias("seconds"), F.count_if(p == 3).alias("thirds"), F.count_if(p <= 3).alias("places"),
        F.coalesce(F.sum("position"), F.lit(0)).alias("position_sum"), F.count("position").alias("position_n"), F.sum(F.coalesce("prize_won", F.lit(0.0))).alias("prize"),
        F.min("position").alias("best"), F.min("race_date").alias("first"), F.max("race_date").alias("last"), F.max(F.when(p == 1, P("race_date"))).alias("won"),
    )
    return cells.groupBy("horse_id").agg(
        *[F.sum(c).alias(f"own_{c}") for c in ("runs", "wins", "places", "prize")], F.min("best").alias("best_position"), F.round(F.try_divide(F.sum("position_sum").cast("double"), F.sum("position_n")), 2).alias("own_avg_position"),
        F.min("first").alias("first_run"), F.max("last").alias("last_run"), F.max("won").alias("last_win"), F.collect_list(F.struct(*CELL, *SUMS)).alias("cells"),
    )


def ancestor_cube(careers: DataFrame, horses: DataFrame, key: str) -> DataFrame:
    """ancestor_id, class, distance, surface and what its progeny did there: one aggregation from which all
    columns of a profile are rolled up. A cell without class, distance and surface counts the progeny that
    ran, so that it needs no distinct count; a horse has one row in ``careers`` and ``horses``."""
    one = F.struct(*[F.lit(None).cast(careers.schema["cells"].dataType.elementType[c].dataType).alias(c) for c in CELL], F.lit(1).cast("long").alias("progeny"), *[F.lit(0).cast(careers.schema["cells"].dataType.elementType[c].dataType).alias(c) for c in SUMS[1:]])
    rows = horses.where(P(key).isNotNull()).select("horse_id", P(key).cast("string").alias("ancestor_id")).join(careers.select("horse_id", F.array_append("cells", one).alias("cells")), "horse_id")
    return rows.select("ancestor_id", F.inline("cells")).groupBy("ancestor_id", *CELL).agg(*[F.sum(c).alias(c) for c in SUMS])


def _of(condition: Column, column: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, P(column))), F.lit(0))


def split_counts() -> list[Column]:
    """Runs and wins on turf and on artificial surfaces, on the flat and over jumps, out of cells."""
    jump = F.coalesce(surface_is(P("surface"), JUMP_SURFACES), F.lit(False))
    kinds = {"turf": surface_is(P("surface"), ("turf",)), "aw": surface_is(P("surface"), AW_SURFACES), "flat": ~jump, "jump": jump}
    return [x for k, c in kinds.items() for x in (_of(c, "runs").alias(f"{k}_runs"), _of(c, "wins").alias(f"{k}_wins"))]


def top_columns(cube: DataFrame, category: str, name: str, expected, k: int = 3) -> DataFrame:
    """The ``k`` categories with most wins of each ancestor as columns: name_1, name_1_runs, name_1_wins,
    name_1_win_rate ..., and the first one's wins over expected wins."""
    counts = cube.groupBy("ancestor_id", category).agg(F.sum("runs").alias("runs"), F.sum("wins").alias("wins")).where(P("runs") > 0)
    top = top_by(counts, ["ancestor_id"], [F.desc("wins"), P(category)], k, rank="rank").withColumn("win_rate", rate(P("wins"), P("runs")))
    cells = [F.max(F.when(P("rank") == i, P(c))).alias(a) for i in range(1, k + 1) for c, a in ((category, f"{name}_{i}"), ("runs", f"{name}_{i}_runs"), ("wins", f"{name}_{i}_wins"), ("win_rate", f"{name}_{i}_win_rate"))]
    index = F.round(P(f"{name}_1_wins") * 100.0 / (P(f"{name}_1_runs") * expected(P(f"{name}_1"))), 3)
    return top.groupBy("ancestor_id").agg(*cells).withColumn(f"{name}_index", index)


def ancestor_profiles(careers: DataFrame, horses: DataFrame, key: str) -> DataFrame:
    """One row for each ancestor in column ``key`` of ``horses`` with progeny that ran; own_* columns are null unless its
    id is a horse's.

    ``careers`` is what ``horse_careers`` gives; it is written to the shared folder, and so is the cube, so that the runs are
    read once. All roll-ups deal the cube out by ancestor."""
    careers = staged(careers, "horse-careers")
    cube = staged(ancestor_cube(careers, horses, key), "ancestor-cube").repartition("ancestor_id")
    by_class = [_of(P("race_class") == c, "wins").alias(f"class_{c}_wins") for c in CLASS_RATES]
    expected = lambda r: F.round(F.try_divide(F.sum("wins") * 100.0, F.sum(P("runs") * r)), 3)
    out = cube.groupBy("ancestor_id").agg(
        *[F.sum(c).alias(c) for c in ("progeny", "runs", "wins", "seconds", "thirds", "places", "prize")], F.round(F.try_divide(F.sum("position_sum").cast("double"), F.sum("position_n")), 2).alias("avg_position"),
        *split_counts(), *by_class, expected(class_rate(P("race_class"))).alias("class_index"), expected(distance_rate(P("distance_f"))).alias("distance_index"),
    )
    out = out.join(top_columns(cube, "race_class", "top_class", class_rate), "ancestor_id", "left").join(top_columns(cube, "distance_f", "top_distance", distance_rate), "ancestor_id", "left")
    score = F.lit(0.0)
    for c, weight in SCORE_WEIGHTS.items():
        good = P(c) > 0 if c in ("runs", "class_index", "top_class_index", "top_distance_index") else P(c).isNotNull()
        score = score + F.when(good, weight).otherwise(0.0)
    own = careers.drop("cells").withColumn("ancestor_id", P("horse_id").cast("string")).drop("horse_id")
    return with_progeny_rates(out).withColumn("score", F.round(score, 2)).join(own, "ancestor_id", "left")


def career_and_progeny(careers: DataFrame, horses: DataFrame, runs_of_progeny: DataFrame, key: str) -> DataFrame:
    """Every horse with its own career beside the totals of all its progeny, whether that ran or not; zeros where
    it never ran or has none. ``runs_of_progeny`` is what ``all_progeny`` gives for ``key``."""
    own = careers.select("horse_id", "own_runs", "own_wins", "own_places", "own_avg_position")
    kin = runs_of_progeny.select(P(key).cast("string").alias("_a"), *[P(c).alias(f"progeny_{c}" if c != "progeny" else c) for c in ("progeny", "runners", "runs", "wins", "places", "avg_position")])
    out = horses.select("horse_id").join(own, "horse_id", "left").join(kin, P("horse_id").cast("string") == P("_a"), "left").drop("_a")
    return out.na.fill(0, ["own_runs", "own_wins", "own_places", "progeny", "progeny_runners", "progeny_runs", "progeny_wins", "progeny_places"])


def all_progeny(horses: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """Progeny of each ancestor whether they ran or not: horses, runners among them, runs, wins, places,
    rates and average position."""
    by_horse = runs.groupBy("horse_id").agg(F.count(F.lit(1)).alias("r"), F.count_if(P("position") == 1).alias("w"), F.count_if(P("position") <= 3).alias("pl"), F.sum("position").alias("s"), F.count("position").alias("f"))
    out = horses.where(P(key).isNotNull()).select(key, "horse_id").join(by_horse, "horse_id", "left").groupBy(key).agg(
        F.count(F.lit(1)).alias("progeny"), F.count("r").alias("runners"), F.coalesce(F.sum("r"), F.lit(0)).alias("runs"), F.coalesce(F.sum("w"), F.lit(0)).alias("wins"), F.coalesce(F.sum("pl"), F.lit(0)).alias("places"),
        F.round(F.try_divide(F.sum("s").cast("double"), F.sum("f")), 2).alias("avg_position"),
    )
    return out.withColumns({"win_rate": rate(P("wins"), P("runs")), "place_rate": rate(P("places"), P("runs"))})
