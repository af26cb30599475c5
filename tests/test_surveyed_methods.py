"""R6, J6 and A31 of the survey, as the reference has them, on rows that tell them from their look-alikes."""

import datetime

from paddock.operators import pedigree as G
from paddock.plans.queries import QUERIES

DAY = datetime.date(2024, 1, 2)
RUNS = [  # race, horse, position; horse 7 is the damsire of 1 and 2, and the sire of 2
    (1, 7, 1), (2, 7, 1), (3, 7, 2), (4, 1, 1), (5, 1, 1), (6, 1, 1), (7, 2, 2), (8, 2, 1), (9, 2, None), (10, 3, 1),
]
PARENTS = {7: ("a", "b", "c"), 1: ("d", "e", "7"), 2: ("7", "f", "7"), 3: ("g", None, None)}


def tables(spark):
    rows = [(r, h, p, 1.0, DAY, 1, *PARENTS[h]) for r, h, p in RUNS]
    runs = spark.createDataFrame(rows, "race_id long, horse_id long, position int, prize_won double, race_date date, race_class int, sire_id string, dam_id string, damsire_id string")
    return runs, G.lineage(runs)


def test_breeding_multiplier_is_progeny_wins_over_own_wins(spark):
    runs, edges = tables(spark)
    got = G.breeding_multiplier(edges.where("relation = 'damsire'"), G.own_career(runs)).select("ancestor_id", "progeny_wins", "own_wins", "multiplier").collect()
    assert [tuple(r) for r in got] == [("7", 4, 2, 2.0)]


def test_inbred_runners_have_one_ancestor_on_both_sides(spark):
    got = G.inbred(tables(spark)[1]).select("race_id", "horse_id", "ancestor_id").collect()
    assert sorted(map(tuple, got)) == [(7, 2, "7"), (8, 2, "7"), (9, 2, "7")]


def test_four_way_combinations_are_of_four_entities(spark):
    got = QUERIES["combinations_four_entities"](spark, "/root/testdata/sf0.001").collect()
    assert got and all(r["combination"] == "|".join(str(r[c]) for c in ("jockey_id", "trainer_id", "owner_id", "horse_id")) and r["runs"] >= 2 for r in got)
