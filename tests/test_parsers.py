"""Unit vectors of the text parsers."""

import pytest
from pyspark.sql import functions as F

from paddock.functions import parsers as S

CASES = [
    (S.position, [("1", 1), ("10", 10), ("F", None), ("U", None), ("PU", None), ("BD", None), ("Died as a 5", 5), ("DIED AS 7", 7), ("died as an 11", 11), ("DIED", None), ("1st", 1), ("", None), (None, None), ("REF", None)]),
    (S.strict_position, [("3", 3), ("3rd", None), (" 4 ", 4), (None, None)]),
    (S.beaten_distance, [("0", "0"), (".5", "0.5L"), ("2.75", "2.75L"), ("48", "48L"), ("", None), ("nk", "nk")]),
    (S.money, [("7016.4", 7016.4), ("£12,950", 12950.0), ("", None), ("€88", 88.0), ("x", None)]),
    (S.text, [("7/2", "7/2"), ("11/10J", "11/10J"), ("", None), (" a ", "a")]),
    (S.rating, [("92", 92), ("–", None), ("", None), ("-", None), ("N/A", None)]),
    (S.integer, [("5", 5), ("abc", None), ("-7", -7)]),
    (S.decimal, [("6.20", 6.2), ("3L", 3.0), ("27L", 27.0), ("-", None), ("abc", None), ("4D", None), ("NaN", None)]),
    (S.breeding_region, [("Quiet Harbour (UK)", "gb"), ("Blue Lantern (NZ) ", "nz"), ("Marsh Fiddler (XYZ)", "xyz"), ("Copper (GER) Kettle", None), ("Low (gb)", None), ("Nameless", None), (None, None)]),
    (S.yards, [("16f", 3520), ("2m", 3520), ("2m4f", 4400), ("1m2f110y", 2310), ("7.5f", 1650), (None, None)]),
    (S.metres, [("1m", 1609), ("6f", 1206), ("2m4f", 4022), ("7.5f", 1507), ("1200", 1200), ("m", None), ("f", None), ("soft", None), ("", None)]),
    (S.seconds, [("1:36.25", 96.25), ("3:10.5", 190.5), ("58.4", 58.4), ("x", None)]),
    (S.race_class, [("Class 3", 3), ("class7", 7), ("x", None)]),
    (S.furlongs, [("8f", 8.0), ("", None)]),
    (S.name_key, [("  Red   Rum ", "red rum")]),
    (S.course_key, [("Kempton-AW", "kempton"), ("Naas-Left", "naas"), ("Cork-RIGHT", "cork"), ("Ascot-gb", "ascot"), ("Tramore-Ire", "tramore"), ("Fairyhouse-lh", "fairyhouse"), ("Dundalk-rh-AW", "dundalk"), ("Newmarket-Rowley", "newmarket"), ("Newmarket July", "newmarket july"), ("York-July", "york-july"), ("Old Limerick Park", "limerick"), ("Stratford-upon-Avon", "stratford"), ("Ash-Green-on-Sea", "ash"), (" Perth ", "perth"), (None, None)]),
    (S.text_position, [("won", 1), (" WON ", 1), ("2nd", 2), ("F", None), (None, None)]),
    (S.did_not_finish, [("PU", True), ("1", False), ("", False)]),
]


@pytest.mark.parametrize("parser,cases", CASES, ids=[p.__name__ for p, _ in CASES])
def test_vectors(spark, parser, cases):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", parser(F.col("t")).alias("v")).collect()}
    for i, (t, want) in enumerate(cases):
        assert (got[i] if want is None or not isinstance(want, float) else pytest.approx(got[i])) == want, t


def test_rates_and_scores(spark):
    df = spark.createDataFrame([(1, 8), (0, 0)], "a int, b int")
    assert [tuple(r) for r in df.select(S.rate(F.col("a"), F.col("b")), S.rate(F.col("a"), F.col("b"), zero=0.0)).collect()] == [(12.5, 12.5), (None, 0.0)]
    form = spark.createDataFrame([(i, i) for i in range(1, 6)], "p int, r int").agg(F.round(F.sum(S.form_points(F.col("p")) * S.form_weight(F.col("r"))) / 67 * 100, 2)).first()[0]
    assert form == 60.45
    places = spark.createDataFrame([(6,), (19,), (None,)], "p int").select(S.form_points(F.col("p"))).collect()
    assert [r[0] for r in places] == [1, 1, 0]
