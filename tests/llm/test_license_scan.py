"""License blocks against every block and template by brute force."""

import random
import re
from fractions import Fraction

import pytest

from paddock.llm import license_scan as L

TEMPLATES = (("t1", "one", "alpha beta gamma delta epsilon zeta eta theta iota kappa"), ("t2", "two", "alpha beta gamma"), ("t3", "three", "gamma delta"), ("t4", "four", "rare words rare order"), ("t5", "five", "!!"))


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def blocks_by_brute_force(text, templates, threshold):
    words, found = words_of(text), []
    for name, label, wording in templates:
        t = words_of(wording)
        for at in range(0, len(words), len(t)) if t else ():
            block = set(words[at : at + 2 * len(t)])
            part = Fraction(len(block & set(t)), len(set(t)))
            if part >= Fraction(str(threshold)):
                more = any(set(t) < set(words_of(u)) <= block | set(t) for _, _, u in templates)
                found.append((name, label, at, len(words[at : at + 2 * len(t)]), float(part), more))
    return found


def scan_by_brute_force(text, templates, threshold, phrases):
    words = words_of(text)
    places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    blocks = [b for b in blocks_by_brute_force(text, templates, threshold) if not b[5]]
    base = {label for _, label in places}
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | {b[1] for b in blocks})), 1.0 if places else max((b[4] for b in blocks), default=0.0))


def texts():
    rng = random.Random(9)
    known = sorted({w for _, _, t in TEMPLATES for w in words_of(t)})
    out = [None, "", "?", "MIT license", "the mit License, mit-license; Apache\nlicense", "general public license general public license", "general public", "license", "É mit licenseé"]
    for _ in range(250):
        out.append(" ".join(rng.choice(known if rng.random() < 0.8 else ["filler", "mit", "license", "Ünïcode", "x9"]) for _ in range(rng.randrange(60))))
    return out + ["Alpha, beta gamma " * 30] * 3


@pytest.mark.parametrize("threshold", [1.0, 0.9, 0.7, 0.34])
def test_all_blocks_and_rows_against_brute_force(spark, threshold):
    rows = [(i if i % 9 else None, t, i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    got = L.license_blocks(docs, templates=TEMPLATES, threshold=threshold).collect()
    found = sorted((str(r["_id"]), r["template"], r["label"], r["first_word"], r["n_words"], r["containment"], r["finer"]) for r in got)
    want = sorted((str(i), *b) for i, t, _ in rows for b in blocks_by_brute_force(t, TEMPLATES, threshold))
    assert found == want and len(want) > 20
    phrases = {"mit license": "mit", "general public license": "gpl", "license": "any"}
    scanned = sorted((tuple(r) for r in L.license_scan(docs, templates=TEMPLATES, threshold=threshold, phrases=phrases).collect()), key=str)
    assert scanned == sorted(((i, *scan_by_brute_force(t, TEMPLATES, threshold, phrases)) for i, t, _ in rows), key=str)


def test_production_templates_and_very_long_texts(spark, tmp_path):
    grant = next(t for n, _, t in L.TEMPLATES if n == "mit-grant").replace(", free of charge,", "")
    long = "prose without end " * 60_000
    rows = [(1, f"{long} Licensed under CC BY-NC 4.0. {long}"), (2, "Licensed under CC BY 4.0."), (3, f"# {grant}\n# {grant}"), (4, "mit license " * 20_000), (5, long), (6, "license " * 100_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r) for r in L.op12_license_scan(spark, str(tmp_path)).collect()}
    for i, text in rows:
        assert got[i] == (i, *scan_by_brute_force(text, L.TEMPLATES, L.THRESHOLD, L.PHRASES)), i
    assert [got[i][6] for i in range(1, 7)] == ["cc-by-nc", "cc-by", "mit", "mit", "", ""] and got[3][7] >= 0.9


def test_no_rows_and_no_templates(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert L.license_scan(docs).count() == 0 and L.license_blocks(docs).count() == 0
    one = spark.createDataFrame([("a", "The MIT license")], docs.schema)
    assert [tuple(r) for r in L.license_scan(one, templates=()).collect()] == [("a", 3, 1, 1, 1, "mit", "mit", 1.0)]
    assert [tuple(r) for r in L.license_scan(one, phrases={}).collect()][0][1:3] == (3, 0)
    with pytest.raises(ValueError, match="characters"):
        L.license_blocks(one, templates=[("x", "x", "w " * L.MAX_TEMPLATE_CHARS)])
