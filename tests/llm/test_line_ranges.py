"""Line dedup in ranges and for hot keys gives the same, with documents counted by id."""

from collections import Counter

import pytest

from paddock.llm import line_dedup

ROWS = [(i, f"own {i}\nshared\nSHARED \n" + ("pair\n" if i % 2 else "") + f"tail {i % 3}") for i in range(14)]
ROWS += [(3, ROWS[3][1]), (5, "other text of five\nshared"), (None, "shared\nnull"), (None, "shared"), (20, None), (21, "\n".join(f"line {i % 7}" for i in range(5_000)))]


def expected(keep):
    docs = {}
    for i, t in ROWS:
        for line in (t or "").split("\n"):
            docs.setdefault(line.strip().lower(), set()).add(i)
    repeated = {k for k, ids in docs.items() if k and len(ids) >= 4}
    out, first = Counter(), set()
    for i, t in sorted(set(ROWS), key=lambda r: (r[0] is not None, r[0] or 0)):
        kept = []
        for line in (t or "").split("\n"):
            key = line.strip().lower()
            if key not in repeated or (keep == "first" and key not in first):
                kept.append(line)
            if key in repeated:
                first.add(key)
        out[i, t, "\n".join(kept)] = ROWS.count((i, t))
    return out


@pytest.mark.parametrize("hot", [1, 5, 12, 10_000])
def test_both_paths_drop_the_same_lines(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=4)).collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"], r["kept_text"]) for r in out) == expected("none")


@pytest.mark.parametrize("hot", [1, 10_000])
def test_the_first_occurrence_stays(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT_LINES", hot)
    rows = [r for r in ROWS if r[0] is not None and r[1] != "other text of five\nshared"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["row"]["doc_id"]: r["kept_text"].split("\n") for r in line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, min_docs=4, keep="first")).collect()}
    assert out[0] == ["own 0", "shared", "tail 0"] and out[1] == ["own 1", "pair", "tail 1"] and out[3] == ["own 3"] and out[2] == ["own 2", "tail 2"]


def test_rows_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame([(i // 2, f"same\nrow {i}") for i in range(6)], "doc_id long, text string")
    assert line_dedup.line_bitmaps(docs, min_docs=4).count() == 0
    assert line_dedup.line_bitmaps(docs, min_docs=3).count() == 6
