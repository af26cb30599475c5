"""Very long texts, and columns of the input whose names the operators use themselves."""

import pytest
from pyspark.sql import functions as F

from paddock.llm import decontam, exact_dedup, language_model, line_dedup, near_dedup, quality, toxicity

LONG = " ".join(f"w{i % 5_003}" for i in range(200_000))
ITEM = "eleven words of an item that nobody else would ever write"
ODD = "doc_id long, text string, _id string, _k string, _t string, row string, label string, b int, c int, n int, words string"


def odd(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "r", "l", 1, 2, 3, "w") for i, t in rows], ODD)


@pytest.fixture(scope="module")
def docs(spark):
    return odd(spark, [(1, LONG), (2, LONG + " tail"), (3, f"{LONG} {ITEM} {LONG}"), (4, "short"), (None, None), (5, "\n".join(["same line"] * 50_000)), (6, "a" * 2_000_000)]).repartition(2)


def test_near_copies(docs):
    got = {r["_id"]: (r["component_id"], r["kept"]) for r in near_dedup.near_dedup(docs, k=2).collect() if r["_id"]}
    assert got == {1: (1, True), 2: (1, False), 3: (1, False), 4: (4, True), 5: (5, True), 6: (6, True)}


def test_equal_texts(docs):
    out = exact_dedup.exact_dedup(docs.unionByName(docs.where("doc_id = 6").withColumn("doc_id", F.lit(7).cast("long")))).collect()
    assert {r["doc_id"]: r["keep_id"] for r in out}[6] == 7 and len(out) == 8


def test_lines(docs):
    bitmaps = line_dedup.line_bitmaps(docs, keep="first", min_docs=1)
    kept = {r["row"]["doc_id"]: r["kept_text"] for r in line_dedup.apply_bitmaps(docs, bitmaps).collect()}
    assert kept[5] == "same line" and kept[6] in ("a" * 2_000_000, None) and len(kept) == 7


def test_benchmark_passages(spark, docs):
    items = spark.createDataFrame([("i", ITEM, "q")], "item_id string, text string, _k string")
    got = {r["_id"]: r["n_hit"] for r in decontam.decontaminate(docs, items).collect()}
    assert got == {1: 0, 2: 0, 3: 11, 4: 0, None: 0, 5: 0, 6: 0}


def test_language_model(docs):
    got = {r["doc_id"]: r for r in language_model.language_model(docs).collect()}
    assert got[1]["n_tokens"] == 200_001 and got[6]["n_tokens"] == 2 and got[None]["n_tokens"] == 1 and all(r["score"] < 0 for r in got.values())


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers(spark, docs, module, label):
    labels = spark.createDataFrame([(i, i % 2, "t", 1) for i in (1, 2, 3, 4, 5, 6)], f"doc_id long, {label} int, text string, label int")
    if module is quality:
        out = quality.score(docs, quality.train(docs, labels))
    else:
        out = toxicity.toxicity(docs, labels)
    assert out.count() == 7
