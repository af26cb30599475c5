"""Stages of the pipeline on a small fixture, against plain Python, and held-out rejection."""

import random

import corpus_pipeline as P
from paddock.llm import quality
from paddock.llm.common import stage, table
from pyspark.sql import functions as F


def test_stages_two_to_five_against_brute_force(spark, tmp_path):
    r = random.Random(6)
    prose = lambda n: [f"{r.choice('abcdefgh')}{r.randrange(5000)}" for _ in range(n)]
    bench = prose(30)
    texts = {i: " ".join(prose(60)) + ("\nShared footer" if i < 12 else "\ntwice" if i < 14 else "") for i in range(20)}
    base = prose(200)
    for i in range(20, 24):
        w = list(base)
        w[i] = "changed"
        texts[i] = " ".join(w)
    texts[24] = " ".join(prose(20) + bench[5:15] + prose(20))
    texts[25] = " ".join(prose(20) + bench[5:14] + prose(20))
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")
    spark.createDataFrame([(1, " ".join(bench))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = str(tmp_path)

    lines = stage(P.line_stage(spark, docs, at), "test")
    want = {i: "\n".join(x for x in t.split("\n") if i == 0 or x != "Shared footer") for i, t in texts.items()}
    assert dict(map(tuple, lines.collect())) == want

    def shingles(t):
        w = t.split()
        return {tuple(w[j : j + 5]) for j in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in want.items()}
    alike = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert alike == {(a, b) for a in range(20, 24) for b in range(a + 1, 24)}
    near = stage(P.near_stage(spark, lines, at), "test")
    kept = {x[0] for x in near.collect()}
    assert kept - {20, 21, 22, 23} == set(texts) - {20, 21, 22, 23} and len(kept & {20, 21, 22, 23}) == 1

    tens = {tuple(bench[j : j + 10]) for j in range(21)}
    bad = {i for i in kept if any(tuple(w[j : j + 10]) in tens for w in [want[i].split()] for j in range(len(w) - 9))}
    clean = stage(P.decontamination_stage(spark, near, at), "test")
    assert bad == {24} and {x[0] for x in clean.collect()} == kept - bad

    codec = P.bpe.Codec(*P.bpe.default_vocabulary())
    got = {x["doc_id"]: x["n_tokens"] for x in P.bpe_stage(spark, clean, at).collect()}
    assert got == {i: len(codec.encode([want[i]])[0]) for i in kept - bad}


def test_held_out_bad_documents_are_rejected_and_good_ones_stay(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 1
    model = quality.train(docs, labels.where(~held))
    some = docs.join(labels.where(held).select("doc_id"), "doc_id", "left_semi")
    out = quality.score(some, model).select(F.col("row.doc_id").alias("doc_id"), (F.col("tail") < quality.MIN_TAIL).alias("gone")).join(labels, "doc_id")
    n = {r[0]: (r[1], r[2]) for r in out.groupBy("quality").agg(F.count(F.lit(1)), F.count_if("gone")).collect()}
    assert n[0][1] >= 0.9 * n[0][0] > 0 and n[1][1] <= 0.01 * n[1][0]
