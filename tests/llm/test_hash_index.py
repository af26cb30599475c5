"""The extendible-hash index: buckets that split, keys that collide, hot keys, files that answer."""

import hashlib
from collections import Counter

import pytest

from paddock.llm import exact_dedup
from pyspark.sql import functions as F


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = Counter()
    for i, t in rows:
        keep = max((x for x in groups[t or ""] if x is not None), default=None)
        out[i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return out


ROWS = [(i, f"text {i % 70}") for i in range(200)] + [(i, "hot") for i in range(200, 500)] + [(500, None), (501, ""), (None, "hot"), (None, "alone"), (7, "text 7"), (502, "x" * 300_000), (503, "x" * 300_000)]


@pytest.mark.parametrize("bits", [64, 3, 1])
@pytest.mark.parametrize("hot", [1_000_000, 50, 1])
def test_colliding_keys_are_chained_and_hot_ones_summed_up(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", hot)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    got = exact_dedup.exact_dedup(docs, bucket_rows=20, max_depth=5, hash_bits=bits)
    assert Counter(map(tuple, got.collect())) == expected(ROWS)


def test_the_index_holds_each_text_once_in_buckets_that_fit(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    index, directory, depth = exact_dedup.build_index(docs, bucket_rows=20, max_depth=8)
    rows = index.collect()
    assert len(rows) == len({t or "" for _, t in ROWS}) and depth > 1
    assert directory.count() == 1 << depth and len({r["bucket"] for r in rows}) > 4
    assert all(r["bucket"] >> (8 - r["local_depth"]) == (r["_h"] % 2**64) >> (64 - r["local_depth"]) if r["local_depth"] else True for r in rows)
    assert {r["chain"] for r in rows} == {1}
    collided, _, _ = exact_dedup.build_index(docs, bucket_rows=20, max_depth=8, hash_bits=1)
    assert collided.groupBy("_h").agg(F.count_distinct("chain") == F.count(F.lit(1))).where(~F.col("(count(DISTINCT chain) = count(1))")).count() == 0
    assert collided.agg(F.max("chain")).first()[0] > 20


def test_a_large_directory_is_built_at_once():
    histogram = {x: 3 for x in range(1 << 17)}
    depth, slots = exact_dedup.build_directory(histogram, 18, 6)
    assert depth == 17 and len(slots) == 1 << 17


def test_registered_size_splits_a_table_of_the_check(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    _, depth, _ = exact_dedup.split_directory(exact_dedup.keyed(docs, "doc_id", "text"), exact_dedup.BUCKET_ROWS, exact_dedup.MAX_DEPTH)
    assert depth >= 3
