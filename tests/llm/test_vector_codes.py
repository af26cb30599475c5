"""Vector codes against Lloyd's rounds by brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import vector_codes as V


def by_brute_force(vectors, parts=4, entries=256, rounds=4):
    width = -(-max(map(len, vectors)) // parts)
    x = [[math.floor(1024 * v) for v in row] + [0] * (parts * width - len(row)) for row in vectors]
    x = np.array(x, object).reshape(len(x), parts, width)
    books = [[list(row[p]) for row in x[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            taken = [nearest(row[p], books[p])[1] for row in x]
            for j in set(taken):
                mine = [row[p] for row, t in zip(x, taken, strict=True) if t == j]
                books[p][j] = [sum(v[k] for v in mine) // len(mine) for k in range(width)]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in x]
    return [bytes(j for _, j in f) for f in found], [sum(d for d, _ in f) for f in found], books


def compare(spark, rows, entries=256, parts=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, row string, code int").repartition(3)
    coded, books = V.vector_codes(df, entries=entries, parts=parts)
    kept = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    codes, errors, want = by_brute_force([r[1] for r in kept], parts, entries)
    label = {}
    for r, e in zip(kept, errors, strict=True):
        label[r[2]] = label.get(r[2], 0) + e
    got = sorted(map(tuple, coded.collect()), key=str)
    assert got == sorted(((r[0], bytearray(c), e, label[r[2]]) for r, c, e in zip(kept, codes, errors, strict=True)), key=str)
    assert books.tolist() == want


def test_clusters_copies_ties_and_rows_that_go(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.1) + i % 5 for _ in range(12)], i % 3 or None, "x", 1) for i in range(300)]
    rows += [(i, [0.25] * 12, 7, "x", 1) for i in range(300, 700)]  # a very common vector
    rows += [(i, [float(i % 2)] * 12, 8, "x", 1) for i in range(700, 720)]  # ties
    rows += [rows[5], rows[5], (None, [0.5] * 12, 1, "x", 1)]
    rows += [(-1, None, 1, "x", 1), (-2, [1.0, None] * 6, 1, "x", 1), (-3, [float("nan")] * 12, 1, "x", 1), (-4, [float("inf")] + [0.0] * 11, 1, "x", 1), (-5, [float("-inf")] * 12, 1, "x", 1)]
    compare(spark, rows, entries=40)
    compare(spark, rows)


@pytest.mark.parametrize("lengths", [[0], [3], [1, 7, 0], [4, 5]])
def test_lengths_that_differ(spark, lengths):
    rng = random.Random(4)
    compare(spark, [(i, [rng.uniform(-2, 2) for _ in range(lengths[i % len(lengths)])], i % 2, "x", 1) for i in range(60)], entries=9)


def test_large_components_are_exact_and_bounded(spark):
    rng = random.Random(5)
    compare(spark, [(i, [rng.uniform(-60_000, 60_000) for _ in range(8)], 1, "x", 1) for i in range(80)], entries=11)
    coded, _ = V.vector_codes(spark.createDataFrame([(i, [1e300 * (-1) ** i] * 8, None) for i in range(9)], "vec_id long, embedding array<double>, label int"), entries=3)
    assert coded.where("error is not null").count() == 9


def test_no_rows_and_text_ids(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert V.vector_codes(empty)[0].count() == 0
    assert V.vector_codes(spark.createDataFrame([(1, None, 1)], empty.schema))[0].count() == 0
    named = spark.createDataFrame([("a", [1, 2, 3, 4], "l"), ("b", [1, 2, 3, 5], "l")], "vec_id string, embedding array<int>, label string")

    assert {r["error"] for r in V.vector_codes(named)[0].collect()} == {0}


def test_trees_assign_whole_nodes_and_prune():
    rng = np.random.default_rng(6)
    centres = rng.integers(-4_000, 4_000, (256, 6)).astype(float)
    centres[200:] = centres[3]  # equal entries
    points = centres[rng.integers(0, 30, 4_096)] + rng.integers(-3, 4, (4_096, 6))
    found = V.Assigned(points, V.tree_order(points, V.LEAF), V.Codebook(centres))
    whole = sum(int(found.tree.levels[level][3][nodes].sum()) for level, nodes, _ in found.whole)
    _, leaves, groups = V.walk(found.tree, found.book)
    assert whole > 3_000 and len(groups) < 0.5 * len(found.tree.levels[-1][0]) * len(found.book.groups)
    distance = ((points[:, None] - centres[None]) ** 2).sum(2)
    code, error = found.codes(len(points))
    assert (code == distance.argmin(1)).all() and (error == distance.min(1)).all()
    total, count = np.zeros((256, 6), np.int64), np.zeros(256, np.int64)
    found.add_to(total, count)
    assert (count == np.bincount(code, minlength=256)).all() and all((total[j] == points[code == j].sum(0)).all() for j in range(256))


def test_decoding_gives_the_entries_back(spark):
    rows = [(i, [i / 1024, -i / 512, 0.5, 1.0], 0) for i in range(50)]
    blocks, books = V.train(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    out = V.decode(V.encode(blocks, books, "vec_id"), books).orderBy("vec_id").collect()
    assert [r["decoded"] for r in out] == [r[1] for r in rows] and all(r["error"] == 0 for r in out)


def test_given_embeddings_have_small_errors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], [float(v) for v in r["embedding"]], r["label"], "x", 1) for r in vectors.collect()[:400]]
    compare(spark, rows, entries=32)
    coded = V.op11_vector_codes(spark, "/root/testdata/sf0.001")
    assert coded.count() == vectors.count() and coded.select("codebooks_sha256").distinct().count() == 1
    assert coded.where((F.length("code") != 8) | (F.col("error") < 0)).count() == 0
