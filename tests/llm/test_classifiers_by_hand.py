"""Both classifiers against loops over plain numbers, and their samples against ties and order."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from paddock.llm import labelled, quality, toxicity


def sigmoid(x):
    return 1 / (1 + math.exp(-min(max(x, -35), 35)))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    out = []
    for i in range(90):
        bad = r.random() < 0.4
        w = [r.choice("red blue green grey pink".split()) for _ in range(r.randrange(1, 12))] + (["vile", "slur"] if bad else ["kind"])
        r.shuffle(w)
        out.append((i, " ".join(w) + ("!!" if i % 3 == 0 else ""), int(bad)))
    return sorted(out, key=lambda x: (x[1].encode(), x[2]))


def own_features(text):
    """Numbers of the words, pairs and pairs with a word between."""
    (_, _, number, _), = toxicity.features(pa.array([text]), toxicity.BITS)
    return sorted(set(number.tolist()))


def test_toxicity_equals_loops(spark, rows):
    z, n2 = {}, {}
    bias = 1 << toxicity.BITS

    def weight(i):
        v = z.get(i, 0.0)
        return 0.0 if abs(v) <= toxicity.L1 else -(v - math.copysign(toxicity.L1, v)) / ((toxicity.BETA + math.sqrt(n2[i])) / toxicity.ALPHA + toxicity.L2)

    random_state = np.random.default_rng(7)
    for _ in range(toxicity.EPOCHS):
        for at in random_state.permutation(len(rows)):
            _, text, y = rows[at]
            names = [*own_features(text), bias]
            w = {i: weight(i) for i in names}
            g = sigmoid(sum(w.values())) - y
            for i in names:
                n = n2.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / toxicity.ALPHA * w[i]
                n2[i] = n + g * g
    sample = spark.createDataFrame([(t, y) for _, t, y in rows], "text string, label int").repartition(5)
    model = toxicity.fit(sample)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for i, t, _ in rows:
        assert got[i] == pytest.approx(sigmoid(sum(map(weight, own_features(t))) + weight(bias)), abs=1e-5)


def test_quality_equals_loops(spark, rows):
    bits = quality.BITS
    data = []
    for _, text, y in rows:
        (_, _, number, _, value), = quality.features(pa.array([text]), bits)
        sums = {}
        for a, v in zip(number.tolist(), value.tolist()):
            sums[a] = sums.get(a, 0.0) + v
        data.append(({a: math.sqrt(v) for a, v in sums.items()}, y + (len(text) > 30)))
    share = [sum(y == g for _, y in data) + 1.0 for g in range(3)]
    theta = [math.log(b / (1 - b)) for b in (share[0] / sum(share), (share[0] + share[1]) / sum(share))]
    w, g2, t2 = {}, {}, [1e-8, 1e-8]
    order = np.random.default_rng(11)
    for _ in range(quality.EPOCHS):
        for at in order.permutation(len(data)):
            x, y = data[at]
            total = sum(w.get(a, 0.0) * v for a, v in x.items())
            s = [sigmoid(t - total) for t in theta]
            edge = [0.0, *s, 1.0]
            p = max(edge[y + 1] - edge[y], 1e-12)
            d = [0.0, 0.0]
            if y < 2:
                d[y] += s[y] * (1 - s[y]) / p
            if y > 0:
                d[y - 1] -= s[y - 1] * (1 - s[y - 1]) / p
            for a, v in x.items():
                g = sum(d) * v + quality.L2 * w.get(a, 0.0)
                g2[a] = g2.get(a, 1e-8) + g * g
                w[a] = w.get(a, 0.0) - quality.RATE * g / math.sqrt(g2[a])
            t2 = [t + e * e for t, e in zip(t2, d)]
            theta = [t + 0.1 * e / math.sqrt(q) for t, e, q in zip(theta, d, t2)]
            theta = [theta[0], max(theta)]
    sample = spark.createDataFrame([(t, y + (len(t) > 30)) for _, t, y in rows], "text string, label int").repartition(5)
    model = quality.fit(sample, 3)
    assert model.thresholds == pytest.approx(theta, abs=1e-6)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r["row"]["doc_id"]: (r["expected_grade"], r["tail"]) for r in quality.score(docs, model).collect()}
    for (i, _, _), (x, _) in zip(rows, data):
        total = sum(w.get(a, 0.0) * v for a, v in x.items())
        above = [1 - sigmoid(t - total) for t in theta]
        assert got[i] == (pytest.approx(sum(above), abs=1e-4), pytest.approx(above[1], abs=1e-4))


def test_conflicting_labels_and_order_change_nothing(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t, _ in rows] + [(0, "same id", 2)], "doc_id long, text string, label int")
    labels = [(i, y) for i, _, y in rows] + [(i, 1 - y) for i, _, y in rows[:20]] + [(None, 1), (5, None)]
    found = []
    for n, part in ((1, labels), (7, labels[::-1])):
        some = labelled.labelled_sample(docs, spark.createDataFrame(part, "doc_id long, toxic int").repartition(n), "toxic", 1_000)
        found.append([tuple(r) for r in labelled.in_one_task(some).collect()])
    assert found[0] == found[1] and len(found[0]) == len(rows) + 1
