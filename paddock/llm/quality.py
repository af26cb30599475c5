"""Quality by ordinal regression with a cumulative logit link over hashed text.

P(grade <= g) = sigmoid(threshold_g - w . x): one set of weights for all grades and thresholds in
ascending order. The expected grade and the probability of the upper grades select documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import table
from .labelled import in_one_task, labelled_sample

#: Labelled documents used at most for fitting.
SAMPLE_ROWS = 20_000
BITS = 16
EPOCHS = 6
RATE = 0.5
L2 = 1e-6
#: A document is rejected if the probability of the upper grades is lower.
MIN_TAIL = 0.1


class Model(NamedTuple):
    weights: list[float]
    thresholds: list[float]


def features(array, bits: int):
    """Yield (first text, number of texts, feature numbers, owners, values) of whole texts: the
    words, their shapes (kinds of their first and last bytes, length), and whether a word repeats
    one of the two before it; each valued by its share of the text's words."""
    import numpy as np

    from . import textnum

    kind = np.full(256, 5, np.uint64)
    kind[33:128] = np.arange(33, 128) + 10
    kind[48:58], kind[65:91], kind[97:123], kind[128:] = 1, 2, 3, 4
    data, offsets = textnum.text_bytes(array)
    for i, j in textnum.chunks(offsets):
        part = data[offsets[i] : offsets[j]]
        start, end, counts = textnum.word_spans(part, offsets[i : j + 1] - offsets[i])
        n, doc = len(start), np.repeat(np.arange(j - i), counts)
        share = np.repeat(1.0 / np.maximum(counts, 1), counts)
        if n:
            words = textnum.span_hashes(part, start, end)
            last = kind[part[end - 1]]
            size = np.minimum(end - start, 20).astype(np.uint64)
            tail = np.where(size > 1, kind[part[np.maximum(end - 2, 0)]], np.uint64(0))
            shape = textnum.mix(last * np.uint64(1 << 40) + kind[part[start]] * np.uint64(1 << 20) + tail * np.uint64(1 << 8) + np.uint64(77))
            length = textnum.mix(size + np.uint64(0xABCDEF))
            again = np.zeros(n, bool)
            for gap in (1, 2):
                again[gap:] |= (words[gap:] == words[: n - gap]) & (doc[gap:] == doc[: n - gap])
            numbers = np.concatenate((words, shape, length, np.full(int(again.sum()), 0x1234567890ABCDEF, np.uint64)))
            owners = np.concatenate((doc, doc, doc, doc[again]))
            values = np.concatenate((share, share, share, share[again]))
        else:
            numbers, owners, values = np.zeros(0, np.uint64), doc, share
        yield i, j - i, (numbers >> np.uint64(64 - bits)).astype(np.int64), owners, values


def fit(sample: DataFrame, grades: int, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Fit on (text, label) rows, labels 0 to ``grades`` - 1, in one task over the bounded sample."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rows = []
        for batch in batches:
            y = batch.column(1).to_pylist()
            for first, n, number, owner, value in features(batch.column(0), bits):
                cell, where = np.unique(owner << bits | number, return_inverse=True)
                value = np.bincount(where, weights=value, minlength=len(cell))
                cuts = np.searchsorted(cell >> bits, np.arange(1, n))
                number = (cell & ((1 << bits) - 1)).astype(np.int32)
                rows += [(a, np.sqrt(v), y[first + k]) for k, (a, v) in enumerate(zip(np.split(number, cuts), np.split(value, cuts), strict=True))]
        w, g2 = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
        share = np.bincount(np.array([r[2] for r in rows], np.int64), minlength=grades) + 1.0
        below = np.cumsum(share)[:-1] / share.sum()
        theta, t2 = np.log(below / (1 - below)), np.full(grades - 1, 1e-8)
        sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -35, 35)))
        random = np.random.default_rng(11)
        for _ in range(epochs):
            for r in random.permutation(len(rows)):
                at, value, y = rows[r]
                s = sigmoid(theta - w[at] @ value)  # P(grade <= g)
                edges = np.concatenate(([0.0], s, [1.0]))
                p = max(edges[y + 1] - edges[y], 1e-12)
                slope = s * (1 - s)
                d = np.zeros(grades - 1)  # of the log likelihood by each threshold
                if y < grades - 1:
                    d[y] += slope[y] / p
                if y > 0:
                    d[y - 1] -= slope[y - 1] / p
                g = d.sum() * value + L2 * w[at]  # of the loss by each weight
                g2[at] += g * g
                w[at] -= RATE * g / np.sqrt(g2[at])
                t2 += d * d
                theta = np.maximum.accumulate(theta + 0.1 * d / np.sqrt(t2))
        yield pa.RecordBatch.from_pydict({"w": pa.array([w.tolist()]), "t": pa.array([theta.tolist()])})

    found = in_one_task(sample).mapInArrow(run, "w array<double>, t array<double>").first()
    if found is None:  # nothing to learn from: all grades are as likely
        return Model([0.0] * (1 << bits), [math.log(g / (grades - g)) for g in range(1, grades)])
    return Model(list(found[0]), list(found[1]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """For each row of ``docs``: row (all its columns, as a struct, whatever their names),
    expected_grade and tail (probability of the upper half of the grades), from whole texts. Null
    and empty texts have no features."""
    import numpy as np

    theta = np.array(model.thresholds)
    weights = docs.sparkSession.sparkContext.broadcast(np.array(model.weights, np.float32))
    upper = len(theta) // 2

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        w = weights.value
        for batch in batches:
            total = np.zeros(batch.num_rows)
            for first, n, number, owner, value in features(batch.column(1), bits):
                cell = owner << bits | number
                order = np.argsort(cell, kind="stable")
                cell, value = cell[order], value[order]
                head = np.flatnonzero(np.diff(cell, prepend=-1))
                value = np.sqrt(np.add.reduceat(value, head)) if len(head) else value
                cell = cell[head]
                total[first : first + n] += np.bincount(cell >> bits, weights=value * w[cell & ((1 << bits) - 1)], minlength=n)
            above = 1 - 1 / (1 + np.exp(-np.clip(theta - total[:, None], -35, 35)))  # P(grade > g)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, upper])], ["row", "expected_grade", "tail"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("_t"))
    schema = StructType([rows.schema["row"], StructField("expected_grade", DoubleType()), StructField("tail", DoubleType())])
    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Grades are the integers from 0 to the largest label, two at least. Without labels the
    thresholds follow from no data and every document scores alike."""
    top = labels.agg(F.max(F.col(label).cast("int"))).first()[0]
    sample = labelled_sample(docs, labels.where(F.col(label) >= 0), label, sample_rows, id_col=id_col, text_col=text_col)
    return fit(sample, max(2, (top or 0) + 1))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and probability of the upper grades of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("row.doc_id", "expected_grade", F.col("tail").alias("tail_probability"), (F.col("tail") >= MIN_TAIL).alias("kept"))
