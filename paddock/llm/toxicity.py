"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has its own learning rate and an L1 penalty, so that few weights differ from
zero; these are broadcast to score all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .labelled import bucket, in_one_task, labelled_sample

#: Labelled documents used at most for fitting.
SAMPLE_ROWS = 20_000
BITS = 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 1.0
THRESHOLD = 0.3


def word_table():
    """Bytes of words: letters, digits and all beyond ASCII."""
    import numpy as np

    inside = np.zeros(256, bool)
    inside[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return inside


def features(array, bits: int):
    """Yield (first text, feature numbers, how many each text has, repeats included): single words,
    pairs of neighbours and pairs with one word between, of whole texts."""
    import numpy as np

    from . import textnum

    data, offsets = textnum.text_bytes(array)
    inside = word_table()
    for i, j in textnum.chunks(offsets):
        part = data[offsets[i] : offsets[j]]
        start, end, counts = textnum.word_spans(part, offsets[i : j + 1] - offsets[i], inside)
        words = textnum.span_hashes(part, start, end) if len(start) else np.zeros(0, np.uint64)
        doc = np.repeat(np.arange(j - i), counts)
        found, owner = [words], [doc]
        for gap, salt in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
            m = max(0, len(words) - gap)
            same = doc[:m] == doc[gap:]
            found.append(textnum.mix(words[:m] * np.uint64(salt) + words[gap:])[same])
            owner.append(doc[:m][same])
        yield i, j - i, (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), np.concatenate(owner)


def fit(sample: DataFrame, bits: int = BITS, epochs: int = EPOCHS) -> tuple[list[int], list[float], float]:
    """(feature numbers, weights other than zero, bias), fitted in one task over the bounded
    sample. Without rows, or with one label alone, there are no weights and the bias says so."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        rows: list[tuple] = []
        for batch in batches:
            y = batch.column(1).to_pylist()
            for first, n, number, owner in features(batch.column(0), bits):
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(1, n))
                rows += [(np.unique(x).astype(np.int32), y[first + i]) for i, x in enumerate(np.split(number[order], cuts))]
        z, n2 = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        bias = 1 << bits

        def weights(at):
            zz = z[at]
            w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n2[at])) / ALPHA + L2)
            w[np.abs(zz) <= L1] = 0.0
            return w

        random = np.random.default_rng(7)
        for _ in range(epochs):
            for r in random.permutation(len(rows)):
                at, y = rows[r]
                at = np.append(at, bias)
                w = weights(at)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
                sigma = (np.sqrt(n2[at] + g * g) - np.sqrt(n2[at])) / ALPHA
                z[at] += g - sigma * w
                n2[at] += g * g
        w = weights(np.arange(len(z)))
        at = np.flatnonzero(w)
        at = at if len(at) and at[-1] == bias else np.append(at, bias)
        yield pa.RecordBatch.from_pydict({"number": pa.array(at, pa.int64()), "weight": pa.array(w[at], pa.float64())})

    found = in_one_task(sample).mapInArrow(run, "number long, weight double").collect()  # 2 ** bits rows at most
    bias = sum(r[1] for r in found if r[0] == 1 << bits)
    return [r[0] for r in found if r[0] < 1 << bits], [r[1] for r in found if r[0] < 1 << bits], bias


def score(docs: DataFrame, model: tuple[list[int], list[float], float], id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """id, score (0 to 1) of every row over its whole text. Null and empty texts get the bias's."""
    import numpy as np

    dense = np.zeros(1 << bits, np.float32)
    dense[model[0]] = model[1]
    weights, bias = docs.sparkSession.sparkContext.broadcast(dense), model[2]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        w = weights.value
        for batch in batches:
            total = np.full(batch.num_rows, bias)
            for first, n, number, owner in features(batch.column(1), bits):
                some = np.flatnonzero(w[number])
                pairs = np.unique(owner[some] << bits | number[some])  # a feature counts once
                total[first : first + n] += np.bincount(pairs >> bits, weights=w[pairs & ((1 << bits) - 1)], minlength=n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))], [id_col, "score"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"))
    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted of every row. Labels are learnt only from ids whose crc32 (as
    text) modulo 4 isn't 2. Null ids aren't held out and teach nothing; repeated rows get equal
    scores; without labels every score is one half."""
    model = fit(labelled_sample(docs, labels, label, sample_rows, bucket(F.col(id_col), 4) != 2, id_col, text_col))
    out = score(docs, model, id_col, text_col)
    return out.select(id_col, (bucket(F.col(id_col), 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels that aren't held out."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
