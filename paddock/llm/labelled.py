"""Bounded samples of labelled documents, which classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, only: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text, label of about ``rows`` labelled documents at most, chosen by a hash of their ids.

    Rows without an id or a label, and those that ``only`` (a condition on the id) excludes, are
    left out. Of several labels of one id the largest counts. The sample is taken over ids alone; texts
    are read for its rows only."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    if only is not None:
        known = known.where(only)
    known = known.select(F.col(id_col), F.col(label).cast("int").alias("label")).groupBy(id_col).agg(F.max("label").alias("label"))
    share = min(1.0, 0.95 * rows / max(1, known.count()))  # the count keeps what is broadcast below the bound
    chosen = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) if share < 1 else 1 << 30))
    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), id_col).select("text", "label")


def in_one_task(sample: DataFrame) -> DataFrame:
    """The bounded sample in an order that no partitioning changes."""
    return sample.repartition(1).sortWithinPartitions("text", "label")


def bucket(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null ids are in bucket 0."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus, F.lit(0))
