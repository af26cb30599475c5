"""Helpers that the corpus operators share: reading, staging in the shared folder, text keys."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
_local: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the one that the cluster shares (``spark.checkpoint.dir``).

    Only where that setting is absent and all runs on one machine, as in tests, a temporary folder takes
    its place."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = _local.setdefault("dir", "file://" + tempfile.mkdtemp(prefix="paddock-"))
    return f"{base.rstrip('/')}/paddock/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Remove all that this application has staged. Results are lazy and read it: write them first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark, "x")).getParent()
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there, and a lost
    executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(id_col: str, text: Column) -> Column:
    """Tells rows of equal id and different text apart; equal (id, text) rows share it."""
    return F.xxhash64(F.col(id_col), text)


def same_row(left: DataFrame, right: DataFrame, on: tuple[str, ...] = ("_id", "_k")) -> Column:
    """Null-safe equality of the row identity."""
    cond = left[on[0]].eqNullSafe(right[on[0]])
    for c in on[1:]:
        cond &= left[c] == right[c]
    return cond


def text_slices(batch, column: int, size: int) -> Iterator:
    """An Arrow batch in parts of at most ``size`` bytes of text in that column, or of one row."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


MAX_BROADCAST_BYTES = 128 << 20


def sized_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a staged table only if a look at it proves that it has at most ``rows`` rows and
    MAX_BROADCAST_BYTES bytes; beyond that Spark chooses a shuffled join."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if found[0] <= rows and (found[1] or 0) <= MAX_BROADCAST_BYTES else df
