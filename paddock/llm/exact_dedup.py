"""Exact duplicates through an extendible-hash index on shared files.

Keys are 64-bit hashes of whole texts. A directory over their leading bits doubles until no bucket
holds more than ``bucket_rows`` rows, and routes every row to its bucket. Owner tasks take
buckets, which are ranges of keys: they bring equal hashes together, compare the texts byte for
byte, chain texts whose hashes collide and write the buckets to the shared folder. Every row is
then answered from these files.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shuffle_partitions, stage, table

#: Rows of a bucket, about as many as a task sorts in memory.
BUCKET_ROWS = 4_096
#: The directory has 2 ** MAX_DEPTH slots at most; it is collected and broadcast.
MAX_DEPTH = 18
#: Copies of texts whose key has more rows are summed up in the tasks that read them, before the
#: shuffle. The bound rises with the table, so that at most HOT_KEYS keys, which are broadcast, are above it.
HOT_ROWS, HOT_KEYS = 2_048, 1_000_000


def build_directory(histogram: dict[int, int], max_depth: int, bucket_rows: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Double the directory until every bucket fits.

    ``histogram``: rows by the leading ``max_depth`` bits of their keys. Returns the global depth and the
    directory, one (slot, bucket's first leaf, local depth) for each slot. A bucket that is
    overfull at ``max_depth`` stays whole and is chained."""
    leaves = sorted(histogram)
    upto = [0, *accumulate(histogram[x] for x in leaves)]
    todo, done = [(0, 0)], []  # (prefix, local depth)
    while todo:
        prefix, local = todo.pop()
        width = max_depth - local
        held = upto[bisect_left(leaves, (prefix + 1) << width)] - upto[bisect_left(leaves, prefix << width)]
        if held > bucket_rows and width:
            todo += [(prefix * 2, local + 1), (prefix * 2 + 1, local + 1)]
        else:
            done.append((prefix, local))
    depth = max(local for _, local in done)
    slots = []
    for prefix, local in done:
        first = prefix << (depth - local)
        slots += [(s, prefix << (max_depth - local), local) for s in range(first, first + (1 << (depth - local)))]
    return depth, sorted(slots)


def keyed(docs: DataFrame, id_col: str, text_col: str, hash_bits: int = 64) -> DataFrame:
    """_id, _t, _h of each row; fewer ``hash_bits`` make keys collide."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_t"))
    h = F.xxhash64("_t")
    return rows.withColumn("_h", h if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(h, 64 - hash_bits), 64 - hash_bits))


def split_directory(rows: DataFrame, bucket_rows: int, max_depth: int) -> tuple[DataFrame, int, DataFrame]:
    """(directory, its depth, keys with so many rows that they are summed up first)."""
    counts = stage(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    bound = max(HOT_ROWS, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    hot = F.col("n") > bound
    leaf = F.shiftrightunsigned("_h", 64 - max_depth).alias("leaf")
    by_leaf = counts.groupBy(leaf).agg(F.sum(F.when(hot, 1).otherwise(F.col("n"))).alias("n"))
    depth, slots = build_directory({r[0]: r[1] for r in by_leaf.collect()}, max_depth, bucket_rows)  # 2 ** max_depth rows at most
    return rows.sparkSession.createDataFrame(slots, "_slot long, bucket long, local_depth int"), depth, counts.where(hot).select("_h")


def routed(rows: DataFrame, directory: DataFrame, depth: int) -> DataFrame:
    """``rows`` with their bucket and its local depth, by the leading bits of _h."""
    slot = F.shiftrightunsigned("_h", 64 - depth) if depth else F.lit(0).cast("long")
    return rows.withColumn("_slot", slot).join(F.broadcast(directory), "_slot").drop("_slot")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> tuple[DataFrame, DataFrame, int]:
    """(index, directory, depth). The index has one row for each distinct text: bucket, local_depth,
    _h, chain (its place among the texts of that key), text_sha256, n_bytes, keep_id, group_size."""
    rows = keyed(docs, id_col, text_col, hash_bits)
    directory, depth, hot = split_directory(rows, bucket_rows, max_depth)
    one = rows.join(F.broadcast(hot), "_h", "left_anti").select("_h", "_t", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))
    many = rows.join(F.broadcast(hot), "_h", "left_semi").groupBy("_h", "_t").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    owners = routed(one.unionByName(many), directory, depth).repartition(shuffle_partitions(docs.sparkSession), "bucket")
    texts = owners.groupBy("bucket", "local_depth", "_h", "_t").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    chained = texts.select("bucket", "local_depth", "_h", F.sha2("_t", 256).alias("text_sha256"), F.octet_length("_t").cast("long").alias("n_bytes"), "keep_id", "group_size")
    chain = F.row_number().over(Window.partitionBy("bucket", "_h").orderBy("text_sha256"))
    return stage(chained.withColumn("chain", chain).sortWithinPartitions("bucket", "_h", "chain"), "exact-index"), directory, depth


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, max_depth: int = MAX_DEPTH, hash_bits: int = 64) -> DataFrame:
    """Return one row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group and its largest id stays. Null and empty text are the same text.
    Rows with a null id are never preferred; in a group of null ids only, keep_id is null and
    every row counts as kept. Rows that repeat an id and its text share one verdict. No rows
    give no rows; other columns of ``docs`` are not read."""
    index, directory, depth = build_index(docs, id_col, text_col, bucket_rows, max_depth, hash_bits)
    asked = keyed(docs, id_col, text_col, hash_bits).select("_id", "_h", F.sha2("_t", 256).alias("text_sha256"))
    found = routed(asked, directory, depth).drop("local_depth").join(index.select("bucket", "_h", "text_sha256", "keep_id", "group_size"), ["bucket", "_h", "text_sha256"])
    return found.select(F.col("_id").alias(id_col), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the document of each that stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""
