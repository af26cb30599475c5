"""Repeated lines: range-partitioned line hashes, secondary sort, compressed keep bitmaps.

Line keys become 128-bit hashes, dealt by ranges and sorted by (hash, document, position), so that
one pass meets a line's occurrences in order: it tells the first from the others and counts the
documents. Lines with very many occurrences, known from a count that is summed up before the
shuffle, would not fit a range; they are few, and two further sums and a broadcast settle them.
The operator returns bitmaps of the lines that stay, never text; ``apply_bitmaps`` applies them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, same_row, shuffle_partitions, stage, table

SPACES = " \t\n\x0b\f\r"
MIN_DOCS = 10
#: Keys of more lines are taken out of the ranges. The bound rises with the table, so that at most
#: HOT_KEYS keys, which are broadcast, are above it.
HOT_LINES, HOT_KEYS = 2_048, 1_000_000


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def keyed_docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_t")).withColumn("_k", row_key("_id", F.col("_t")))


def _in_ranges(lines: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """_id, _k, pos of the lines that go, from one pass over sorted ranges."""
    ordered = lines.repartitionByRange(shuffle_partitions(lines.sparkSession), "h1", "h2").sortWithinPartitions("h1", "h2", "_id", "_k", "pos")
    key = Window.partitionBy("h1", "h2")
    w = key.orderBy("_id", "_k", "pos")
    first = F.rank().over(w) == 1  # rows that repeat the first document share its place
    fresh = (F.row_number().over(w) == 1) | ~F.lag("_id").over(w).eqNullSafe(F.col("_id"))
    seen = ordered.select("_id", "_k", "pos", "h1", "h2", first.alias("first"), fresh.cast("int").alias("fresh"))
    gone = seen.withColumn("n_docs", F.sum("fresh").over(key)).where(F.col("n_docs") >= min_docs)
    return (gone.where("not first") if keep == "first" else gone).select("_id", "_k", "pos")


def _hot(lines: DataFrame, min_docs: int, keep: str) -> DataFrame:
    """The same for lines of keys that no range could hold. Their keys are few."""
    per_doc = lines.groupBy("h1", "h2", "_id").agg(F.min(F.struct("_k", "pos")).alias("at"))
    first = F.min(F.struct("_id", F.col("at._k").alias("_k"), F.col("at.pos").alias("pos"))).alias("first")
    repeated = per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), first).where(F.col("n_docs") >= min_docs)
    gone = lines.join(F.broadcast(repeated), ["h1", "h2"])
    if keep == "first":
        gone = gone.where(~F.struct("_id", "_k", "pos").eqNullSafe(F.col("first")))
    return gone.select("_id", "_k", "pos")


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, keep: str = "none", min_chars: int = 1) -> DataFrame:
    """Keep bitmaps of the documents that lose a line: _id, _k, keep_words, n_dropped.

    ``keep_words``: array of (word, bits) for the 64-line words with a line that goes; a set bit
    means that the line stays, and words that are absent keep all their lines.
    A line's key must have ``min_chars`` code points and occur in ``min_docs`` documents; rows of one id
    are one document, rows without an id together another.
    ``keep="none"``: every occurrence goes; ``keep="first"``: the first by (id, text's hash, position) stays.
    Null or empty text is one empty line. Rows that repeat id and text lose the same lines; null ids
    sort first. No rows give none."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep: {keep}")
    lines = keyed_docs(docs, id_col, text_col).select("_id", "_k", F.posexplode_outer(F.split("_t", "\n")).alias("pos", "line"))
    key = line_key(F.col("line"))
    lines = lines.select("_id", "_k", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    lines = stage(lines.select("_id", "_k", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "lines")
    counts = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_LINES)
    counts = stage(counts, "hot-lines")
    bound = max(HOT_LINES, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    hot = F.broadcast(counts.where(F.col("n") > bound).select("h1", "h2"))
    gone = _in_ranges(lines.join(hot, ["h1", "h2"], "left_anti"), min_docs, keep).unionByName(_hot(lines.join(hot, ["h1", "h2"], "left_semi"), min_docs, keep))
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = gone.groupBy("_id", "_k", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("lost"))
    return words.groupBy("_id", "_k").agg(
        F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("lost").alias("bits")))).alias("keep_words"),
        F.sum(F.bit_count("lost")).alias("n_dropped"),
    )


def dropped_positions(keep_words: Column) -> Column:
    """The positions whose bit is unset."""
    one = lambda w: F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("bit_get", w["bits"], b) == 0)
    return F.flatten(F.transform(keep_words, lambda w: F.transform(one(w), lambda b: w["word"] * 64 + b)))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: row (all its columns, as a struct, whatever their names), kept_text
    (the lines that stay, joined by line feeds), n_lines, n_dropped."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    left = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), F.xxhash64(F.col(id_col), blank(F.col(text_col))).alias("_k"))
    joined = left.join(bitmaps, same_row(left, bitmaps), "left")  # the text travels once, inside the row
    joined = joined.select("row", blank(F.col("row").getField(text_col)).alias("_t"), "keep_words", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    joined = joined.select("*", F.split("_t", "\n").alias("_lines"))
    n = F.size("_lines")
    stays = F.array_except(F.sequence(F.lit(0), n - 1), dropped_positions(F.col("keep_words")))
    kept = F.array_join(F.transform(stays, lambda i: F.get(F.col("_lines"), i)), "\n")
    return joined.select("row", F.when(F.col("keep_words").isNull(), F.col("_t")).otherwise(kept).alias("kept_text"), n.cast("long").alias("n_lines"), "n_dropped")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten documents or more hold, as counts and a hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, line_bitmaps(docs))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
