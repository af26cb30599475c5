"""From raw documents to token ids: five stages, each written as Parquet and read by the next.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns
of documents; the last returns token ids. Null text is empty, null ids are ids like others, no rows give no
rows, and columns besides doc_id and text are handed on as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import bpe, decontam, line_dedup, near_dedup, quality
from paddock.llm.common import row_key, same_row, stage, table


def _only(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (_id, _k) names."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    left = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), text.alias("_t")).withColumn("_k", row_key("_id", F.col("_t"))).drop("_t")
    return left.join(chosen, same_row(left, chosen), "left_semi").select("row.*")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose probability of the upper grades is below ``quality.MIN_TAIL``."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where(F.col("tail") >= quality.MIN_TAIL).select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that ten documents or more share the first stays; n_chars follows the text. Every
    document stays, also if no line is left."""
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, keep="first"))
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    changed = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")).alias("n_chars")
    return out.select(*[changed.get(c, F.col("row").getField(c).alias(c)) for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: shingles of five words, similarity of
    0.8 or more. Of rows that repeat id and text one stays, that whose other columns are the smallest as JSON text."""
    found = stage(near_dedup.near_dedup(docs, k=5, percent=80).where("kept").groupBy("_id", "_k").agg(F.count(F.lit(1)).alias("copies")), "near-kept")
    repeated = found.where("copies > 1").select("_id", "_k")
    if not repeated.limit(1).count():
        return _only(docs, found.select("_id", "_k"))
    single = _only(docs, found.where("copies = 1").select("_id", "_k"))
    again = _only(docs, repeated).select(F.struct("*").alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    least = F.min_by("row", F.to_json("row", {"ignoreNullFields": "false"}))
    return single.unionByName(again.groupBy(F.col("row.doc_id").alias("_id"), text.alias("_t")).agg(least.alias("row")).select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold ten consecutive words of a benchmark item."""
    return _only(docs, decontam.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("_id", "_k"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with hashes of the ids and of the bytes that they decode to."""
    return bpe.encode_documents(docs, *bpe.default_vocabulary())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", bpe_stage),
]

#: The classifier has no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
