"""Keyed merges and other updates, expressed as new tables. Plain Parquet has no row updates: write
the result to a new folder and swap, or to the partitions that change."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

P = F.col


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], updated: str, tie: Sequence[str] = ()) -> DataFrame:
    """The latest row of each key; of equal times the new table's row wins, then ``tie`` descending."""
    rows = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc(updated), F.desc("_new"), *[F.desc(t) for t in tie])
    return rows.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


def fill_missing(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str], blank: bool = False, together: bool = False) -> DataFrame:
    """Fill null (with ``blank`` also empty) columns from another table's row of the same key; with
    ``together`` all of them take the other row's values, nulls too, where any is missing and there is such a row."""
    o = other.select(P(key).alias("_k"), F.lit(True).alias("_found"), *[P(c).alias(f"_o_{c}") for c in columns])
    have = {c: F.nullif(P(c), F.lit("")) if blank else P(c) for c in columns}
    some = F.lit(False)
    for c in columns:
        some |= have[c].isNull()
    filled = {c: F.when(some & P("_found"), P(f"_o_{c}")).otherwise(P(c)) if together else F.coalesce(have[c], f"_o_{c}") for c in columns}
    out = df.join(o, P(key) == P("_k"), "left")
    return out.select(*[filled[c].alias(c) if c in columns else P(c) for c in df.columns])


def keep_since(df: DataFrame, date: str, as_of: Column, days: int) -> DataFrame:
    return df.where(P(date) >= F.date_sub(as_of, days))


def drop_outside(df: DataFrame, condition: Column, sample_by: str | None = None, sample: int = 3, order: str | None = None) -> DataFrame:
    """Rows that meet the condition; with ``sample_by`` a dry run: some of the rows that would go."""
    if sample_by is None:
        return df.where(condition)
    w = Window.partitionBy(sample_by).orderBy(order)
    return df.where(~condition).withColumn("_r", F.row_number().over(w)).where(P("_r") <= sample).drop("_r")


def merge_twins(df: DataFrame, twins: dict[str, str]) -> DataFrame:
    """Fill each column from its twin and drop the twin."""
    for one, two in twins.items():
        df = df.withColumn(one, F.coalesce(one, two)).drop(two)
    return df


def typed_payload(df: DataFrame, column: str, payload: str, path: str, pattern: str, kind: str) -> DataFrame:
    """Fill a column from a JSON payload where it is null and the text fits the pattern."""
    value = F.get_json_object(payload, path)
    return df.withColumn(column, F.coalesce(column, F.when(value.rlike(pattern), value.try_cast(kind))))


#: What a payload's text must be for each kind; money may have a currency sign and commas, which go.
GUARDS = {"int": r"^[0-9]+$", "double": r"^[0-9]+\.?[0-9]*$", "money": r"^[£€$]?[0-9,]+\.?[0-9]*$", "string": None}
#: The fields of a runner's payload and their kinds, by the column that they fill.
PAYLOAD_FIELDS = {
    "weight": ("weight_lbs", "int"), "finishing_time": ("time", "string"), "starting_price_decimal": ("sp_dec", "double"), "overall_beaten_distance": ("ovr_btn", "double"), "jockey_claim_lbs": ("jockey_claim_lbs", "int"),
    "weight_stones_lbs": ("weight", "string"), "race_comment": ("comment", "string"), "jockey_silk_url": ("silk_url", "string"), "form": ("form_string", "string"), "prize_money_won": ("prize", "money"),
}


def typed_payloads(df: DataFrame, payload: str, fields: dict[str, tuple[str, str]] = PAYLOAD_FIELDS) -> DataFrame:
    """Fill columns (added where ``df`` lacks them) from a JSON payload where they are null and the payload's text is not empty and fits its kind.
    The payload is parsed once for all fields; what is no JSON object fills nothing."""
    schema = ", ".join(f"`{f}` string" for f in dict.fromkeys(f for f, _ in fields.values()))
    parsed = df.withColumn("_payload", F.from_json(payload, schema))
    out = {}
    for column, (field, kind) in fields.items():
        text = P("_payload").getField(field)
        right = (text != "") & (text.rlike(GUARDS[kind]) if GUARDS[kind] else F.lit(True))
        value = F.regexp_replace(text, "[£€$,]", "") if kind == "money" else text
        value = F.when(right, value if kind == "string" else value.try_cast("int" if kind == "int" else "double"))
        out[column] = F.coalesce(column, value) if column in df.columns else value
    return parsed.withColumns(out).drop("_payload")


def reconcile_recent(stored: DataFrame, again: DataFrame, keys: Sequence[str], time: str, as_of, days: int = 7) -> DataFrame:
    """The stored table with the rows of the last ``days`` read once more: those replace what is stored,
    older rows of ``again`` are not looked at."""
    recent = again.where(P(time) >= F.lit(as_of) - F.make_dt_interval(F.lit(days)))
    return stored.join(recent.select(*keys), list(keys), "left_anti").unionByName(recent)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def log_run(spark, path: str, table: str, operation: str, processed: int, status: str = "success", error: str | None = None, skipped: int = 0) -> None:
    """Append one row to the run log."""
    row = spark.range(1).select(
        F.uuid().alias("id"), F.lit(table).alias("table_name"), F.lit(operation).alias("operation"), F.lit(processed).cast("long").alias("records_processed"), F.lit(skipped).cast("long").alias("records_skipped"),
        F.lit(status).alias("status"), F.lit(error).cast("string").alias("error_message"), F.current_timestamp().alias("created_at"),
    )
    append(row, path)


def load(df: DataFrame, path: str, log: str, table: str, rejected: Column, operation: str = "insert") -> dict[str, int]:
    """Append ``df`` to the table at ``path`` and log how many rows that were. Rows that meet ``rejected`` go to a quarantine beside it.

    Both are written by one job, which also counts them; a load that fails is logged with its error and
    raised again. Read them with ``loaded`` and ``quarantine``."""
    spark, seen = df.sparkSession, Observation(f"load {table} {uuid.uuid4().hex}")
    bad = F.coalesce(rejected, F.lit(False))
    rows = df.withColumn("rejected", bad).observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(P("rejected")).alias("bad"))
    try:
        append(rows, path, ["rejected"])
    except Exception as error:
        log_run(spark, log, table, operation, 0, "error", str(error)[:500])
        raise
    counts = seen.get
    log_run(spark, log, table, operation, counts["n"] - counts["bad"], skipped=counts["bad"])
    return {"processed": counts["n"] - counts["bad"], "skipped": counts["bad"]}


def loaded(spark, path: str) -> DataFrame:
    """The rows that ``load`` has taken."""
    return spark.read.parquet(path).where(P("rejected") == "false").drop("rejected")


def quarantine(spark, path: str) -> DataFrame:
    """The rows that ``load`` has rejected."""
    return spark.read.parquet(path).where(P("rejected") == "true").drop("rejected")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
