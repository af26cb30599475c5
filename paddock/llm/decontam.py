"""Benchmark passages in documents, through a positional inverted index.

The index stores a posting (term, document, position) for each occurrence of any benchmark term. A
benchmark window's terms are ordered by how often the corpus has them; the postings of the rarest are its
candidates, and the lists of the further terms, shifted by their offsets, are intersected from
the rarest on: first two lists for all candidates, then the frequent terms' lists in the documents that
are left. Lists are met within a number of words, so that one intersection gives proximity matches, and
among these the exact phrases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, same_row, sized_broadcast, stage, table

WINDOW = 10
DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_BROADCAST_ROWS = 200_000
#: Documents with candidates that are broadcast at most, as pairs of an id and a hash.
MAX_BROADCAST_DOCS = 1_000_000
#: Lists that are intersected for all candidates, besides the rarest term's.
FIRST_LISTS = 2
#: Positions of a block, by which lists are joined.
BLOCK = 32


def _split(df: DataFrame, text: Column) -> DataFrame:
    """Add ``words`` (array of strings): maximal runs of 0-9, a-z and all beyond ASCII."""
    df = df.withColumn("_p", F.split(lower_ascii(text), DELIMITERS))
    first, last = F.get("_p", F.lit(0)) == "", (F.get("_p", F.size("_p") - 1) == "") & (F.size("_p") > 1)
    return df.withColumn("words", F.slice("_p", 1 + first.cast("int"), F.size("_p") - first.cast("int") - last.cast("int"))).drop("_p")


def doc_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).withColumn("_k", row_key("_id", F.col("_t")))
    return _split(df, F.col("_t")).select("_id", "_k", "words")


def test_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct windows: terms, items (their ids). An item with fewer words than ``window`` is
    one window, one without words has none; null ids are left out of ``items``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = _split(items.select(F.col(id_col).alias("_i"), text.alias("_t")), F.col("_t")).where(F.size("words") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))).alias("s")
    slices = words.select("_i", "words", starts).select("_i", F.slice("words", F.col("s"), window).alias("terms"))
    return slices.groupBy("terms").agg(F.collect_set("_i").alias("items"))


def vocabulary_of(windows: DataFrame) -> DataFrame:
    """Distinct terms of the windows, numbered: term, tid."""
    return stage(stage(windows.select(F.explode("terms").alias("term")).distinct(), "terms").withColumn("tid", F.monotonically_increasing_id()), "vocabulary")


def build_postings(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The index: a posting (_id, _k, n_words, pos, tid) for each occurrence of a term, and a header row
    for each document (pos 0 or null), whose tid is null if its first word is no term."""
    all_words = words.select("_id", "_k", F.size("words").alias("n_words"), F.posexplode_outer("words").alias("pos", "_w"))
    found = all_words.join(sized_broadcast(vocabulary, MAX_BROADCAST_ROWS), F.col("_w") == F.col("term"), "left")
    return found.where("tid is not null or pos is null or pos = 0").select("_id", "_k", "n_words", "pos", "tid")


def ordered_windows(postings: DataFrame, windows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Each window with its terms from the rarest to the most frequent: wid, n, items, lists (array of
    n, term, tid, offset). Windows with a term that the corpus lacks can't occur and go."""
    numbered = stage(windows.withColumn("wid", F.monotonically_increasing_id()), "windows")
    counts = postings.where(F.col("tid").isNotNull()).groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    terms = numbered.select("wid", F.posexplode("terms").alias("offset", "term")).join(vocabulary, "term").join(counts, "tid", "left")
    lists = terms.groupBy("wid").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "tid", "offset"))).alias("lists"))
    out = numbered.select("wid", "items", F.size("terms").alias("n")).join(lists, "wid").where(F.col("lists")[0]["n"] > 0)
    return stage(out, "ordered-windows")


def _meet(candidates: DataFrame, postings: DataFrame, first: int, stop: int | None, slop: int) -> DataFrame:
    """Candidates (wid, _id, _k, pos, exact, lists) near whose anchor all terms of ``lists[first:stop]``
    occur; ``exact`` stays true where they also do so at their offsets."""
    rest = F.slice("lists", first + 1, stop - first) if stop else F.slice("lists", first + 1, F.greatest(F.size("lists") - first, F.lit(0)))
    asked = candidates.withColumn("_rest", rest)
    done = asked.where(F.size("_rest") == 0).drop("_rest")
    name = ("wid", "_id", "_k", "pos")
    start = F.col("pos") - F.col("lists")[0]["offset"]
    asks = asked.where(F.size("_rest") > 0).select(*name, "exact", start.alias("start"), F.size("_rest").alias("need"), F.posexplode("_rest").alias("j", "x"))
    low, high = F.floor((F.col("pos") - slop) / BLOCK), F.floor((F.col("pos") + slop) / BLOCK)
    asks = asks.select(*name, "exact", "need", "j", F.col("x.tid").alias("tid"), (F.col("start") + F.col("x.offset")).alias("want"), F.explode(F.sequence(low, high)).alias("block"))
    held = postings.select(F.col("_id").alias("_i"), F.col("_k").alias("_j"), F.col("tid").alias("t"), F.col("pos").alias("p"), F.floor(F.col("pos") / BLOCK).alias("b"))
    met = asks.join(held, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_k") == F.col("_j")) & (F.col("tid") == F.col("t")) & (F.col("block") == F.col("b")) & (F.abs(F.col("p") - F.col("pos")) <= slop))
    one = F.expr("shiftleft(1L, j)")
    masks = met.groupBy(*name).agg(F.bit_or(one).alias("near"), F.bit_or(F.when(F.col("p") == F.col("want"), one).otherwise(F.lit(0).cast("long"))).alias("at"), F.first("need").alias("need"), F.first("exact").alias("exact"))
    every = F.expr("shiftleft(1L, need) - 1")
    passed = masks.where(F.col("near") == every).select(*name, (F.col("exact") & (F.col("at") == every)).alias("exact"))
    return done.select(*name, "exact").unionByName(passed)


def matches(postings: DataFrame, windows: DataFrame, slop: int = WINDOW - 1) -> DataFrame:
    """Proximity matches: wid, _id, _k, pos (of the window's rarest term), exact, start, n, items.

    All terms of the window lie within ``slop`` words of ``pos``, in any order; ``exact``: they make
    the window's phrase, from ``start`` on. ``postings`` and ``windows`` are staged tables."""
    known = sized_broadcast(windows, MAX_BROADCAST_ROWS)
    terms = postings.where(F.col("tid").isNotNull()).select("_id", "_k", "pos", "tid")
    anchors = known.select("wid", F.col("lists")[0]["tid"].alias("tid"), F.lit(True).alias("exact"), "lists")
    candidates = terms.join(anchors, "tid").drop("tid")
    second = windows.select(F.explode(F.slice("lists", 2, FIRST_LISTS)).alias("x")).select(F.col("x.tid").alias("tid")).distinct()
    rare = terms.join(sized_broadcast(stage(second, "rare-terms"), MAX_BROADCAST_ROWS), "tid", "left_semi")
    left = stage(_meet(candidates, rare, 1, 1 + FIRST_LISTS, slop), "candidates")
    left = left.join(known.select("wid", "lists"), "wid")
    there = stage(left.where(F.size("lists") > 1 + FIRST_LISTS).select(F.col("_id").alias("_i"), F.col("_k").alias("_j")).distinct(), "candidate-documents")
    there = sized_broadcast(there, MAX_BROADCAST_DOCS)
    some = terms.join(there, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_k") == F.col("_j")), "left_semi")
    found = _meet(left, some, 1 + FIRST_LISTS, None, slop).join(known, "wid")
    start = F.col("pos") - F.col("lists")[0]["offset"]
    return found.select("wid", "_id", "_k", "pos", "exact", start.alias("start"), "n", "items")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Return per document: _id, _k, n_words, n_hit, n_items, items (ids as sorted strings), n_near
    (items with a window all of whose terms lie within ``window`` - 1 words of its rarest one).

    Null or empty text has no words and no hits. Rows that repeat id and text give a row each,
    with the same result. Without items nothing is hit. Other columns are not read."""
    if not 0 < window <= 60:
        raise ValueError(f"window: {window}")  # masks of lists have 64 bits
    windows = test_windows(items, item_col, item_text_col, window)
    vocabulary = vocabulary_of(windows)
    postings = stage(build_postings(doc_words(docs, id_col, text_col), vocabulary), "postings")
    # rows that repeat id and text have their postings twice, which changes no mask
    found = stage(matches(postings, ordered_windows(postings, windows, vocabulary), window - 1), "matches")
    hits = found.where("exact")
    covered = hits.select("_id", "_k", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("p")).distinct()
    n_hit = covered.groupBy("_id", "_k").agg(F.count(F.lit(1)).alias("n_hit"))
    items_of = lambda rows, name: rows.groupBy("_id", "_k").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias(name))
    near = items_of(found, "near_items")
    headers = postings.where("pos is null or pos = 0").select("_id", "_k", F.greatest("n_words", F.lit(0)).cast("long").alias("n_words"))
    out = headers
    for part in (n_hit, items_of(hits, "items"), near):
        part = part.withColumnsRenamed({"_id": "_i", "_k": "_j"})
        out = out.join(part, out["_id"].eqNullSafe(part["_i"]) & (out["_k"] == part["_j"]), "left").drop("_i", "_j")
    ids = F.coalesce(F.sort_array(F.transform("items", lambda x: x.cast("string"))), F.array().cast("array<string>"))
    return out.select("_id", "_k", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), ids.alias("items"), F.size(ids).cast("long").alias("n_items"), F.coalesce(F.size("near_items"), F.lit(0)).cast("long").alias("n_near"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a benchmark window, and the items they come from."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("_id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near",
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, len(w[s + 1:s + 10]) AS n, array_to_string(w[s + 1:s + 10], ' ') AS p FROM bw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, w, unnest(range(greatest(len(w) - n + 1, 0))) AS s FROM d, lens),
hit AS (
  SELECT x.doc_id, x.s, x.n, win.item_id
  FROM (SELECT doc_id, s, n, array_to_string(w[s + 1:s + n], ' ') AS p FROM dw) x JOIN win ON x.p = win.p AND x.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
it AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY doc_id),
dt AS (SELECT doc_id, w, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p FROM d),
tc AS (SELECT t, count(*) AS c FROM dt GROUP BY t),
wt AS (SELECT n, p, unnest(string_split(p, ' ')) AS t, unnest(range(n)) AS o FROM (SELECT DISTINCT n, p FROM win)),
anchor AS (SELECT n, p, min((coalesce(c, 0), t, o))[2] AS t FROM wt LEFT JOIN tc USING (t) GROUP BY n, p),
near AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_near FROM dt JOIN anchor USING (t) JOIN win ON win.n = anchor.n AND win.p = anchor.p
  WHERE list_has_all(w[greatest(dt.p - 9, 1):dt.p + 9], string_split(anchor.p, ' ')) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN near USING (doc_id)
"""
