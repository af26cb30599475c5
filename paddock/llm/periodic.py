"""Periodic runs of words, by Kruskal's order over the longest common prefixes of suffixes.

Suffixes of a text's words are sorted by prefix doubling. Neighbours in that order are united from
the longest common prefix down; each class keeps its positions in order. Where a union at prefix
length l brings two positions p < q side by side and q - p does not exceed l, the words from p to q + l have
period q - p. Texts are independent, so there is no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: A run has so many words, and so many periods, at least.
MIN_WORDS, MIN_PERIODS = 24, 3
#: White space of ASCII, which parts words.
SPACE = " \t\n\x0b\x0c\r"
#: Characters of results that are handed on together.
OUT_CHARS = 8 << 20


def shortest_prefix(min_words: int, min_periods: int) -> int:
    """The shortest common prefix of the first two periods of any run that is long enough."""
    return min(max(min_words - q, (min_periods - 1) * q) for q in range(1, min_words + 1))


def suffix_neighbours(ids, least: int):
    """(prefix length, position, position) of suffixes next to each other in the sorted order of all
    suffixes of ``ids`` that share ``least`` items or more. Only suffixes that still share their first items with
    another one are sorted on."""
    import numpy as np

    n, size = len(ids), 1
    ranks, levels = np.zeros(n, np.int64), []
    alive, key = np.arange(n), ids.astype(np.int64)
    while True:
        order = np.argsort(key, kind="stable")
        alive, key = alive[order], key[order]
        old = ranks[alive]
        place = np.arange(len(alive))
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        outer = np.concatenate(([True], old[1:] != old[:-1]))
        first = np.maximum.accumulate(np.where(fresh, place, 0))
        ranks = ranks.copy()
        ranks[alive] = old + first - np.maximum.accumulate(np.where(outer, place, 0))
        levels.append(ranks.astype(np.int32 if n < 1 << 31 else np.int64))
        single = fresh & np.concatenate((fresh[1:], [True]))
        if size <= least:
            shared = alive[~single]
        alive = alive[~single]
        if not len(alive):
            break
        after = alive + size
        key = ranks[alive] * (n + 1) + np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        size *= 2
    if len(shared) < 2:
        return (np.zeros(0, np.int64),) * 3
    shared = shared[np.argsort(ranks[shared])]
    i, j = shared[:-1], shared[1:]
    length = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = i + length, j + length
        inside = np.maximum(a, b) < n
        same = inside & (levels[level][np.where(inside, a, 0)] == levels[level][np.where(inside, b, 0)])
        length[same] += 1 << level
    keep = length >= least
    return length[keep], i[keep], j[keep]


def newly_adjacent(lengths, left, right) -> Iterator[tuple[int, int, int]]:
    """Unite neighbours by decreasing prefix length; yield (p, q, length), p < q, of positions that
    come side by side in the class that a union makes."""
    import numpy as np

    parent: dict[int, int] = {}
    places: dict[int, list[int]] = {}

    def root(x: int) -> int:
        if x not in parent:
            parent[x], places[x] = x, [x]
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    order = np.argsort(-lengths, kind="stable")
    for length, a, b in zip(lengths[order].tolist(), left[order].tolist(), right[order].tolist(), strict=True):
        big, small = root(a), root(b)
        if len(places[big]) < len(places[small]):
            big, small = small, big
        into, more = places[big], places.pop(small)
        parent[small] = big
        at = 0
        for x in more:
            at = bisect_left(into, x, at)
            if at:
                yield into[at - 1], x, length
            if at < len(into):
                yield x, into[at], length
        if len(more) == 1:
            into.insert(at, more[0])
        else:
            into += more
            into.sort()  # two ordered stretches are merged


def word_runs(words: list, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period.

    A run is a stretch with smallest period q, of at least ``min_words`` and ``min_periods`` * q words, that
    no neighbouring word extends."""
    if len(words) < min_words:
        return []
    import numpy as np

    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return []
    runs: dict[tuple[int, int], int] = {}
    for p, q, length in newly_adjacent(*suffix_neighbours(ids, shortest_prefix(min_words, min_periods))):
        period = q - p
        # the run's own first pair is met too, so pairs further right in a run are left out
        if length >= (min_periods - 1) * period and period + length >= min_words and (p == 0 or words[p - 1] != words[q - 1]):
            span = (p, q + length)
            runs[span] = min(period, runs.get(span, period))
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; ties go to the smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that any run contains after its first period."""
    if not runs:
        return words
    depth = [0] * (len(words) + 1)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept, inside = [], 0
    for w, change in zip(words, depth, strict=False):
        inside += change
        if not inside:
            kept.append(w)
    return kept


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Return for each row of ``docs``: id, n_words, runs (array of start, length, period, by start and
    period), strongest (the run with most periods, null without runs) and collapsed (the text's words
    without repeats of periods, joined by one space).

    Words stand between white space of ASCII and are compared by their bytes. Null text is empty and has no words;
    rows are independent, so repeated rows give repeated results and no rows give none. Columns
    besides id and text are not read. A text of any length is one task's work; it takes about 120 bytes of memory a word,
    and more for words that repeat far back."""
    run = "struct<start:bigint,length:bigint,period:bigint>"

    def find(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
        names = [id_col, "n_words", "runs", "strongest", "collapsed"]
        for batch in batches:
            rows, begin, chars = [], 0, 0
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                words = text.encode().split()
                runs = word_runs(words, min_words, min_periods)
                as_dicts = [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs]
                best = strongest(runs)
                rows.append((len(words), as_dicts, best and dict(zip(("start", "length", "period"), best, strict=True)), b" ".join(collapse(words, runs)).decode()))
                chars += len(text)
                if chars >= OUT_CHARS or i == batch.num_rows - 1:
                    n, r, s, c = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0)[begin : i + 1], pa.array(n, pa.int64()), pa.array(r, pa.list_(kinds)), pa.array(s, kinds), pa.array(c, pa.string())], names)
                    rows, begin, chars = [], i + 1, 0

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"))
    return rows.mapInArrow(find, f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_words bigint, runs array<{run}>, strongest {run}, collapsed string")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with a periodic tail in texts whose id, as decimal text, has a crc32 divisible by ten; a null
    id changes nothing."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = ((h - h % 10) / 10).cast("bigint")
    words = F.split(F.btrim(F.col(text_col).cast("string"), F.lit(SPACE)), r"[\x20\x09-\x0D]+")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.concat_ws(" ", F.slice(words, F.lit(1), a), tail)
    chosen = (h % 10 == 0) & (F.btrim(F.col(text_col).cast("string"), F.lit(SPACE)) != "")
    return docs.withColumn(text_col, F.when(chosen, planted).otherwise(F.col(text_col)))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of which get a periodic tail first."""
    found = periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.col("strongest")

    def line(r: Column) -> Column:
        return F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))

    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        ((best["length"] * 1000 - (best["length"] * 1000) % best["period"]) / best["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
