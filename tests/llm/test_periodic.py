"""Periodic runs against the definition: every period is tried on every text."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paddock.llm import periodic as R


def by_definition(words, least=24, periods=3):
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=20), st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 90), st.lists(st.integers(0, 2), max_size=30), st.sampled_from([(24, 3), (6, 2), (9, 3), (12, 4)]))
def test_runs_are_those_of_the_definition(before, root, length, after, bounds):
    words = before + [root[i % len(root)] for i in range(length)] + after
    assert R.word_runs(words, *bounds) == by_definition(words, *bounds)


def test_the_first_period_of_nested_runs_stays():
    words = (["a"] * 30 + ["b"]) * 4
    runs = R.word_runs(words)
    assert runs == [(0, 30, 1), (0, 124, 31), (31, 30, 1), (62, 30, 1), (93, 30, 1)]
    assert R.collapse(words, runs) == ["a", "b"] and R.strongest(runs) == (0, 30, 1)
    assert R.strongest([(5, 60, 20), (0, 30, 10)]) == (0, 30, 10)


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = by_definition(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_the_definition(spark, tmp_path):
    rng = random.Random(5)
    rows = [(1, None, 1), (2, "", 1), (3, " \t\x0b\n", 1), (None, "a " * 40, 1), (4, "é b " * 30, 1), (4, "é b " * 30, 2), (5, "A a " * 50, 1), (6, "w\x0cv\r" * 20, 1)]
    rows += [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(200))), i) for i in range(10, 160)]
    rows += [(i, " ".join([f"w{k % 40}" for k in range(300)] + ["end"] * 40), i) for i in range(160, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, R.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 50
    assert R.periodic_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words", [["a"] * 150_000, [f"w{i % 7000}" for i in range(150_000)], [str(i * i % 1009) for i in range(150_000)]])
def test_very_long_texts(spark, words):
    docs = spark.createDataFrame([("x", " ".join(words))], "doc_id string, text string")
    row = R.periodic_runs(docs).first()
    period = next(q for q in range(1, 10_000) if words[q:] == words[:-q])
    assert [tuple(r) for r in row["runs"]] == [(0, 150_000, period)] and row["collapsed"] == " ".join(words[:period])


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r["text"] or "") < 10_000]
    got = {r[0]: tuple(r) for r in R.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(rows) > 100 and all(got[i] == expected(i, t) for i, t in rows)
