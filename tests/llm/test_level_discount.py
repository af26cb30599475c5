"""Order-2 scores with one discount for the level, whatever the number of shards."""

import math
import random
import zlib
from collections import Counter

import pytest

from paddock.llm import language_model


@pytest.mark.parametrize("shards", [1, 4, 7])
def test_scores_have_the_discount_of_the_whole_level(spark, shards):
    r = random.Random(4)
    rows = [(i, " ".join(f"w{int(r.paretovariate(0.7)) % 60}" for _ in range(r.choice([0, 2, 15, 40])))) for i in range(60)]
    tokens = {i: [*t.split(), "END"] for i, t in rows}
    learnt = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    count = Counter(w for t in learnt for w in t)
    pairs = Counter(p for t in learnt for p in zip(["START", *t], t))
    total, kinds = Counter(), Counter(a for a, _ in pairs)
    for (a, _), c in pairs.items():
        total[a] += c
    seen = Counter(pairs.values())
    d = seen[1] / (seen[1] + 2 * seen[2])
    n, v = sum(count.values()), len(count)

    def p(a, w):
        plain = (count[w] + 0.5) / (n + 0.5 * (v + 1))
        return max(pairs[a, w] - d, 0) / total[a] + d * kinds[a] / total[a] * plain if total[a] else plain

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        got = {x["doc_id"]: x["score"] for x in language_model.language_model(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, t in tokens.items():
        assert got[i] == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip(["START", *t], t)), abs=len(t) / language_model.STEPS), i
