"""Phrase and proximity matches of the inverted index against a look at every position."""

import random
from collections import Counter

import pytest

from paddock.llm import decontam


def brute(docs, items, window):
    wins = {}
    for i, t in items:
        w = t.split()
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[s : s + window]), set()).add(i)
    count = Counter(x for _, t in docs for x in t.split())
    out = {}
    for d, t in docs:
        w, hit, exact, near = t.split(), set(), set(), set()
        for terms, ids in wins.items():
            rarest = min((count[x], x, o) for o, x in enumerate(terms))
            for p, x in enumerate(w):
                if tuple(w[p : p + len(terms)]) == terms:
                    hit.update(range(p, p + len(terms)))
                    exact |= ids
                if x == rarest[1] and set(terms) <= set(w[max(0, p - window + 1) : p + window]):
                    near |= ids
        out[d] = (len(w), len(hit), ",".join(sorted(map(str, exact))), len(near))
    return out


@pytest.mark.parametrize("window, bound", [(10, 200_000), (4, 200_000), (1, 200_000), (4, 0)])
def test_matches_equal_brute_force(spark, monkeypatch, window, bound):
    monkeypatch.setattr(decontam, "MAX_BROADCAST_ROWS", bound)
    monkeypatch.setattr(decontam, "MAX_BROADCAST_DOCS", bound)
    r = random.Random(window)
    words = lambda n: [r.choice("abcdefgh") if r.random() < 0.4 else f"{r.choice('xyz')}{r.randrange(12)}" for _ in range(n)]
    items = [(i, " ".join(words(r.choice([1, 2, 3, 8, 14])))) for i in range(25)] + [(30, "a a a a a"), (31, "a"), (32, "never seen"), (33, "")]
    docs = []
    for i in range(40):
        w = words(r.choice([0, 1, 5, 40, 200]))
        for _ in range(3):
            part = r.choice(items)[1].split()
            if r.random() < 0.4:
                r.shuffle(part)
            at = r.randrange(len(w) + 1)
            w[at:at] = part
        docs.append((i, " ".join(w)))
    docs.append((99, " ".join(words(20_000))))
    got = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), window=window).collect()
    assert {x["_id"]: (x["n_words"], x["n_hit"], ",".join(x["items"]), x["n_near"]) for x in got} == brute(docs, items, window)
