"""Near duplicates on every path through a bucket, with ids of other types and words made to collide."""

import random
from collections import Counter

import pytest

from paddock.llm import language_model, near_dedup, textnum


def components(texts: dict, k: int) -> dict:
    sets = {}
    for i, t in texts.items():
        w = t.lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    label = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if label[a] != label[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def corpus() -> dict:
    """Texts that share a long passage and differ in the rest, chains whose ends are unlike, copies."""
    r = random.Random(12)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passage, texts = words(80), {}
    for i in range(60):
        texts[i] = " ".join(passage + words(40))
    link = passage + words(60)
    for i in range(60, 90):
        link = list(link)
        for _ in range(3):
            link[r.randrange(len(link))] = f"x{r.randrange(10**6)}"
        texts[i] = " ".join(link)
    for i in range(90, 96):
        texts[i] = texts[i - 60].upper()
    return texts


@pytest.mark.parametrize("few, many, block, stream", [(16, 8192, 1024, 8192), (0, 10**6, 4, 6), (0, 3, 4, 8192), (2, 5, 3, 4)])
def test_every_path_gives_the_components(spark, monkeypatch, few, many, block, stream):
    for name, value in (("FEW", few), ("MANY", many), ("BLOCK", block), ("STREAM", stream)):
        monkeypatch.setattr(near_dedup, name, value)
    texts = corpus()
    docs = spark.createDataFrame(sorted(texts.items()), "doc_id long, text string").repartition(3)
    got = {r["_id"]: r["component_id"] for r in near_dedup.near_dedup(docs, k=2).collect()}
    assert got == components(texts, 2)


def test_blocks_write_fewer_links_than_members(spark):
    """One bucket of 300 near copies: all pairs would be 44,850."""
    r = random.Random(3)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    texts = []
    for i in range(300):
        w = list(base)
        w[i % 200] = f"own{i}"
        texts.append((i, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = near_dedup.fingerprints(docs, 2, "doc_id", "text").collect()
    sets = spark.createDataFrame([(r["_id"], str(r["_id"]), r["_k"]) for r in rows], "c long, _i string, _k long")
    members = spark.createDataFrame([(1, i, i, 0, 299, 300) for i in range(300)], "b long, c long, label long, main long, outside long, total long")
    links = near_dedup.links_in_blocks(members, sets, docs, 2, 80, "doc_id", "text").collect()
    assert 299 <= len(links) < 600
    reached = {0}
    for _ in range(300):
        reached |= {v for x, y in links for v in (x, y) if x in reached or y in reached}
    assert len(reached) == 300


def test_ids_of_other_types_nulls_and_repeated_rows(spark):
    t = "one two three four five six seven eight nine ten eleven twelve"
    rows = [("b", t), ("a", t), ("a", t), ("c", "other words entirely"), ("", None), (None, "lone null"), (None, "lone null"), (None, t + " thirteen")]
    out = Counter((r["_id"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id string, text string"), k=2).collect())
    assert out == Counter({("b", "a", False): 1, ("a", "a", True): 2, ("c", "c", True): 1, ("", "", True): 1, (None, None, True): 2, (None, "a", False): 1})


def test_words_of_equal_letter_sums_stay_apart(spark):
    a = "a"
    for _ in range(10):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, a), (2, b), (3, a.upper())], "doc_id long, text string")
    assert {r["_id"]: r["component_id"] for r in near_dedup.near_dedup(docs, k=2).collect()} == {1: 1, 2: 2, 3: 1}
    one = {r["doc_id"]: r for r in language_model.language_model(docs, 1).collect()}
    held = [i for i in one if one[i]["held_out"]]
    learnt = {a if i != 2 else b for i in one if i not in held}
    assert all(one[i]["n_known"] == 1 + ((b if i == 2 else a) in learnt) for i in one)


def test_hashes_tell_apart_what_differs():
    import numpy as np
    import pyarrow as pa

    r = random.Random(5)
    words = {"".join(r.choice("abé") for _ in range(n)) for n in range(1, 300) for _ in range(8)} | {"a" * n for n in range(1, 400)} | {"\x00" * n for n in range(1, 40)}
    data, offsets = textnum.text_bytes(pa.array([" ".join(sorted(words))]))
    hashes, counts = textnum.word_hashes(data, offsets)
    assert counts.tolist() == [len(words)] and len(np.unique(hashes)) == len(words)
