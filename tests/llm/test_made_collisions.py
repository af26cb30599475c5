"""Words that are made to collide under a known key stay apart, as each run has a key of its own."""

import numpy as np
import pytest

from paddock.llm import language_model, near_dedup, textnum


def colliding_words(key):
    """Two words of sixteen letters whose hashes by ``key`` are equal: the second half of one is chosen so that it undoes
    the difference of the first halves."""
    rng, step = np.random.default_rng(1), textnum._STEP
    start = textnum.mix(np.array([16], np.uint64) * step + np.uint64(key))
    letters = np.array([c for c in range(0x21, 0x7F) if not 65 <= c <= 90], np.uint8)
    while True:
        a, other, b = (rng.choice(letters, (200_000, 8)).view("<u8").ravel() for _ in range(3))
        c = b ^ textnum.mix((start ^ a) + step) ^ textnum.mix((start ^ other) + step)
        good = np.isin(c.view(np.uint8).reshape(-1, 8), letters).all(1)
        if good.any():
            i = int(np.flatnonzero(good)[0])
            return tuple(np.array(x, "<u8").tobytes().decode() for x in ((a[i], b[i]), (other[i], c[i])))


def hashes(words, key):
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return textnum.word_hashes(data, np.array([0, len(data)]), key)[0].tolist()


@pytest.mark.parametrize("key", [textnum.KEY, 0, 12345])
def test_words_that_collide_by_a_known_key_stay_apart(spark, key):
    one, two = colliding_words(key)
    assert one != two and len(set(hashes([one, two], key))) == 1 and len(set(hashes([one, two], textnum.new_key()))) == 2
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert sorted((r["_id"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(docs, k=2).collect()) == [(1, 1, True), (2, 2, True)]
    model = language_model.train(docs.select("text"))
    assert model.tokens == 4 and model.sizes[0] == 3
    counted = language_model.score(docs, model).orderBy("doc_id").collect()
    assert [r["base_score"] for r in counted] == pytest.approx([np.log10(1.5 / 6) + np.log10(2.5 / 6)] * 2)


def test_repeated_rows_keep_one_by_a_rule_and_clashing_names_stay(spark, tmp_path):
    import corpus_pipeline as P

    text = "one two three four five six seven eight nine ten eleven"
    rows = [(1, text, "b", 9), (1, text, "a", 9), (1, text, None, 9), (2, None, "z", 1), (2, "", "y", 2), (3, "other words stand here alone and nowhere else", "q", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _same string, _k int")
    for parts in (1, 4):
        got = sorted(map(tuple, P.near_stage(spark, docs.repartition(parts), str(tmp_path)).collect()))
        assert [(r[0], r[2], r[3]) for r in got] == [(1, "a", 9), (2, "y", 2), (3, "q", 5)] and P.near_stage(spark, docs, str(tmp_path)).columns == docs.columns
