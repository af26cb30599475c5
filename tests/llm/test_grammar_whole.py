"""Re-Pair leaves no frequent pair, however few of them a round replaces."""

import pytest

pytest.importorskip("tokenizers")

import numpy as np  # noqa: E402

from paddock.llm import token_files  # noqa: E402


def expand(seq, rules, base):
    known = {}
    for i, (a, b) in enumerate(rules.tolist(), base):
        known[i] = known.get(a, [a]) + known.get(b, [b])
    return [x for s in seq.tolist() for x in known.get(s, [s])]


def most(seq, last):
    key = seq[:-1].astype(np.uint64) << np.uint64(32) | seq[1:]
    return int(np.unique(key[~last[:-1]], return_counts=True)[1].max(initial=0))


def test_pairs_of_32_are_frequent():
    ids = np.random.default_rng(3).permutation(50_000)[:20_000].astype(np.uint32)
    ids[1000:1080] = [60_000, 60_001] * 40  # fewer than one id in two hundred
    seq, last, rules = token_files.repair(ids, np.arange(len(ids)) == len(ids) - 1, 70_000)
    assert len(rules) and most(seq, last) < 32 and expand(seq, rules, 70_000) == ids.tolist()


@pytest.mark.parametrize("count", [2, 3, 32])
def test_no_frequent_pair_is_left(count):
    r = np.random.default_rng(count)
    ids = (r.zipf(1.2, 300_000) % 40_000).astype(np.uint32)
    ends = r.random(len(ids)) < 0.01
    ends[-1] = True
    seq, last, rules = token_files.repair(ids, ends, 40_000, count)
    assert len(rules) and most(seq, last) < count and expand(seq, rules, 40_000) == ids.tolist()


def test_frequent_pair_hidden_by_rarer_ones_of_its_slot(monkeypatch):
    """All pairs in one slot of the hash: only the sort finds the frequent one."""
    bincount = np.bincount
    ids = np.concatenate([[5, 6, 10_000 + i] for i in range(40)] + [[20_000]]).astype(np.uint32)

    def merged(x, *a, **b):
        if x.max(initial=0) > 1000 and len(x) == len(ids) - 1:
            x[x < 1 << 20] = 7
        return bincount(x, *a, **b)

    monkeypatch.setattr(np, "bincount", merged)
    seq, last, rules = token_files.repair(ids, np.arange(len(ids)) == len(ids) - 1, 30_000, 32)
    assert [5, 6] in rules.tolist() and expand(seq, rules, 30_000) == ids.tolist()

