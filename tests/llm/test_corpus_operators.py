"""Corpus operators against brute force on small tables that hold nulls, empty and long texts, ties,
repeated rows and extra columns with clashing names."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from paddock.llm import bpe, decontam, exact_dedup, language_model, line_dedup, near_dedup, quality, token_files, toxicity, warc

SCHEMA = "doc_id long, text string, _id string, _k int, _t string, kept string, n long"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SPACED, PLAIN = re.compile(rb"[^\x20\x09-\x0D]+"), re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED):
    return pattern.findall((text or "").encode().translate(LOWER))


def texts():
    r = random.Random(5)
    vocabulary = ["the", "Die", "über", "çan", "and", "x1", "runs,", "far.", "Éa", "Zoo", "kilo", "mango", "nest", "opal"]
    out = [" ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 12, 40, 90]))) for _ in range(60)]
    base = out[4] = " ".join(r.choice(vocabulary) + str(r.randrange(50)) for _ in range(80))
    for _ in range(8):
        w = base.split(" ")
        w[r.randrange(80)] = "other"
        out.append(" ".join(w))
    out += [None, "", "   ", "\n\n", out[3], out[3], out[3], "A  b\tC", "a b c", "lone", "LONE", "a" * 5000, "Head\n same line \nTail", "naïve ﬁne İx 中文 text", "'s don't we'll  \n\t12 34a"]
    out += [f"Start {i}\n  Shared Line \n\nEnd {i}" for i in range(11)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, "y", "z", 2) for i, t in enumerate(texts())]
    rows += [rows[5], (None, "the and", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, rows, empty):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    want = Counter()
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids, default=None)
        want[i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()] += 1
    for size, depth in ((1_000_000, 16), (2, 6)):
        assert Counter(map(tuple, exact_dedup.exact_dedup(docs, bucket_rows=size, max_depth=depth).collect())) == want
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_directory_doubles_until_buckets_fit():
    histogram = {i: 1 for i in range(8)} | {8: 50}
    depth, slots = exact_dedup.build_directory(histogram, 4, 3)
    assert depth == 4 and len(slots) == 16 and [s for s, _, _ in slots] == list(range(16))
    held = Counter(bucket for _, bucket, _ in {(s >> (depth - d), b, d) for s, b, d in slots})
    assert all(n == 1 for n in held.values())
    assert exact_dedup.build_directory({}, 4, 3) == (0, [(0, 0, 0)])


@pytest.mark.parametrize("keep", ["none", "first"])
def test_line_dedup(docs, rows, empty, keep):
    key = lambda x: x.strip(" \t\n\x0b\f\r").encode().translate(LOWER)
    distinct = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    found = Counter(k for _, t in distinct for k in {key(x) for x in (t or "").split("\n")} if k)
    first = {}
    for r in distinct:
        for p, x in enumerate((r[1] or "").split("\n")):
            first.setdefault(key(x), (r[0], r[1] or "", p))
    want = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        stays = [not (key(x) and found[key(x)] >= 10) or (keep == "first" and first[key(x)] == (i, t or "", p)) for p, x in enumerate(lines)]
        want[i, "\n".join(x for x, s in zip(lines, stays) if s), len(lines), stays.count(False)] += 1
    out = line_dedup.apply_bitmaps(docs, line_dedup.line_bitmaps(docs, keep=keep))
    assert Counter((r["row"]["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in out.collect()) == want
    assert out.schema["row"].dataType.names == docs.columns
    assert line_dedup.apply_bitmaps(empty, line_dedup.line_bitmaps(empty, keep=keep)).count() == 0


def test_decontaminate(spark, docs, rows, empty):
    t = texts()
    items = [(1, t[4]), (2, " ".join(t[3].split()[:5])), (3, None), (4, ""), (10, t[3] or "x"), (10, "LONE"), (5, "nothing at all of this kind is anywhere in here ever"), (None, "mango nest")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = [(i, w[s : s + 10]) for i, x in items if (w := words(x, PLAIN)) for s in range(max(1, len(w) - 9))]
    want = Counter()
    for i, x in rows:
        w, hit, found = words(x, PLAIN), set(), set()
        for item, p in windows:
            for s in range(len(w) - len(p) + 1):
                if w[s : s + len(p)] == p:
                    hit.update(range(s, s + len(p)))
                    found.add(item)
        want[i, len(w), len(hit), ",".join(sorted(str(x) for x in found if x is not None))] += 1
    out = decontam.decontaminate(docs, bench).collect()
    assert Counter((r["_id"], r["n_words"], r["n_hit"], ",".join(r["items"])) for r in out) == want
    assert decontam.decontaminate(empty, bench).count() == 0
    assert {r["n_hit"] for r in decontam.decontaminate(docs, bench.limit(0)).collect()} == {0}


def test_proximity_finds_scattered_terms(spark):
    d = spark.createDataFrame([(1, "red and blue or green"), (2, "red blue"), (3, "green x x x x x x x x x x x red blue")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "green red blue")], "item_id long, text string")
    windows = decontam.test_windows(bench)
    vocabulary = decontam.vocabulary_of(windows)
    postings = decontam.build_postings(decontam.doc_words(d, "doc_id", "text"), vocabulary)
    found = decontam.matches(postings, decontam.ordered_windows(postings, windows, vocabulary)).collect()
    assert {r["_id"] for r in found} == {1}
    assert not any(r["exact"] for r in found)


@pytest.mark.parametrize("k", [2, 5])
def test_near_dedup(docs, rows, empty, k, monkeypatch):
    monkeypatch.setattr(near_dedup, "FEW", 2)
    distinct = list(dict.fromkeys(rows))
    sets = []
    for _, t in distinct:
        w = words(t)
        sets.append({tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(distinct):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    want = Counter()
    for r in rows:
        i = distinct.index(r)
        c = least.get(root(i)) if sets[i] else r[0]
        want[r[0], len(sets[i]), c, r[0] == c] += 1
    out = near_dedup.near_dedup(docs, k=k).collect()
    assert Counter((r["_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == want
    assert near_dedup.near_dedup(empty, k=k).count() == 0


def test_estimates_are_close():
    import numpy as np

    r = np.random.default_rng(3)
    for share in (0.5, 0.8, 0.95):
        both = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
        n = int(4000 * share)
        a, b = np.sort(both[: n + (4000 - n) // 2]), np.sort(np.concatenate((both[:n], both[n + (4000 - n) // 2 :])))
        a, b = a << np.uint64(1), b << np.uint64(1)
        exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = near_dedup.sketch(np.concatenate((a, b)), np.array([len(a), len(b)]))
        assert abs(float(near_dedup.estimate(s[:1], s[1:])[0]) - exact) < 0.12


def test_bpe_equals_the_library(docs, rows, empty, tmp_path):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids)] += 1
    out = bpe.encode_documents(docs, path, pattern).collect()
    assert Counter((*tuple(r)[:4], tuple(r["ids"])) for r in out) == want
    assert bpe.encode_documents(empty, path, pattern).count() == 0
    r = random.Random(1)
    c = bpe.codec(path, pattern)
    for n in (1, 2, 3, 10, 63, 64, 65, 300, 5000):
        for alphabet in ("a", "ab", "the ", "é中-=", "0123"):
            t = "".join(r.choice(alphabet) for _ in range(n))
            assert c.encode([t])[0].tolist() == library.encode_ordinary(t)
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 300, b"abc": 299, b"cb": 260, b"bcb": 259}
    tiny = tmp_path / "tiny"
    tiny.write_text("".join(f"{base64.b64encode(k).decode()} {v}\n" for k, v in ranks.items()))
    own = bpe.Codec(str(tiny), public.PATTERN)
    small = tiktoken.Encoding("tiny", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in ("bcbc", "abcbcb", "cbcbcbabc", "xbcbcbcb" * 20):
        assert own.encode([t])[0].tolist() == small.encode_ordinary(t)


def test_token_files(docs, rows, empty, tmp_path, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    path = token_files.default_tokenizer()
    library = tokenizers.Tokenizer.from_file(path)
    ids = sorted(((i, t or "", library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    start, want = 0, []
    for i, _, x in ids:
        want.append((i, start, len(x), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in x))))
        start += len(x)
    manifest = token_files.write_shards(docs, str(tmp_path / "t"), path, shard_ids=400, min_count=4).cache()
    assert manifest.count() > 3
    assert sorted(map(tuple, token_files.read_shards(manifest).collect()), key=lambda r: r[1]) == want
    assert token_files.read_shards(token_files.write_shards(empty, str(tmp_path / "e"), path)).count() == 0


def test_grammar_round_trip_and_random_access():
    import numpy as np

    r = np.random.default_rng(2)
    phrase = r.integers(0, 900, 30)
    lists = [np.concatenate([phrase if r.random() < 0.5 else r.integers(0, 900, 5) for _ in range(n)] + [[1]]).astype(np.uint32) for n in (0, 1, 5, 50, 200)]
    lists.append(np.full(999, 7, np.uint32))
    shard = token_files.Shard(token_files.pack_shard([5, None, 7, 8, 9, -3], lists, 1000, min_count=4))
    assert shard.base == 1000 and len(shard.size) > 1000 and len(shard.seq) < sum(map(len, lists)) / 3
    for i, x in enumerate(lists):
        assert shard.document(i).tolist() == x.tolist()
        for _ in range(20):
            a = int(r.integers(0, len(x)))
            n = int(r.integers(1, len(x) - a + 1))
            assert shard.document(i, a, n).tolist() == x[a : a + n].tolist()


def test_warc_round_trip(spark, tmp_path):
    long = "<p>" + "x" * 200 + "</p>"
    pages = [(1, "http://a/1", long), (2, "http://a/2\r\nX: y", long), (3, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "é" * 60), (9, "u", "é" * 60), (9, "u", long + "é\r\n\r\nWARC/1.1"), (None, "u", "z" * 500)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    groups = {}
    for i, _, h in pages:
        groups.setdefault(h or "", []).append(i)
    want = Counter()
    for i, _, h in pages:
        data = (h or "").encode()
        first = min((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(data) >= 100 and len(groups[h or ""]) > 1 and i != first
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    got = warc.read_archives(warc.archive(df, str(tmp_path / "w"))).drop("path", "at")
    assert Counter(map(tuple, got.collect())) == want
    assert warc.read_archives(warc.archive(df.limit(0), str(tmp_path / "none"))).count() == 0
    import zstandard

    samples = [(f"<html><head><title>page {i}</title></head><body>" + "common text " * (i % 9 + 3)).encode() for i in range(400)]
    known = zstandard.train_dictionary(4096, samples).as_bytes()
    one = spark.createDataFrame([(i, f"u{i}", s.decode()) for i, s in enumerate(samples)], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.decide(one), str(tmp_path / "d"), known, file_bytes=2000).cache()
    assert manifest.count() > 4 and warc.read_archives(manifest).count() == 400


def test_language_model(docs, rows, empty):
    tokens = [[*words(t), "END"] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    count = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(count.values()), len(count)
    pairs, total = Counter(), Counter()
    for t, h in zip(tokens, held):
        if not h:
            pairs.update(zip(["START", *t], t))
    for (a, _), c in pairs.items():
        total[a] += c
    plain = lambda w: (count[w] + 0.5) / (n + 0.5 * (v + 1))
    out = {}
    for order in (2, 3):
        for r in language_model.language_model(docs, order).collect():
            out.setdefault((order, r["doc_id"]), []).append(r)
    for (i, t), x, h in zip(rows, tokens, held):
        for order in (2, 3):
            r = next(r for r in out[order, i] if i is not None or r["n_tokens"] == len(x))
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, len(x), sum(count[w] > 0 for w in x), n)
            assert r["base_score"] == pytest.approx(sum(math.log10(plain(w)) for w in x), abs=1e-6)
        # the discounts follow from each shard's counts; whatever they are, a seen pair has no less than
        # its count less one, over its context's
        least = sum(math.log10(max((pairs[a, w] - 1) / total[a] if pairs[a, w] > 1 else 0, 1e-12)) for a, w in zip(["START", *x], x))
        assert least - 1e-3 * len(x) <= next(r for r in out[2, i] if i is not None or r["n_tokens"] == len(x))["score"] <= 1e-6
    learnt = [r for (order, _), rs in out.items() for r in rs if order == 2 and not r["held_out"]]
    assert sum(r["score"] for r in learnt) > sum(r["base_score"] for r in learnt)
    assert language_model.language_model(empty).count() == 0


def test_elias_fano():
    import numpy as np

    from paddock.llm.eliasfano import EliasFano, encode

    r = np.random.default_rng(1)
    for n, u in ((0, 5), (1, 1), (1, 1000), (1000, 1001), (1000, 1 << 40), (3000, 3000), (2000, 1 << 62)):
        values = np.sort(r.integers(0, u, n))
        e = EliasFano(encode(values, u))
        assert (e.get(np.arange(n)) == values).all()
        ask = np.concatenate((r.integers(0, u, 500), values))
        place = e.find(ask)
        known = np.isin(ask, values)
        assert (place[~known] == -1).all() and (values[place[known]] == ask[known]).all()


def test_level_probabilities_sum_to_one():
    """Shares of a context's successors and the weight of the shorter context make one."""
    import numpy as np

    context = np.array([3, 3, 3, 5, 9, 9])
    word = np.array([0, 2, 7, 7, 1, 8])
    count = np.array([1, 2, 5, 1, 300, 1])
    shard = language_model.Successors(language_model._write_level(3, 8, 10, context, word, count))
    place = shard.lookup(context - 3, word)
    assert place.tolist() == list(range(6))
    share = 10.0 ** (-shard.share.astype(float) / language_model.STEPS)
    rest = 10.0 ** (-shard.rest.astype(float) / language_model.STEPS)
    for c in (3, 5, 9):
        assert share[context == c].sum() + rest[c - 3] == pytest.approx(1, abs=2e-3)
    every = np.array([(c, w) for c in range(8) for w in range(10)])
    known = {(c - 3, w) for c, w in zip(context.tolist(), word.tolist())}
    assert [p >= 0 for p in shard.lookup(every[:, 0], every[:, 1])] == [tuple(x) in known for x in every.tolist()]


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(8)
    out, labels = [], []
    for i in range(600):
        bad, junk = r.random() < 0.2, r.random() < 0.25
        w = [r.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(r.randrange(30)) for _ in range(40)]
        if bad:
            w[r.randrange(40)] = "vile"
        out.append((i, " ".join(x.upper() + "!!" if junk else x for x in w), 5.0, "t"))
        labels.append((i, 0 if junk else 1, int(bad)))
    out += [(None, None, None, None), (700, "", 1.0, None)]
    labels += [(None, None, None), (700, None, None)]
    return spark.createDataFrame(out, "doc_id long, text string, tail double, row string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_is_learnt(labelled, empty):
    docs, labels = labelled
    out = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    held = [i for i in truth if out[i]["held_out"]]
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    assert sum(out[i]["predicted"] == truth[i] for i in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out.values()) and len(out) == 602
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_is_learnt(labelled, spark, empty):
    docs, labels = labelled
    scored = quality.score(docs, quality.train(docs, labels))
    out = {r["row"]["doc_id"]: r for r in scored.collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    assert sum((out[i]["tail"] >= 0.5) == truth[i] for i in truth) / len(truth) > 0.97
    assert scored.schema["row"].dataType.names == docs.columns
    graded = labels.where("quality is not null").selectExpr("doc_id", "quality * 2 + cast(toxic = 0 as int) as quality")
    model = quality.train(docs, graded)
    assert len(model.thresholds) == 3 and model.thresholds == sorted(model.thresholds)
    expected = {r["row"]["doc_id"]: r["expected_grade"] for r in quality.score(docs, model).collect()}
    mean = lambda g: sum(expected[i] for i in truth if truth[i] == g) / sum(truth[i] == g for i in truth)
    assert mean(1) > mean(0) + 1
    assert quality.score(docs, quality.train(docs, labels.limit(0))).count() == 602
    assert quality.score(empty, quality.train(empty, labels)).count() == 0
