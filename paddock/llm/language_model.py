"""N-gram language model in an Elias-Fano trie whose levels are memory-mapped shard files.

Level 1 holds the words' hashes, by a key drawn for the model, in ascending order; a word's place is its number. Each further level
holds, for every node of the level above (its context), the numbers of the words that follow: EF
pointers to each context's range, EF successors made monotone by adding the last value of the range before,
and quantised interpolated absolute-discounting probabilities. A lookup is a successor search
relative to the context. Files lie in the shared folder and are mapped, not loaded.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textnum
from .common import shared_dir, shuffle_partitions, stage, table
from .eliasfano import EliasFano, encode
from .labelled import bucket
from .sharedfs import AtomicWriter, read_bytes

#: Levels of the trie in the registered query.
ORDER = 2
#: Tokens that are counted or scored together in a task.
BLOCK_TOKENS = 1_200_000
#: Steps of quantised probabilities in a factor of ten.
STEPS = 4096
KEY_BITS = 63
END = 0x2545F4914F6CDD1D


class Part(NamedTuple):
    """A shard file: the first and the next shard's first key (or context), numbers before it."""

    low: int
    offset: int
    path: str


class Model(NamedTuple):
    levels: list[list[Part]]  # of each level, ascending
    sizes: list[int]  # nodes of each level
    tokens: int
    key: int  # of the words' hashes


def _blocks(batches: Iterator, column: int, key: int):
    """Yield (batch, first row, rows, keys of all tokens, tokens of each row) of some rows: words
    and one end token for each row."""
    for batch in batches:
        data, offsets = textnum.text_bytes(batch.column(column))
        held, first, n, rows = [], 0, 0, 0
        for i, j in textnum.chunks(offsets):
            words, counts = textnum.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], key)
            ends = np.cumsum(counts)
            keys = np.insert(words >> np.uint64(1), ends, np.uint64(END >> 1)).astype(np.int64)
            held.append((keys, counts + 1))
            n, rows = n + len(keys), rows + j - i
            if n >= BLOCK_TOKENS:
                yield batch, first, rows, np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
                held, first, n, rows = [], first + rows, 0, 0
        if held:
            yield batch, first, rows, np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])


class Words:
    """A shard of level 1: sorted keys and counts."""

    def __init__(self, data):
        self.keys = EliasFano(data)
        self.counts = np.frombuffer(data, np.int64, self.keys.n, self.keys.end)


class Successors:
    """A shard of a further level, for contexts from ``low``."""

    def __init__(self, data):
        self.low, self.contexts, self.words = struct.unpack("<QQQ", data[:24])
        self.pointers = EliasFano(data, 24)
        self.values = EliasFano(data, self.pointers.end)
        at = self.values.end
        self.share = np.frombuffer(data, np.uint16, self.values.n, at)
        self.rest = np.frombuffer(data, np.uint16, self.contexts, at + (2 * self.values.n + 7) // 8 * 8)

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of (context, word), -1 where the shard has none. ``context`` counts from ``low``;
        pairs are sorted, so that equal contexts stand together."""
        some = np.flatnonzero(np.diff(context, prepend=-1))
        names = context[some]
        begin, end = self.pointers.get(names), self.pointers.get(names + 1)
        base = np.where(begin > 0, self.values.get(np.maximum(begin - 1, 0)) if self.values.n else 0, 0)
        spread = np.repeat(np.arange(len(some)), np.diff(np.append(some, len(context))))
        begin, end, base = begin[spread], end[spread], base[spread]
        out = np.full(len(context), -1, np.int64)
        ask = np.flatnonzero(begin < end)
        if len(ask):
            top = self.values.get(end[ask] - 1)
            wanted = base[ask] + word[ask] + 1
            ask, wanted = ask[wanted <= top], wanted[wanted <= top]
            place = self.values.find(wanted)
            good = (place >= begin[ask]) & (place < end[ask])
            out[ask[good]] = place[good]
        return out


_open: dict[str, object] = {}


def _shard(part: Part, kind):
    if part.path not in _open:
        if len(_open) > 4096:
            _open.clear()
        _open[part.path] = kind(read_bytes(part.path))
    return _open[part.path]


def _by_part(parts: list[Part], keys: np.ndarray):
    """(part, slice of ``keys``) for sorted keys."""
    cuts = np.searchsorted(keys, [p.low for p in parts[1:]])
    edges = [0, *cuts.tolist(), len(keys)]
    for part, a, b in zip(parts, edges[:-1], edges[1:], strict=True):
        if a < b:
            yield part, slice(a, b)


def word_numbers(parts: list[Part], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, count) of each of the sorted keys; -1 and 0 where unknown."""
    number, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    for part, at in _by_part(parts, keys):
        shard = _shard(part, Words)
        if not shard.keys.n:
            continue
        last = int(shard.keys.get(np.array([shard.keys.n - 1]))[0])
        some = keys[at]
        fit = some <= last
        place = np.full(len(some), -1, np.int64)
        place[fit] = shard.keys.find(some[fit])
        known = place >= 0
        number[at][known] = place[known] + part.offset
        count[at][known] = shard.counts[place[known]]
    return number, count


def node_numbers(parts: list[Part], context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, share, rest) of sorted pairs of known numbers: the node's number or -1, the discounted
    share of the word in its context (0 if unseen), and the weight of the shorter context."""
    node, share, rest = np.full(len(context), -1, np.int64), np.zeros(len(context)), np.ones(len(context))
    for part, at in _by_part(parts, context):
        shard = _shard(part, Successors)
        local = context[at] - shard.low
        place = shard.lookup(local, word[at])
        known = place >= 0
        node[at][known] = place[known] + part.offset
        share[at][known] = 10.0 ** (-shard.share[place[known]].astype(np.float64) / STEPS)
        rest[at] = 10.0 ** (-shard.rest[local].astype(np.float64) / STEPS)
    return node, share, rest


def _contexts(model: Model, tokens: np.ndarray, counts: np.ndarray, order: int):
    """Context node of each token at level ``order``: that of the word before for 2, of the two before
    for 3. -1: unknown; the text's start is a word of its own, numbered after all others."""
    before = np.empty(len(tokens), np.int64)
    before[1:] = tokens[:-1]
    starts = np.cumsum(counts) - counts
    before[starts] = model.sizes[0]
    if order == 2:
        return before
    above = _contexts(model, tokens, counts, order - 1)
    node = np.full(len(tokens), -1, np.int64)
    previous = np.full(len(tokens), -1, np.int64)
    previous[1:] = above[:-1]
    previous[starts] = -1
    good = np.flatnonzero((previous >= 0) & (before >= 0) & (before < model.sizes[0]))
    pairs, where = _pairs(previous[good], before[good], model.sizes[0])
    found, _, _ = node_numbers(model.levels[order - 2], *pairs)
    node[good] = found[where]
    return node


def _pairs(context: np.ndarray, word: np.ndarray, words: int):
    """((contexts, words) of the distinct pairs in order, place of each pair among them)."""
    width = int(words).bit_length()
    if len(context) and int(context.max()).bit_length() + width > 63:
        raise ValueError("more contexts and words than 63 bits can name")
    key, where = np.unique(context << width | word, return_inverse=True)
    return (key >> width, key & ((1 << width) - 1)), where


def _encode_counts(context: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted pairs and their counts, compactly: contexts once, counts of 255 and more apart."""
    head = np.flatnonzero(np.diff(context, prepend=-1))
    size = np.diff(np.append(head, len(context)))
    large = count >= 255
    arrays = [np.diff(context[head], prepend=0).astype("<u8" if len(head) and context[-1] >> 32 else "<u4"), size.astype("<u4"), word.astype("<u4"), np.minimum(count, 255).astype("u1"), count[large].astype("<u8")]
    return struct.pack("<QQQB", len(head), len(context), int(large.sum()), arrays[0].itemsize) + b"".join(a.tobytes() for a in arrays)


def _decode_counts(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    heads, n, large, width = struct.unpack("<QQQB", data[:25])
    at, out = 25, []
    for kind, size in ((f"<u{width}", heads), ("<u4", heads), ("<u4", n), ("u1", n), ("<u8", large)):
        out.append(np.frombuffer(data, kind, size, at).astype(np.int64))
        at += out[-1].size * np.dtype(kind).itemsize
    count = out[3]
    count[count == 255] = out[4]
    return np.repeat(np.cumsum(out[0]), out[1]), out[2], count


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-np.log10(np.maximum(p, 1e-15)) * STEPS), 0, 65535).astype(np.uint16)


def _discount(once: int, twice: int) -> float:
    """A level's absolute discount, from how many of all its pairs were seen once and twice."""
    return once / (once + 2 * twice) if once and twice else 0.5


def _write_level(low: int, contexts: int, words: int, context: np.ndarray, word: np.ndarray, count: np.ndarray, discount: float | None = None) -> bytes:
    """A shard of a level. Without ``discount`` the shard is the whole level."""
    if discount is None:
        discount = _discount(int((count == 1).sum()), int((count == 2).sum()))
    local = context - low
    total = np.bincount(local, weights=count, minlength=contexts)
    kinds = np.bincount(local, minlength=contexts)
    share = (count - discount) / np.maximum(total[local], 1)
    rest = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
    pointers = np.concatenate(([0], np.cumsum(kinds)))
    last = np.flatnonzero(np.diff(local, append=contexts + 1))  # of each context that has successors
    base = np.concatenate(([0], np.cumsum(word[last] + 1)[:-1])) if len(last) else np.zeros(0, np.int64)
    values = word + 1 + np.repeat(base, np.diff(np.concatenate(([-1], last))))
    shares = _quantise(share).tobytes()
    shares += bytes(-len(shares) % 8)
    return struct.pack("<QQQ", low, contexts, words) + encode(pointers, len(word) + 1) + encode(values, int(values[-1]) + 1 if len(values) else 1) + shares + _quantise(rest).tobytes()


def _write_words(keys: np.ndarray, counts: np.ndarray) -> bytes:
    return encode(keys, int(keys[-1]) + 1) + counts.astype("<i8").tobytes()


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Count all tokens of ``texts`` (one column) and write the trie, level by level."""
    spark = texts.sparkSession
    folder, shards, word_key = shared_dir(spark, "lm"), shuffle_partitions(spark), textnum.new_key()

    def unigrams(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for _, _, _, keys, _ in _blocks(batches, 0, word_key):
            key, count = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count.astype(np.int64))], ["w", "n"])

    def write_words(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if held:
            keys, counts = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            path = f"{folder}/level1-{TaskContext.get().partitionId():05d}-{TaskContext.get().taskAttemptId()}"
            with AtomicWriter(path) as out:
                out.write(_write_words(keys, counts))
            yield pa.RecordBatch.from_pydict({"low": [int(keys[0])], "n": [len(keys)], "tokens": [int(counts.sum())], "path": [path]})

    counted = texts.mapInArrow(unigrams, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    manifest = stage(stage(counted, "lm-words").repartitionByRange(shards, "w").sortWithinPartitions("w").mapInArrow(write_words, "low long, n long, tokens long, path string"), "lm-level")
    levels, sizes, tokens = [], [], 0
    parts, total = _parts(manifest)
    tokens = sum(r["tokens"] for r in manifest.select("tokens").collect())
    levels.append(parts)
    sizes.append(total)
    for k in range(2, order + 1):
        model = Model(levels, sizes, tokens, word_key)
        contexts = sizes[k - 2] + (k == 2)
        levels, sizes = [*levels], [*sizes]
        parts, total = _parts(_train_level(texts, model, k, contexts, folder, shards))
        levels.append(parts)
        sizes.append(total)
    return Model(levels, sizes, tokens, word_key)


def _parts(manifest: DataFrame) -> tuple[list[Part], int]:
    """Shard files in order (as many as there are partitions) and their nodes together."""
    parts, total = [], 0
    for row in manifest.select("low", "n", "path").orderBy("low").collect():
        parts.append(Part(row["low"], total, row["path"]))
        total += row["n"]
    return parts, total


def _train_level(texts: DataFrame, model: Model, k: int, contexts: int, folder: str, shards: int) -> DataFrame:
    words = model.sizes[0]
    span = -(-max(contexts, 1) // shards)  # contexts of a shard

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for _, _, _, keys, counts in _blocks(batches, 0, model.key):
            distinct, where = np.unique(keys, return_inverse=True)
            tokens = word_numbers(model.levels[0], distinct)[0][where]
            context = _contexts(model, tokens, counts, k)
            good = context >= 0
            width = int(words).bit_length()
            (c, w), n = _counted(context[good] << width | tokens[good], width)
            cuts = np.searchsorted(c, np.arange(1, shards) * span)
            edges = [0, *cuts.tolist(), len(c)]
            some = [(s, _encode_counts(c[a:b], w[a:b], n[a:b])) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if a < b]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary())], ["s", "data"])

    def sum_up(batches: Iterator) -> Iterator:
        """A shard's counts in a file of their own, and how many pairs were seen once and twice."""
        import pyarrow as pa
        from pyspark import TaskContext

        held: dict[int, list] = {}
        width = int(words).bit_length()
        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                c, w, n = _decode_counts(data.as_buffer())
                held.setdefault(s, []).append((c << width | w, n))
                if len(held[s]) >= 8:  # what came so far is summed up
                    held[s] = [_summed(held[s])]
        for s in sorted(held):
            key, n = _summed(held.pop(s))
            path = f"{folder}/counts{k}-{s:05d}-{TaskContext.get().taskAttemptId()}"
            with AtomicWriter(path) as out:
                out.write(_encode_counts(key >> width, key & ((1 << width) - 1), n))
            yield pa.RecordBatch.from_pydict({"s": pa.array([s], pa.int32()), "once": [int((n == 1).sum())], "twice": [int((n == 2).sum())], "path": [path]})

    dealt = texts.mapInArrow(count, "s int, data binary").repartition(shards, "s")
    summed = stage(dealt.mapInArrow(sum_up, "s int, once long, twice long, path string"), "lm-counts")
    seen = summed.agg(F.sum("once"), F.sum("twice")).first()
    discount = _discount(seen[0] or 0, seen[1] or 0)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        for batch in batches:
            for s, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c, w, n = _decode_counts(read_bytes(counts))
                low = s * span
                path = f"{folder}/level{k}-{s:05d}-{TaskContext.get().taskAttemptId()}"
                with AtomicWriter(path) as out:
                    out.write(_write_level(low, min(span, contexts - low), words, c, w, n, discount))
                yield pa.RecordBatch.from_pydict({"low": [low], "n": [len(c)], "path": [path]})

    return stage(summed.select("s", "path").repartition(shards, "s").mapInArrow(write, "low long, n long, path string"), "lm-level")


def _counted(key: np.ndarray, width: int):
    key, n = np.unique(key, return_counts=True)
    return (key >> width, key & ((1 << width) - 1)), n


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    head = np.flatnonzero(np.diff(key, prepend=-1))
    return key[head], np.add.reduceat(n, head) if len(head) else n


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score, score of every row over its whole text; null text is empty."""
    order = len(model.levels)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scale = model.tokens + 0.5 * (model.sizes[0] + 1)
        for batch, first, rows, keys, counts in _blocks(batches, 1, model.key):
            distinct, where = np.unique(keys, return_inverse=True)
            number, count = word_numbers(model.levels[0], distinct)
            owner = np.repeat(np.arange(rows), counts)
            plain = ((count + 0.5) / scale)[where]
            tokens, p = number[where], plain.copy()
            for k in range(2, order + 1):
                context = _contexts(model, tokens, counts, k)
                good = np.flatnonzero(context >= 0)
                word = tokens[good]
                pairs, at = _pairs(context[good], np.where(word >= 0, word, model.sizes[0]), model.sizes[0] + 1)
                _, share, rest = node_numbers(model.levels[k - 1], *pairs)
                p[good] = share[at] + rest[at] * p[good]
            sums = [np.bincount(owner, weights=x, minlength=rows) for x in (count[where] > 0, np.log10(plain), np.log10(p))]
            part = batch.slice(first, rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts.astype(np.int64)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], [id_col, "n_tokens", "n_known", "base_score", "score"])

    texts = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"))
    return texts.mapInArrow(run, f"`{id_col}` {texts.schema[id_col].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")


def language_model(docs: DataFrame, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows whose id's crc32 (as text) modulo 5 isn't 1 (null ids are learnt from) and
    score every row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Each row is a text and has an end token, also null or empty; repeated rows count repeatedly. If there is
    nothing to learn from, every token is unknown."""
    learn = docs.where(bucket(F.col(id_col), 5) != 1).select(F.col(text_col).cast("string").alias("_t"))
    model = train(learn, order)
    out = score(docs, model, id_col, text_col)
    return out.select(id_col, (bucket(F.col(id_col), 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return language_model(table(spark, sf_dir, "documents"))
