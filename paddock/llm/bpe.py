"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Merges wait in buckets, one for each merge rank, that hold positions in a linked list of symbols.
A bitmap of bitmaps marks the buckets that hold something; find-first-set gives the lowest rank.
Entries whose pair has changed meanwhile are stale and skipped. A pre-token of n bytes takes
O(n) queue steps however long it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_slices

#: Distinct pre-tokens that a Python worker remembers; beyond it the memory starts anew.
CACHE_ENTRIES = 300_000
#: Bytes of text that a worker encodes before it hands the rows on; a longer text is taken in pieces.
STEP_BYTES = 2 << 20
#: New pre-tokens that are encoded together, which bounds the arrays of their queue.
STEP_TOKENS = 100_000
#: Pre-tokens up to so many bytes share one queue; each longer one has the queue to itself and
#: isn't remembered.
SHORT_BYTES = 64


class RankQueue:
    """The queue of one vocabulary, empty between pre-tokens.

    ``buckets``: rank -> heap of positions. ``low`` has a bit for each rank, ``mid`` one for each
    word of ``low``; ``merge`` holds the top, one bit for each word of ``mid``, as an integer of
    any width, so that the number of ranks has no bound."""

    __slots__ = ("buckets", "low", "mid")

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """Ids of one pre-token: of all pairs that are in the vocabulary the one of lowest rank merges
    first, the leftmost among equals."""
    rank_of = ranks.get
    if (whole := rank_of(piece)) is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # where the symbol that starts here ends; 0: merged into another
    before = list(range(-1, n))  # start of the symbol before
    buckets, low, mid, top = queue.buckets, queue.low, queue.mid, 0
    fresh = [(r, i) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
    while True:
        for r, i in fresh:
            held = buckets.get(r)
            if held is not None:
                heappush(held, i)
                continue
            buckets[r] = [i]
            w = r >> 6
            bits = low[w]
            low[w] = bits | 1 << (r & 63)
            if not bits:
                v = w >> 6
                bits = mid[v]
                mid[v] = bits | 1 << (w & 63)
                if not bits:
                    top |= 1 << v
        if not top:
            break
        v = (top & -top).bit_length() - 1  # find the first set bit, three levels down
        bits = mid[v]
        w = v << 6 | (bits & -bits).bit_length() - 1
        bits = low[w]
        rank = w << 6 | (bits & -bits).bit_length() - 1
        held = buckets[rank]
        if len(held) > 1:
            i = heappop(held)
        else:
            i = held[0]
            del buckets[rank]
            bits &= bits - 1
            low[w] = bits
            if not bits:
                mid[v] = bits = mid[v] & mid[v] - 1
                if not bits:
                    top &= top - 1
        fresh = []
        j = end[i]
        if not j or j >= n:
            continue  # stale
        k = end[j]
        if rank_of(piece[i:k]) != rank:
            continue  # stale
        end[i], end[j] = k, 0
        if k < n:
            before[k] = i
            if (r := rank_of(piece[i : end[k]])) is not None:
                fresh.append((r, i))
        h = before[i]
        if h >= 0 and (r := rank_of(piece[h:k])) is not None:
            fresh.append((r, h))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class SharedQueue:
    """One rank queue for many short pre-tokens at once.

    All pre-tokens lie in one linked list with barriers between them. The lowest rank that holds
    positions is taken for all of them together: in each pre-token the leftmost valid position
    merges, any others of that rank wait in the bucket, as a merge may make a pair of lower rank
    that comes first."""

    def __init__(self, ranks: dict[bytes, int]):
        import numpy as np

        self.ranks = ranks
        pairs = sorted((a << 32 | b, r) for word, r in ranks.items() for i in range(1, len(word)) if (a := ranks.get(word[:i])) is not None and (b := ranks.get(word[i:])) is not None)
        self.keys = np.array([k for k, _ in pairs] + [1 << 62], np.int64)
        self.values = np.array([r for _, r in pairs] + [-1], np.int32)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.queue = RankQueue(max(ranks.values()) + 1)

    def pair_ranks(self, left, right):
        import numpy as np

        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], -1)

    def merge(self, pieces: list[bytes]):
        """(ids of all pre-tokens in one array, how many each has)."""
        import numpy as np

        size = np.array([len(x) for x in pieces], np.int64)
        n = int(size.sum())
        if not n:
            return np.zeros(0, np.int64), size
        owner = np.repeat(np.arange(len(pieces)), size)
        symbol = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        ends = np.cumsum(size)
        after[ends - 1] = -1
        before[(ends - size)] = -1
        current = np.full(n, -1, np.int32)  # rank of the pair that starts here
        inner = np.flatnonzero(after >= 0)
        current[inner] = self.pair_ranks(symbol[inner], symbol[inner + 1])
        buckets, low, mid, top = self.queue.buckets, self.queue.low, self.queue.mid, 0
        start = np.flatnonzero(current >= 0)
        order = np.argsort(current[start], kind="stable")
        start = start[order]
        ranks, cuts = np.unique(current[start], return_index=True)
        fresh = [*zip(ranks.tolist(), (x.tolist() for x in np.split(start, cuts[1:])), strict=True)] if len(start) else []
        alive = np.ones(n, bool)
        while True:
            for r, places in fresh:
                held = buckets.get(r)
                if held is not None:
                    held += places
                    continue
                buckets[r] = places
                w = r >> 6
                bits = low[w]
                low[w] = bits | 1 << (r & 63)
                if not bits:
                    v = w >> 6
                    bits = mid[v]
                    mid[v] = bits | 1 << (w & 63)
                    if not bits:
                        top |= 1 << v
            if not top:
                break
            v = (top & -top).bit_length() - 1
            bits = mid[v]
            w = v << 6 | (bits & -bits).bit_length() - 1
            bits = low[w]
            rank = w << 6 | (bits & -bits).bit_length() - 1
            low[w] = bits = bits & bits - 1
            if not bits:
                mid[v] = bits = mid[v] & mid[v] - 1
                if not bits:
                    top &= top - 1
            held = buckets.pop(rank)
            at = np.array(held) if len(held) == 1 else np.unique(held)
            at = at[current[at] == rank]  # the others are stale
            fresh = []
            if len(at) > 1:
                own = owner[at]
                leads = np.ones(len(at), bool)
                np.not_equal(own[1:], own[:-1], out=leads[1:])
                if not leads.all():
                    fresh.append((rank, at[~leads].tolist()))
                    at = at[leads]
            if not len(at):
                continue
            gone = after[at]
            nxt, prev = after[gone], before[at]
            symbol[at] = rank
            after[at] = nxt
            alive[gone] = False
            current[gone] = current[at] = -1
            right, left = nxt >= 0, prev >= 0
            a, b, h = at[right], nxt[right], prev[left]
            before[b] = a
            first, second = np.concatenate((a, h)), np.concatenate((b, at[left]))
            new = self.pair_ranks(symbol[first], symbol[second])
            current[first] = new
            some = new >= 0
            fresh += [(r, [i]) for r, i in zip(new[some].tolist(), first[some].tolist(), strict=True)]
        return symbol[alive], np.bincount(owner[alive], minlength=len(pieces))


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the bytes, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def latin_pattern(pattern: str) -> str | None:
    """The same pattern for texts of code points below 256, in terms of the faster standard
    library; None if it uses more than letters and numbers."""
    letters, numbers = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
    spaces = "\t-\r \x85\xa0"
    out = re.sub(r"\[\^\\s\\p\{L\}\\p\{N\}\]", f"[^{spaces}{letters}{numbers}]", pattern)
    out = out.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]").replace(r"\s", f"[{spaces}]").replace(r"\S", f"[^{spaces}]")
    return None if r"\p" in out else out


class Memory(dict):
    """Pre-token -> its number; new ones are noted in ``pending``."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []
        self.count = 0

    def __missing__(self, token: str) -> int:
        self[token] = n = self.count
        self.count = n + 1
        self.pending.append(token)
        return n


def gather(data, start, size, numbers):
    """The pieces of ``data`` with these numbers, one after the other."""
    import numpy as np

    size = size[numbers]
    where = np.repeat(start[numbers] - (np.cumsum(size) - size), size)
    where += np.arange(len(where))
    return data[where]


class Texts:
    """A table of byte strings by number; ``join`` strings them together for an array of numbers."""

    def __init__(self, texts: list[bytes]):
        import numpy as np

        self.size = np.array([len(x) for x in texts], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def join(self, numbers) -> bytes:
        step = 1 << 16
        return b"".join([gather(self.data, self.start, self.size, numbers[at : at + step]).tobytes() for at in range(0, len(numbers), step)])


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memory of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import numpy as np
        import regex

        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern)
        latin = latin_pattern(pattern)
        self.latin = re.compile(latin) if latin else self.pattern
        size = max(self.ranks.values()) + 1
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        words: list[bytes] = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.words, self.decimals = Texts(words), Texts([b"%d," % i for i in range(size)])
        self.queue, self.shared = RankQueue(size), SharedQueue(self.ranks)
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.memory = Memory()
        self.data, self.start, self.size = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self) -> None:
        """Encode the pre-tokens that are new."""
        import numpy as np

        memory = self.memory
        new = [t.encode() for t in memory.pending]
        whole = [self.ranks.get(x, -1) for x in new]
        ids: list = [None] * len(new)
        short = [i for i, x in enumerate(new) if whole[i] < 0 and len(x) <= SHORT_BYTES]
        size = np.ones(len(new), np.int64)
        merged, size[short] = self.shared.merge([new[i] for i in short])
        for i, x in enumerate(new):
            if whole[i] < 0 and len(x) > SHORT_BYTES:
                ids[i] = merge(x, self.ranks, self.queue)
                size[i] = len(ids[i])
                del memory[memory.pending[i]]
        start = np.cumsum(size) - size
        data = np.zeros(int(size.sum()), self.kind)
        single = np.array(whole, np.int64)
        data[start[single >= 0]] = single[single >= 0]
        if short:
            span = np.repeat(start[short] - (np.cumsum(size[short]) - size[short]), size[short])
            data[span + np.arange(len(span))] = merged
        for i, x in enumerate(ids):
            if x is not None:
                data[start[i] : start[i] + len(x)] = x
        self.start = np.concatenate((self.start, start + len(self.data)))
        self.size, self.data = np.concatenate((self.size, size)), np.concatenate((self.data, data))
        memory.pending = []

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, those of a long one in several lists."""
        try:
            text.encode("latin-1")
            pattern = self.latin
        except UnicodeEncodeError:
            pattern = self.pattern
        if len(text) <= STEP_BYTES:
            yield pattern.findall(text)
            return
        found = (x.group() for x in pattern.finditer(text))
        while some := list(islice(found, STEP_TOKENS)):
            yield some

    def encode(self, texts: list[str]) -> list:
        """Ids of each text as numpy arrays."""
        import numpy as np

        out: list[list] = [[] for _ in texts]
        rows: list = []

        def settle():
            if self.memory.pending:
                self.learn()
            for i, row in rows:
                out[i].append(gather(self.data, self.start, self.size, row))
            rows.clear()
            if len(self.memory) > CACHE_ENTRIES or len(self.data) > 16 * CACHE_ENTRIES:
                self.forget()

        for i, text in enumerate(texts):
            for tokens in self.pieces(text):
                rows.append((i, np.fromiter(map(self.memory.__getitem__, tokens), np.uint32, len(tokens))))
                if len(self.memory.pending) >= STEP_TOKENS or len(tokens) >= STEP_TOKENS:
                    settle()
        settle()
        return [x[0] if len(x) == 1 else np.concatenate(x) for x in out]

    def decode(self, ids) -> bytes:
        return self.words.join(ids)

    def decimal(self, ids) -> bytes:
        """Decimal ids, joined by commas."""
        return self.decimals.join(ids)[:-1]


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Return for each row: id, n_tokens, ids_sha256, decoded_sha256 and, if ``with_ids``, ids.

    ``path`` is the place of the rank file on every machine. Null text is empty and has no ids.
    ``decoded_sha256`` is of the bytes that decoding the ids gives. Rows are independent, so
    repeated rows give repeated results and no rows give none."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        c = codec(path, pattern)
        for batch in (part for whole in batches for part in text_slices(whole, 1, STEP_BYTES)):
            out: dict[str, list] = {"n": [], "ids_sha": [], "dec_sha": []} | ({"ids": []} if with_ids else {})
            for ids in c.encode([x or "" for x in batch.column(1).to_pylist()]):
                out["n"].append(len(ids))
                out["ids_sha"].append(hashlib.sha256(c.decimal(ids)).hexdigest())
                out["dec_sha"].append(hashlib.sha256(c.decode(ids)).hexdigest())
                if with_ids:
                    out["ids"].append(ids.astype("int32"))
            arrays = [batch.column(0), pa.array(out["n"], pa.int64()), pa.array(out["ids_sha"], pa.string()), pa.array(out["dec_sha"], pa.string())]
            if with_ids:
                arrays.append(pa.array(out["ids"], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(arrays)])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t"))
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(run, schema)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, as hashes, and of what they decode to."""
    return encode_documents(table(spark, sf_dir, "documents"), *default_vocabulary(), with_ids=False)
