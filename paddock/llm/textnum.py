"""Words of many texts as 64-bit numbers, by whole-array arithmetic on their UTF-8 bytes."""

from __future__ import annotations

import secrets

import numpy as np

CHUNK_BYTES = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_BYTES = 128
KEY, _STEP = 0x8F1D3A6C5B79E204, np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False


def new_key() -> int:
    """A key that nobody can know beforehand, for hashes that tell words apart: whoever knows the key can
    make words that collide."""
    return secrets.randbits(64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls are empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    array = pc.fill_null(array, "")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None and array.buffers()[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray):
    """Ranges of texts of about CHUNK_BYTES together; a longer text is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of each word, end of each word, number of words of each text). Words are maximal runs
    of the bytes in ``is_word``."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    first[edge] = inside[edge]
    final = inside.copy()
    final[:-1] &= ~inside[1:]
    edge = offsets[1:][offsets[1:] > 0] - 1
    final[edge] = inside[edge]
    start, end = np.flatnonzero(first), np.flatnonzero(final) + 1
    return start, end, np.diff(np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = LOWER, key: int = KEY) -> np.ndarray:
    """A 64-bit hash of each span of bytes, each byte read through ``table``, by a key.

    Eight bytes at a time go through ``mix``, which hides the key. With a key that the texts' authors don't
    know, of v different spans about v * v / 2 ** 65 pairs collide; with a known one (the
    default, for features of classifiers) collisions can be made. Longer ones than LONG_BYTES take keyed blake2b."""
    import hashlib

    size = end - start
    low = table[data]
    padded = np.concatenate((low, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = mix(size.astype(np.uint64) * _STEP + np.uint64(key))
    at = np.flatnonzero(size <= LONG_BYTES) if len(size) and size.max() > LONG_BYTES else slice(None)
    done, place, left, value = 0, start[at], size[at], out[at]
    todo = np.arange(len(size))[at]
    while len(todo):
        part = eight[place + done]
        part = np.where(left >= 8, part, part & ((np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) << np.uint64(3))) - np.uint64(1)))
        value = mix((value ^ part) + _STEP)
        more = left > 8
        out[todo[~more]] = value[~more]
        todo, place, left, value, done = todo[more], place[more], left[more] - 8, value[more], done + 8
    for i in np.flatnonzero(size > LONG_BYTES).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(low[start[i] : end[i]].tobytes(), digest_size=8, key=key.to_bytes(8, "little")).digest(), "little")
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, key: int = KEY) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word between white space, A-Z as a-z; number of words of each text)."""
    start, end, counts = word_spans(data, offsets)
    return span_hashes(data, start, end, key=key), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``k`` words, runs of each text). A text of fewer words, but not none,
    has its whole sequence as one run."""
    n, doc = len(words), np.repeat(np.arange(len(counts)), counts)
    m = max(0, n - k + 1)
    runs = np.zeros(m, np.uint64)
    for j in range(k):
        runs += words[j : j + m] * np.uint64((0xD1342543DE82EF95 * (2 * j + 1) + 2 * j) & _MASK | 1)
    good = doc[:m] == doc[k - 1 : k - 1 + m]
    runs, sizes = mix(runs[good]), np.maximum(counts - (k - 1), 0)
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        starts = np.cumsum(counts) - counts
        alone = np.zeros(len(few), np.uint64)
        for i, d in enumerate(few):
            h = int(counts[d])
            for w in words[starts[d] : starts[d] + counts[d]].tolist():
                h = (h * 0x5851F42D4C957F2D + w) & _MASK
            alone[i] = h
        runs = np.insert(runs, np.cumsum(sizes)[few], mix(alone))
        sizes[few] = 1
    return runs, sizes
