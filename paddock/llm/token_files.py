"""Token ids in binary shard files, compressed by a Re-Pair grammar for each shard.

Frequent pairs of neighbouring symbols become nonterminals, again and again, until no pair is
frequent. A shard file holds the rules, the length that each rule expands to and the documents'
places in the compressed sequence, so that any document, or any range of its ids, is decoded
without the rest. No rule crosses the end of a document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import Memory, gather
from .common import shared_dir, stage, table, text_slices
from .sharedfs import AtomicWriter, read_bytes

END_ID = 1
#: Ids after which a shard file is closed; a document is never divided.
SHARD_IDS = 4_000_000
#: Bytes of text for each task, about 3,000,000 ids.
SHARD_BYTES = 8 << 20
#: A pair that occurs less often isn't replaced. A rule takes some 6 bytes and each use saves 2; rules
#: of rarer pairs make all symbols wider, and files are hardly smaller.
MIN_COUNT = 16
#: Pieces of text that a worker remembers, in two halves, the older of which is dropped when the newer is full.
CACHE_WORDS = 500_000
#: Bytes of text that a worker encodes at once.
STEP_BYTES = 2 << 20
#: Symbols of a shard that are looked up or expanded at once.
STEP_SYMBOLS = 1 << 18
MAGIC = b"PDKTOK2\0"


#: Stands between words in one call of the library; a word that holds it is encoded alone.
MARK = "\x01"
#: The pre-tokens of a tokenizer whose texts are cut here as it would cut them.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)
#: Kinds of bytes in UTF-8; OTHER starts or goes on a character beyond ASCII.
KINDS = bytes(OTHER if b > 127 else LETTER if chr(b).isalpha() else DIGIT if 48 <= b <= 57 else BLANK if b in b"\t\n\v\f\r " else SIGN for b in range(256))
#: The same for a tokenizer that is only known not to look beyond white space.
WHOLE = bytes(BLANK if b in b"\n " else OTHER for b in range(256))
LOWER = bytes(range(256)).lower()


def _longer(table, ids, size):
    """A table (ids, start and number of each entry's) with further entries."""
    import numpy as np

    data, start, sizes = table
    return np.concatenate((data, ids)), np.concatenate((start, np.cumsum(size) - size + len(data))), np.concatenate((sizes, size))


class WordTokenizer:
    """A lower-casing tokenizer of the ``tokenizers`` library that drops white space and tells
    letters from digits and other signs before its merges, applied piece by piece.

    A piece is a run of letters, a digit or a run of signs, in lower case. Distinct pieces are
    encoded by the library once and remembered. Words between blanks that hold other characters
    than ASCII and the letters from À to ÿ, or a special token, are pieces as a whole, in their own case: no
    rule of such a tokenizer looks beyond white space."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        config = json.loads(self.tokenizer.to_str())
        steps = json.dumps(config["pre_tokenizer"])
        self.model = None
        self.special = [x["content"].encode() for x in config["added_tokens"]]
        apart = all({LETTER, SIGN} <= set(x.translate(KINDS)) and BLANK not in x.translate(KINDS) for x in self.special)
        if config["model"]["type"] == "BPE" and "Lowercase" in json.dumps(config["normalizer"]) and json.dumps(WORDS) in steps and "ByteLevel" in steps and apart and not any(x["normalized"] for x in config["added_tokens"]):
            self.model = self.tokenizer.model
            shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others follow 255
            others = [b for b in range(256) if b not in shown]
            self.shown = "".join(chr(256 + others.index(b)) if b in others else chr(b) for b in range(256))
        self.forget()

    def forget(self) -> None:
        self.memory = Memory()
        self.words = self.nothing()  # ids of all pieces, where each piece's start, how many it has
        self.older = {}, self.nothing()  # what was remembered before

    @staticmethod
    def nothing():
        import numpy as np

        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pieces(self, data: bytes):
        """(pieces as an Arrow array, where each starts) of texts that each end in a line feed."""
        import numpy as np
        import pyarrow as pa

        raw = np.frombuffer(data, np.uint8)
        if self.model is None:
            kind, low = np.frombuffer(data.translate(WHOLE), np.uint8), raw
        else:
            kind, low = (np.frombuffer(bytearray(data.translate(x)), np.uint8) for x in (KINDS, LOWER))
            self._beyond_ascii(data, raw, kind, low)
        edge = kind[1:] != kind[:-1]  # between a byte and the next
        edge |= (kind[1:] == DIGIT) & (kind[:-1] == DIGIT)
        # a lone apostrophe before letters may make a pre-token with them: it stays in the word
        at = np.flatnonzero((raw == ord("'")) & (kind == SIGN))
        at = at[(kind[at - 1] != SIGN) & (kind[at + 1] == LETTER)]
        edge[at] = False
        edge[at[kind[at - 1] == LETTER] - 1] = False
        bounds = np.concatenate(([0], np.flatnonzero(edge) + 1, [len(raw)]))
        start, size = bounds[:-1], np.diff(bounds)
        shown = kind[start] != BLANK
        start, size = start[shown], size[shown]
        offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(low[kind != BLANK])]), start

    def _beyond_ascii(self, data: bytes, raw, kind, low) -> None:
        """Mark letters from À to ÿ as such; words with other characters or special tokens stay whole."""
        import numpy as np

        if not data.isascii():
            at = np.flatnonzero(raw == 0xC3)
            second = raw[at + 1]
            letter = (second != 0x97) & (second != 0xB7)  # signs of multiplication and division
            at, second = at[letter], second[letter]
            kind[at] = kind[at + 1] = LETTER
            low[at[second < 0x9F] + 1] += 32
        for token in self.special:
            place = data.find(token)
            while place >= 0:
                kind[place] = OTHER
                place = data.find(token, place + 1)
        others = np.flatnonzero(kind == OTHER)
        if len(others):
            blank = np.concatenate(([-1], np.flatnonzero(kind == BLANK)))
            word = np.unique(np.searchsorted(blank, others))
            step = np.zeros(len(raw), np.int8)
            step[blank[word - 1] + 1] = 1
            step[blank[word]] = -1
            whole = np.cumsum(step, dtype=np.int8).view(bool)
            kind[whole] = OTHER
            low[whole] = raw[whole]

    def _plain(self, words: list[str]):
        """(ids, how many each word has), by the library's own steps. A mark stands between words."""
        import numpy as np

        found, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            text = f" {MARK} ".join([*some, ""])
            if self.mark is not None and text.count(MARK) == len(some):
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
                cuts = ids == self.mark
                sizes.append(np.diff(np.flatnonzero(cuts), prepend=-1) - 1)
                found.append(ids[~cuts])
            else:
                alone = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                sizes.append(np.array([len(x) for x in alone], np.int64))
                found.append(np.array([i for x in alone for i in x], np.uint32))
        return np.concatenate(found), np.concatenate(sizes)

    def _parts(self, parts: list[str]):
        """The same for lower-case words of letters and runs of signs, by the library's model."""
        import numpy as np
        from codecs import charmap_decode

        ids, size, tokenize, shown = [], [], self.model.tokenize, self.shown
        for part in parts:  # the library's tokens are dropped at once
            some = tokenize(part if part.isascii() else charmap_decode(part.encode(), "strict", shown)[0])
            size.append(len(some))
            ids.extend([x.id for x in some])
        return np.array(ids, np.uint32), np.array(size, np.int64)

    def _learn(self, pieces: list[bytes]) -> None:
        """Remember pieces; those that the older memory has aren't encoded again."""
        import numpy as np

        memory, table = self.older
        number = np.array([memory.get(x, -1) for x in pieces], np.int64)
        new = np.flatnonzero(number < 0)
        number[new] = np.arange(len(table[1]), len(table[1]) + len(new))
        table = _longer(table, *self._encoded([pieces[i] for i in new.tolist()]))
        self.words = _longer(self.words, gather(*table, number), table[2][number])

    def _encoded(self, pieces: list[bytes]):
        """(ids, how many each piece has), by the library's model where a piece is one pre-token for certain."""
        import numpy as np

        parts, others, place = [], [], []
        for piece in pieces:
            word = piece.decode()
            if self.model is not None:
                if piece.isalpha() or not piece.strip(SIGNS):
                    place.append(len(parts))
                    parts.append(word)
                    continue
                if word.isalpha() and max(word) <= "\xff":
                    place.append(len(parts))
                    parts.append(word.lower())
                    continue
            place.append(-1 - len(others))
            others.append(word)
        table = _longer(self.nothing(), *self._plain(others))
        if parts:
            table = _longer(table, *self._parts(parts))
        number = np.array(place, np.int64)
        number = np.where(number < 0, -1 - number, number + len(others))
        return gather(*table, number), table[2][number]

    def encode(self, texts: list[str]) -> list:
        """Ids of each text as numpy arrays."""
        import numpy as np

        if len(self.memory) > CACHE_WORDS // 2 or len(self.words[0]) > 8 * CACHE_WORDS:
            self.older, self.memory, self.words = (self.memory, self.words), Memory(), self.nothing()
        if not texts:
            return []
        rows = [text.encode() for text in texts]
        pieces, start = self.pieces(b"\n".join([*rows, b""]))
        coded = pieces.dictionary_encode()
        number = np.fromiter(map(self.memory.__getitem__, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        if self.memory.pending:
            self._learn(self.memory.pending)
            self.memory.pending = []
        row = number[coded.indices.to_numpy()]
        last = np.searchsorted(start, np.cumsum([len(x) + 1 for x in rows]))
        ends = np.concatenate(([0], np.cumsum(self.words[2][row])))[last]
        ids = np.split(gather(*self.words, row), ends[:-1])
        if len(self.memory) > CACHE_WORDS or len(self.words[0]) > 16 * CACHE_WORDS:
            self.forget()  # a worker doesn't keep the pieces of one very long text
        return ids


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer_of(path: str) -> WordTokenizer:
    """The one that this Python worker keeps. Tasks call it by name: a closure that named the dictionary
    itself would be sent a copy of it, and each task would start with nothing."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def repair(ids, ends, base: int, min_count: int = MIN_COUNT):
    """Re-Pair over a shard.

    ``ids``: all ids; ``ends``: True at each document's last id; nonterminals count from ``base``.
    Returns (sequence, ends of the sequence, rules as an array of pairs). A round counts the pairs
    exactly and replaces all that are frequent, the more frequent first where two overlap; a pair
    of which this leaves fewer than half of ``min_count`` waits for the next round. A pair that is rare stays
    rare, so later rounds look only at places beside new symbols and where a frequent pair is left.
    It ends when no pair occurs ``min_count`` times."""
    import numpy as np

    none, end = np.iinfo(np.int32).max, np.uint32(1 << 31)
    seq, rules, n_rules, turn = ids | ends.astype(np.uint32) << np.uint32(31), [], 0, 0  # the top bit marks a document's end
    keys = lambda places: seq[places].astype(np.uint64) << np.uint64(32) | (seq[places + 1] & ~end)
    some = np.flatnonzero(seq[:-1] < end).astype(np.int32)
    while len(some):
        turn += 1
        order = np.empty(len(some), np.uint64)
        for a in range(0, len(some), STEP_SYMBOLS):
            order[a : a + STEP_SYMBOLS] = keys(some[a : a + STEP_SYMBOLS])
        order.sort()
        head = np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1])))
        count = np.diff(np.append(head, len(order)))
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        often = often[np.argsort(-count[often], kind="stable")]
        pairs = order[head[often]]
        del order, head, count
        bits = np.uint64(60 - max(16, len(pairs).bit_length() + 3))
        # a table of the frequent pairs; of those in one slot the rarer ones wait for another hash
        slot = lambda k: ((k ^ k >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15 + (turn << 20)) << np.uint64(4) >> np.uint64(4) >> bits).astype(np.int32)  # noqa: B023, E731
        at, held, number = slot(pairs), np.zeros(1 << (60 - int(bits)), np.uint64), np.full(1 << (60 - int(bits)), none, np.int32)
        held[at[::-1]], number[at[::-1]] = pairs[::-1], np.arange(len(pairs), dtype=np.int32)[::-1]
        left = np.zeros(len(seq), bool)
        place = np.full(len(seq) + 2, none, np.int32)  # shifted by one, with a border at either side
        here, there = [], []
        for a in range(0, len(some), STEP_SYMBOLS):
            part = some[a : a + STEP_SYMBOLS]
            key = keys(part)
            at = slot(key)
            maybe = np.flatnonzero(number[at] < none)
            left[part[maybe]] = True
            same = maybe[held[at[maybe]] == key[maybe]]
            here.append(part[same])
            there.append(number[at[same]])
        here, there = np.concatenate(here), np.concatenate(there)
        place[here + 1] = there
        lowest = (there <= place[here]) & (there <= place[here + 2])
        least, there = here[lowest], there[lowest]
        lead = np.ones(len(least), bool)  # of a run such as aaaa every other place is taken
        lead[1:] = (np.diff(least) > 1) | (there[1:] != there[:-1])
        step = np.arange(len(least), dtype=np.int32)
        every = (step - np.maximum.accumulate(np.where(lead, step, 0))) % 2 == 0
        take, there = least[every], there[every]
        worth = np.bincount(there, minlength=len(pairs)) >= (min_count + 1) // 2
        take, there = take[worth[there]], there[worth[there]]
        pairs = pairs[worth]
        rules.append(np.stack((pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)), 1).astype(np.int64))
        seq[take] = (base + n_rules + (np.cumsum(worth) - 1)[there]).astype(np.uint32) | (seq[take + 1] & end)
        n_rules += len(pairs)
        left[take] = True
        left[np.maximum(take, 1) - 1] = True
        keep = np.ones(len(seq), bool)
        keep[take + 1] = False
        seq, left = seq[keep], left[keep]
        some = np.flatnonzero(left[:-1] & (seq[:-1] < end)).astype(np.int32)
    return seq & ~end, seq >= end, np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)


def _generations(rules, base: int):
    """Ranges of rules that name terminals and rules of earlier ranges only."""
    import numpy as np

    latest, i = np.maximum.accumulate(rules.max(axis=1)) if len(rules) else rules[:, 0], 0
    while i < len(rules):
        j = int(np.searchsorted(latest, base + i))
        yield i, j
        i = j


def expansion_sizes(rules, base: int):
    """Ids that each rule expands to. A rule names earlier rules only."""
    import numpy as np

    size = np.ones(base + len(rules), np.int64)
    for i, j in _generations(rules, base):
        size[base + i : base + j] = size[rules[i:j]].sum(axis=1)
    return size[base:]


def pack_bits(values, width: int):
    """64-bit words that hold the values in ``width`` bits each; a word more at the end."""
    import numpy as np

    n = -(-len(values) // 64)
    rows = np.zeros((n, 64), np.uint64)
    rows.ravel()[: len(values)] = values
    out = np.zeros((n, width + 1), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= rows[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= rows[:, j] >> np.uint64(64 - shift)
    return np.append(out[:, :width].ravel(), np.uint64(0)).astype("<u8")


def unpack_bits(words, width: int, first: int, stop: int):
    """The values from place ``first`` up to ``stop``."""
    import numpy as np

    bit = np.arange(first, stop, dtype=np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    high = words[word + 1] << np.uint64(1) << (np.uint64(63) - shift)
    return ((words[word] >> shift | high) & np.uint64((1 << width) - 1)).astype(np.int64)


def pack_shard(doc_ids: list, ids: list, base: int, min_count: int = MIN_COUNT) -> bytes:
    """A shard file: head, documents (place in the sequence, number of ids), rules with expansion
    sizes, sequence, names of the documents. Little-endian; symbols take as many bits as the last of them needs.
    Names are 8-byte integers, or texts if any of them is one."""
    import numpy as np

    n = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    ends = np.zeros(len(flat), bool)
    ends[np.cumsum(n) - 1] = True  # every document has its end id at least
    seq, last, rules = repair(flat, ends, base, min_count)
    place = np.concatenate(([0], np.flatnonzero(last) + 1))
    size = expansion_sizes(rules, base)
    width = max(1, (base + len(rules) - 1).bit_length())
    null = np.array([x is None for x in doc_ids], np.uint8)
    texts = [b"" if x is None else str(x).encode() for x in doc_ids] if any(isinstance(x, str) for x in doc_ids) else None
    longest = int(size.max(initial=1)).bit_length()
    head = MAGIC + struct.pack("<QQQQBBB5x", len(doc_ids), base, len(rules), len(seq), width, longest, texts is not None)
    parts = [place.astype("<u8"), n.astype("<u8"), pack_bits(rules.ravel(), width), pack_bits(size, longest), null]
    if texts is None:
        names = [np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes()]
    else:
        names = [np.cumsum([0, *map(len, texts)]).astype("<u8").tobytes(), *texts]
    return b"".join([head, pack_bits(seq, width).tobytes(), *[x.tobytes() for x in parts], *names])


class Shard:
    """Random access to a shard file's documents."""

    def __init__(self, data):
        import numpy as np

        if data[:8] != MAGIC:
            raise ValueError("not a shard file")
        docs, self.base, n_rules, n_seq, self.width, longest, texts = struct.unpack("<QQQQBBB", data[8:43])
        at = 48

        def take(kind: str, n: int):
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        def packed(n: int, width: int):
            return take("<u8", -(-n // 64) * width + 1)

        self.n_seq, self.words = n_seq, packed(n_seq, self.width)
        self.place, self.n_tokens = take("<u8", docs + 1).astype(np.int64), take("<u8", docs).astype(np.int64)
        rules = unpack_bits(packed(2 * n_rules, self.width), self.width, 0, 2 * n_rules).reshape(-1, 2)
        size = unpack_bits(packed(n_rules, longest), longest, 0, n_rules)
        self.null = take("u1", docs).astype(bool)
        if texts:
            ends = take("<u8", docs + 1).tolist()
            names = bytes(data[at : at + ends[-1]])
            self.doc_ids = [None if x else names[a:b].decode() for x, a, b in zip(self.null, ends[:-1], ends[1:], strict=True)]
        else:
            self.doc_ids = [None if x else i for x, i in zip(self.null, take("<i8", docs).tolist(), strict=True)]
        # every symbol's expansion, terminals first: rules grow by doubling out of earlier ones
        self.size = np.concatenate((np.ones(self.base, np.int64), size))
        self.start = np.cumsum(self.size) - self.size
        flat = np.zeros(int(self.size.sum()), np.uint32)
        flat[: self.base] = np.arange(self.base)
        for i, j in _generations(rules, self.base):
            at = self.start[self.base + i]
            part = gather(flat, self.start, self.size, rules[i:j].ravel())
            flat[at : at + len(part)] = part
        self.flat = flat

    @property
    def seq(self):
        """All symbols of the sequence."""
        return unpack_bits(self.words, self.width, 0, self.n_seq)

    def all(self):
        """The ids of all documents, one after the other."""
        import numpy as np

        steps = range(0, self.n_seq, STEP_SYMBOLS)
        parts = [gather(self.flat, self.start, self.size, unpack_bits(self.words, self.width, a, min(a + STEP_SYMBOLS, self.n_seq))) for a in steps]
        return np.concatenate(parts) if parts else self.flat[:0]

    def document(self, i: int, first: int = 0, count: int | None = None):
        """Ids ``first`` to ``first + count`` of document ``i``."""
        import numpy as np

        symbols = unpack_bits(self.words, self.width, self.place[i], self.place[i + 1])
        if first or count is not None:
            ends = np.cumsum(self.size[symbols])
            stop = int(ends[-1]) if count is None else min(first + count, int(ends[-1]))
            a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, stop, "left") + 1
            skip = first - (int(ends[a - 1]) if a else 0)
            return gather(self.flat, self.start, self.size, symbols[a:b])[skip : skip + stop - first]
        return gather(self.flat, self.start, self.size, symbols)


def _id_type(df: DataFrame, id_col: str) -> str:
    """Names are longs where the column is of whole numbers, else texts."""
    return "long" if df.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long") else "string"


def write_shards(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS, min_count: int = MIN_COUNT, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write documents in ascending order of their ids (null first, texts break ties) and return
    the manifest: path, place (order of the files), n_tokens, n_docs, n_symbols, n_bytes. Null text is empty.

    Ids of any type but whole numbers are written as texts, in the order of their UTF-8 bytes. Tasks get about
    ``shard_bytes`` of text each, however many shuffle partitions the session has, so that every
    grammar has enough to learn from."""
    kind = _id_type(docs, id_col)
    rows = docs.select(F.col(id_col).cast(kind).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    total = rows.agg(F.sum(F.octet_length("_t").cast("long"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, round(total / shard_bytes)), "_id", F.substring("_t", 1, 32)).sortWithinPartitions("_id", "_t")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        tokenizer = tokenizer_of(path)
        base = max(tokenizer.tokenizer.get_vocab_size(), end_id + 1)
        held_docs, held, n, seq = [], [], 0, 0

        def flush():
            nonlocal held_docs, held, n, seq
            uri = f"{folder}/shard-{task.partitionId():05d}-{seq:05d}-{task.taskAttemptId()}.tok"
            data = pack_shard(held_docs, held, base, min_count)
            with AtomicWriter(uri) as out:
                out.write(data)
            symbols = struct.unpack("<Q", data[32:40])[0]
            row = pa.RecordBatch.from_pydict({"path": [uri], "place": [task.partitionId() << 32 | seq], "n_tokens": [n], "n_docs": [len(held)], "n_symbols": [symbols], "n_bytes": [len(data)]})
            held_docs, held, n, seq = [], [], 0, seq + 1
            return row

        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in text_slices(batch, 1, STEP_BYTES):
                for doc_id, ids in zip(part.column(0).to_pylist(), tokenizer.encode(part.column(1).to_pylist()), strict=True):
                    held_docs.append(doc_id)
                    held.append(np.concatenate((ids, end)))
                    n += len(ids) + 1
                    if n >= shard_ids:
                        yield flush()
        if held:
            yield flush()

    return ordered.mapInArrow(write, "path string, place long, n_tokens long, n_docs long, n_symbols long, n_bytes long")


def read_shards(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone. ``id_type``: long, or
    string where the ids were no whole numbers. The manifest has
    a row for each file, so its running sum is small beside the data."""
    total = F.sum("n_tokens").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(total, F.lit(0)).alias("start"))

    def read(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(read_bytes(uri))
                whole, ends = memoryview(shard.all().astype("<u4")).cast("B"), np.cumsum(shard.n_tokens)
                crc = [zlib.crc32(whole[4 * a : 4 * b]) for a, b in zip((ends - shard.n_tokens).tolist(), ends.tolist(), strict=True)]
                starts = start + ends - shard.n_tokens
                ids = pa.array(shard.doc_ids, pa.int64() if id_type == "long" else pa.string())
                yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(shard.n_tokens), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, manifest.count())
    return files.repartition(min(n, 10_000)).mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, number and crc32 of each document's token ids, from the shard files."""
    docs = table(spark, sf_dir, "documents")
    return read_shards(stage(write_shards(docs, shared_dir(spark, "tokens"), default_tokenizer()), "token-manifest"))
