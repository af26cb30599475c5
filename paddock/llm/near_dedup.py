"""Near duplicates by HyperMinHash: bands of compressed registers, estimates, then full sets.

A document's set of word shingles becomes 256 registers, each the leading-zero count and ten
further bits of the smallest hash in its bucket; empty buckets borrow from others in an order
that depends on the bucket alone. Documents that agree in a band of five registers are candidates,
the collision-corrected estimate rules out what is far from the threshold, and full sets
decide. Inside a band's bucket documents are first compared with one member; only documents that
are still in different components are compared further, so that a group of thousands of copies
costs about one comparison each and yet no component is missed. Buckets of many unlike documents are
split by further registers first. Links that join nothing new are never written: what comes
out is a document's component, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_key, shuffle_partitions, stage, table
from .textnum import KEY, new_key

REGISTERS = 256
MANTISSA_BITS = 10
BAND = 5
#: Estimates so many standard deviations below the threshold are ruled out.
DEVIATIONS = 6
#: A hub's members go to tasks of about so many.
MEMBERS_PER_TASK = 1_000
#: Members outside a bucket's main component: up to FEW they are paired at once; up to MANY blocks of
#: BLOCK of them meet parts of STREAM members; beyond it, SPLITS times at most, the bucket is split.
FEW, MANY, BLOCK, STREAM, SPLITS = 16, 8_192, 1_024, 8_192, 2
#: A split: SUB_BANDS keys of SUB_REGISTERS further registers, in one of ORDERS orders by the bucket. Of pairs
#: at similarity 0.8, 1.2 % share no key in one bucket; such a pair shares 17 of the 51 buckets on average.
SUB_BANDS, SUB_REGISTERS, ORDERS = 24, 8, 16


def _sets(array, k: int, key: int = KEY):
    """Yield (first text, sorted distinct shingle hashes of some texts, how many each has)."""
    import numpy as np

    from . import textnum

    data, offsets = textnum.text_bytes(array)
    for i, j in textnum.chunks(offsets):
        part = offsets[i : j + 1] - offsets[i]
        runs, sizes = textnum.shingle_hashes(*textnum.word_hashes(data[offsets[i] : offsets[j]], part, key), k)
        ends = np.cumsum(sizes)
        for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
            runs[a:b].sort()
        doc = np.repeat(np.arange(j - i), sizes)
        fresh = np.ones(len(runs), bool)
        fresh[1:] = (runs[1:] != runs[:-1]) | (doc[1:] != doc[:-1])
        yield i, runs[fresh], np.bincount(doc[fresh], minlength=j - i)


def _order():
    """For each bucket the order in which it looks for another that isn't empty."""
    import numpy as np

    random = np.random.default_rng(20240229)
    return np.stack([random.permutation(REGISTERS) for _ in range(REGISTERS)])


def sketch(runs, sizes):
    """Registers (texts x 256, uint16) of sorted distinct hashes; rows of empty sets are 0."""
    import numpy as np

    n, doc = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
    bucket = (runs >> np.uint64(56)).astype(np.int64)
    cell = doc * REGISTERS + bucket
    least = np.ones(len(runs), bool)
    least[1:] = cell[1:] != cell[:-1]  # hashes are sorted, so the first of a bucket is its smallest
    rest = runs[least] << np.uint64(8)
    exponent = np.frexp((rest | np.uint64(1)).astype(np.float64))[1]
    zeros = np.clip(64 - exponent, 0, 54).astype(np.uint64)
    mantissa = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA_BITS)
    registers, full = np.zeros(n * REGISTERS, np.uint16), np.zeros(n * REGISTERS, bool)
    registers[cell[least]] = (zeros << np.uint64(MANTISSA_BITS) | mantissa).astype(np.uint16)
    full[cell[least]] = True
    empty = np.flatnonzero(~full & np.repeat(sizes > 0, REGISTERS))
    order = _order()
    for turn in range(REGISTERS):
        if not len(empty):
            break
        donor = empty // REGISTERS * REGISTERS + order[empty % REGISTERS, turn]
        found = full[donor]
        registers[empty[found]] = registers[donor[found]]
        empty = empty[~found]
    return registers.reshape(n, REGISTERS)


def estimate(left, right):
    """Jaccard similarity of two sketches (rows by rows), corrected for registers that agree by
    chance: about 0.17 / 2 ** mantissa bits of them."""
    chance = 0.169919487 / (1 << MANTISSA_BITS)
    return ((left == right).mean(axis=1) - chance) / (1 - chance)


def _row_name(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_id (as it is), _k, _t of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), text.alias("_t")).select("_id", row_key("_id", F.col("_t")).alias("_k"), "_t")


def _id_text() -> Column:
    """An id of any type as a text to join on; null has a text of its own."""
    return F.coalesce(F.col("_id").cast("string"), F.lit("\x00"))


def fingerprints(docs: DataFrame, k: int, id_col: str, text_col: str, key: int = KEY) -> DataFrame:
    """_id, _k, n (set size), g, h (128 bits that name the set: equal sets, equal names), sketch."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from . import textnum

        for batch in batches:
            for i, runs, sizes in _sets(batch.column(2), k, key):
                ends = np.cumsum(sizes)
                names = []
                for name in (0x632BE59BD9B4E019, 0xD6E8FEB86659FD93):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(textnum.mix(runs + np.uint64(name)))))
                    names.append(pa.array(textnum.mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64)).astype(np.int64)))
                rows = sketch(runs, sizes)
                part = batch.slice(i, len(sizes))
                registers = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.arange(0, (len(sizes) + 1) * 2 * REGISTERS, 2 * REGISTERS, dtype=np.int32)), pa.py_buffer(rows.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sizes, pa.int64()), *names, registers], ["_id", "_k", "n", "g", "h", "sketch"])

    rows = _row_name(docs, id_col, text_col)
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _k long, n long, g long, h long, sketch binary")


def bands(sets: DataFrame) -> DataFrame:
    """b (band and its registers), c: one row for each band of each set."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from . import textnum

        n_bands = REGISTERS // BAND
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                rows = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)[:, : n_bands * BAND].reshape(-1, n_bands, BAND).astype(np.uint64)
                key = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), rows.shape[:2]).copy()
                for i in range(BAND):
                    key = textnum.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, i])
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().astype(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(), n_bands))], ["b", "c"])

    return sets.select("c", "sketch").mapInArrow(run, "b long, c long")


def sub_bands(members: DataFrame, sets: DataFrame, turn: int) -> DataFrame:
    """b, c: the keys that a split gives the members (b, c) of buckets that are too large."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from . import textnum

        random = np.random.default_rng(turn)
        orders = [random.permutation(REGISTERS)[: SUB_BANDS * SUB_REGISTERS] for _ in range(ORDERS)]
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                b, c, registers = part.column(0).to_numpy().astype(np.uint64), part.column(1).to_numpy(), _registers(part.column(2))
                for i, order in enumerate(orders):
                    some = np.flatnonzero(b % np.uint64(ORDERS) == i)
                    rows = registers[some][:, order].reshape(-1, SUB_BANDS, SUB_REGISTERS).astype(np.uint64)
                    key = textnum.mix(b[some, None] + np.arange(1, SUB_BANDS + 1, dtype=np.uint64))
                    for j in range(SUB_REGISTERS):
                        key = textnum.mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, j])
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel().astype(np.int64)), pa.array(np.repeat(c[some], SUB_BANDS))], ["b", "c"])

    return members.join(sets.select("c", "sketch"), "c").select("b", "c", "sketch").mapInArrow(run, "b long, c long")


def buckets(keys: DataFrame) -> DataFrame:
    """b, hub, size, c of keys (b, c) that several sets share; the hub is the smallest."""
    shared = keys.groupBy("b").agg(F.min("c").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    return keys.join(shared, "b")


def close_enough(estimates, left, right, threshold: float):
    """Whether an estimate leaves a chance of reaching the threshold, and set sizes allow it. A
    sketch is worth as many independent registers as its set has elements, about 0.7 x 256 at most."""
    import numpy as np

    small, large = np.minimum(left, right), np.maximum(left, right)
    deviation = np.sqrt(threshold * (1 - threshold) / (0.7 * np.minimum(small, REGISTERS)))
    return (estimates >= threshold - DEVIATIONS * deviation) & (small >= threshold * large - 1e-9)


def _registers(column):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def likely(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (x, y) those that estimates and set sizes don't rule out."""
    s = sets.select("c", "n", "sketch")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            estimates = estimate(_registers(batch.column(3)), _registers(batch.column(5)))
            good = close_enough(estimates, batch.column(2).to_numpy(), batch.column(4).to_numpy(), threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["x", "y"]).filter(pa.array(good))

    one = pairs.join(s.select(F.col("c").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx")), "x")
    two = one.join(s.select(F.col("c").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy")), "y")
    return two.select("x", "y", "nx", "sx", "ny", "sy").mapInArrow(run, "x long, y long")


def with_text(rows: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` (c and others) with _t, the text of one document of the set."""
    texts = _row_name(docs, id_col, text_col).select(_id_text().alias("_i"), "_k", "_t")
    return rows.join(sets.select("c", "_i", "_k"), "c").join(texts, ["_i", "_k"]).drop("_i", "_k")


def _common(full, runs, sizes):
    """How many of each set's hashes ``full`` holds."""
    import numpy as np

    at = np.searchsorted(full, runs)
    at[at == len(full)] = len(full) - 1
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes)[full[at] == runs], minlength=len(sizes))


def links_in_blocks(members: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, word_key: int = KEY) -> DataFrame:
    """Links (x, y) that join the components of a bucket's members.

    ``members``: b, c, label, main, outside (members that aren't in the main component), total. Those
    outside form blocks, all members form parts; a task holds one block and lets one part stream by,
    ordered by label. Estimates rule out most pairs, full sets decide on the others. A link is
    written only if it joins two components that the task didn't know to be joined, and joined ones
    are compared no further: a task writes fewer links than it has members."""
    spark = members.sparkSession
    blocks, parts = F.ceil(F.col("outside") / BLOCK).cast("int"), F.ceil(F.col("total") / STREAM).cast("int")
    deal = lambda n: F.pmod(F.xxhash64("c"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = members.where("label <> main").select("b", deal(blocks).alias("block"), every(parts).alias("part"), F.lit(0).alias("kind"), "c", "label")
    stream = members.select("b", every(blocks).alias("block"), deal(parts).alias("part"), F.lit(1).alias("kind"), "c", "label")
    rows = with_text(own.unionByName(stream), sets, docs, id_col, text_col).select("b", "block", "part", "kind", "c", "label", "_t")
    dealt = rows.repartition(shuffle_partitions(spark), "b", "block", "part").sortWithinPartitions("b", "block", "part", "kind", "label", "c")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        key, held, block, joined, now, root = None, [], None, {}, None, None
        for batch in batches:
            x, y = [], []
            b, block_no, part, kind, c, label = (batch.column(i).to_pylist() for i in range(6))
            for i, runs, sizes in _sets(batch.column(6), k, word_key):
                registers, ends = sketch(runs, sizes), np.cumsum(sizes)
                for j in range(len(sizes)):
                    one, r = runs[ends[j] - sizes[j] : ends[j]], i + j
                    if key != (b[r], block_no[r], part[r]):
                        key, held, block = (b[r], block_no[r], part[r]), [], None
                    if kind[r] == 0:
                        held.append((c[r], label[r], one.copy(), registers[j]))
                        continue
                    if not held:
                        continue
                    if block is None:
                        names, roots = np.array([h[0] for h in held]), np.array([h[1] for h in held])
                        block = names, roots, np.array([len(h[2]) for h in held]), np.stack([h[3] for h in held])
                        joined, now = {h[1]: h[1] for h in held}, None  # held labels' roots: as many as the block has
                    names, roots, counts, sketches = block
                    if now != label[r]:
                        now, root = label[r], joined.get(label[r], label[r])
                    good = np.flatnonzero(roots != root)
                    good = good[close_enough(estimate(sketches[good], registers[j]), counts[good], len(one), percent / 100)]
                    while len(good):  # one member of each other component is enough
                        first = good[np.unique(roots[good], return_index=True)[1]]
                        common = _common(one, np.concatenate([held[g][2] for g in first]), counts[first])
                        for g in first[100 * common >= percent * (counts[first] + len(one) - common)].tolist():
                            old = roots[g]
                            x.append(min(int(names[g]), c[r]))
                            y.append(max(int(names[g]), c[r]))
                            for h in (h for h, v in joined.items() if v == old):
                                joined[h] = root
                            roots[roots == old] = root
                        good = np.setdiff1d(good, first)
                        good = good[roots[good] != root]
            yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    return dealt.mapInArrow(run, "x long, y long")


def verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, key: int = KEY) -> DataFrame:
    """Of pairs (x, y) those with 100 * |intersection| >= percent * |union|, on full sets.

    Each x is a hub: its text goes once to every task that holds some of its y, which follow it
    in sorted order; hubs of many y are divided."""
    spark = pairs.sparkSession
    hubs = pairs.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK).cast("int").alias("parts"))
    members = pairs.join(hubs, "x").select(F.col("y").alias("c"), F.col("x").alias("hub"), F.pmod(F.xxhash64("y"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("kind"))
    heads = hubs.select(F.col("x").alias("c"), F.col("x").alias("hub"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"))
    asked = with_text(members.unionByName(heads), sets, docs, id_col, text_col).select("hub", "part", "kind", "c", "_t")
    dealt = asked.repartition(shuffle_partitions(spark), "hub", "part").sortWithinPartitions("hub", "part", "kind", "c")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hub, full = None, None
        for batch in batches:
            x, y = [], []
            heads, kinds, names = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for i, runs, sizes in _sets(batch.column(4), k, key):
                ends = np.cumsum(sizes)
                for j, (a, b) in enumerate(zip((ends - sizes).tolist(), ends.tolist(), strict=True), i):
                    if kinds[j] == 0:
                        hub, full = heads[j], runs[a:b].copy()
                        continue
                    if heads[j] != hub:
                        raise ValueError("a member came before its hub")
                    common = int(_common(full, runs[a:b], np.array([b - a]))[0])
                    if 100 * common >= percent * (len(full) + b - a - common):
                        x.append(hub)
                        y.append(names[j])
            yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})

    return dealt.mapInArrow(run, "x long, y long").distinct()


def components(links: DataFrame) -> DataFrame:
    """c, label (the smallest node reachable) of every node of ``links`` (x, y): the smallest label
    of the neighbours, then the label's own label, until nothing changes."""
    edges = stage(links.select("x", "y").union(links.select("y", "x")).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("x").alias("c")).agg(F.min("y").alias("m")).select("c", F.least("c", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("c", "y"), "y").groupBy(F.col("x").alias("c")).agg(F.min("label").alias("m"))
        least = labels.join(near, "c").select("c", F.least("label", "m").alias("l"), F.col("label").alias("old"))
        jump = labels.select(F.col("c").alias("l"), F.col("label").alias("up"))
        now = stage(least.join(jump, "l").select("c", F.least("l", "up").alias("label"), "old"), "labels")
        if not now.where("label <> old").limit(1).count():
            return labels
        labels = now.select("c", "label")


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return for each row: _id, _k, n_shingles, component_id, kept.

    Documents are linked whose sets of ``k``-word shingles have 100 * |intersection| >= percent *
    |union|; component_id is the smallest id that links reach. Ids may be of any type that has an order.
    Null or empty text, or text without words, has no shingles and is linked with nothing. Equal sets are one
    class and meet other classes once. Rows with a null id take part through equal and linked texts, but
    name no component that has an id; in a component of null ids only, component_id is null and the
    rows of one text are kept. Repeated rows share a result. No rows give none."""
    threshold = percent / 100
    key = new_key()  # the same for all tasks of this run, and unknown to whoever wrote the texts
    rows = stage(fingerprints(docs, k, id_col, text_col, key), "fingerprints")
    some = rows.where("n > 0").select("g", "h", _id_text().alias("_i"), "_k", "n", "sketch")
    first = some.groupBy("g", "h").agg(F.max(F.struct("_i", "_k")).alias("r")).select("g", "h", "r.*")
    # numbers of the sets, fixed once they are written
    sets = stage(some.join(first, ["g", "h", "_i", "_k"]).dropDuplicates(["g", "h"]).withColumn("c", F.monotonically_increasing_id()), "sets")
    held = stage(buckets(bands(sets)), "buckets")
    done = stage(held.where("c <> hub").select(F.col("hub").alias("x"), F.col("c").alias("y")).distinct(), "first-pairs")
    links = stage(verify(stage(likely(done, sets, threshold), "pairs"), sets, docs, k, percent, id_col, text_col, key), "links")
    for turn in range(1, SPLITS + 2):
        labels = components(links)
        left = held.where("size > 2").join(labels, "c", "left").select("b", "c", F.coalesce("label", "c").alias("label"))
        counts = left.groupBy("b", "label").agg(F.count(F.lit(1)).alias("m"))
        mixed = counts.groupBy("b").agg(F.max_by("label", F.struct("m", "label")).alias("main"), (F.sum("m") - F.max("m")).alias("outside"), F.sum("m").alias("total")).where("outside > 0")
        left = stage(left.join(mixed, "b"), "mixed")
        few = left.where(F.col("outside") <= FEW)
        odd = few.where("label <> main").select("b", F.col("c").alias("x"), F.col("label").alias("lx"), "main")
        cross = odd.join(few.select("b", F.col("c").alias("y"), F.col("label").alias("ly")), "b").where("lx <> ly and (ly = main or x < y)")
        large = (F.col("outside") > MANY) & F.lit(turn <= SPLITS)
        held = stage(buckets(sub_bands(left.where(large), sets, turn)), "buckets")
        star = held.where("c <> hub").select(F.col("hub").alias("x"), F.col("c").alias("y")).distinct()
        pairs = cross.select("x", "y").union(star).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct().join(done, ["x", "y"], "left_anti")
        pairs = stage(pairs, "pairs")
        found = verify(stage(likely(pairs, sets, threshold), "likely"), sets, docs, k, percent, id_col, text_col, key)
        found = found.union(links_in_blocks(left.where((F.col("outside") > FEW) & ~large), sets, docs, k, percent, id_col, text_col, key)).distinct()
        links, done = links.unionByName(stage(found, "links")), done.unionByName(pairs)
        if not held.limit(1).count():
            break
    labels = components(links)
    classes = rows.where("n > 0").groupBy("g", "h").agg(F.min("_id").alias("_id"), F.min("_k").alias("_k"))
    names = classes.join(sets.select("g", "h", "c"), ["g", "h"]).join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    least = names.groupBy("label").agg(F.min("_id").alias("component_id"), F.min("_k").alias("one"))
    named = names.select("g", "h", "label").join(least, "label").drop("label")
    slim = rows.select("_id", "_k", "n", "g", "h")
    out = slim.join(named, (slim["g"] == named["g"]) & (slim["h"] == named["h"]) & (slim["n"] > 0), "left")
    alone = F.col("n") == 0
    kept = F.when(alone, True).when(F.col("component_id").isNull(), F.col("_k") == F.col("one")).otherwise(F.col("_id").eqNullSafe(F.col("component_id")))
    return out.select("_id", "_k", F.col("n").alias("n_shingles"), F.when(alone, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"), kept.alias("kept"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share four fifths of their two-word shingles."""
    return near_dedup(table(spark, sf_dir, "documents"), k=2).select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "kept")
