"""Short codes of vectors: one codebook for each part, learnt by Lloyd's rounds over two trees.

Vectors become integers and are cut into parts. Blocks of vectors keep, for each part position, a tree
over the block's parts; a second tree spans the codebook's entries. A round walks pairs of nodes from the roots
down. Bounds on the distance of their boxes prune pairs, a node that is left with one entry is
assigned whole through its cached sum and count, and leaves that stay uncertain are settled by exact
integers. Sums are added up by Spark; only the codebooks come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sized_broadcast, stage, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts of a leaf of the tree over parts, entries of a leaf of the other one.
LEAF, GROUP = 16, 16
#: Vectors of a block, and components of a block, at most.
BLOCK_ROWS, BLOCK_VALUES = 4_096, 1 << 19
#: So many of the nearest groups are looked into for single entries.
FEW_GROUPS = 2
#: Labels whose errors are broadcast at most.
MAX_LABELS = 200_000


def tree_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Numbers of ``points`` in the order of the leaves of a balanced tree, whose nodes are halved
    where they are widest. Numbers from len(points) on stand for the last point and only fill up."""
    n = len(points)
    leaves = 1
    while leaves * leaf < n:
        leaves *= 2
    groups = np.arange(leaves * leaf).reshape(1, -1)
    while groups.shape[1] > leaf:
        half = groups.shape[1] // 2
        if points.shape[1]:
            values = points[np.minimum(groups, n - 1)]
            widest = (values.max(1) - values.min(1)).argmax(1)
            along = np.take_along_axis(values, widest[:, None, None], 2)[:, :, 0]
            groups = np.take_along_axis(groups, np.argpartition(along, half, axis=1), 1)
        groups = groups.reshape(-1, half)
    return groups.ravel()


class Tree:
    """Boxes, counts and sums of the nodes, level by level from the root."""

    def __init__(self, points: np.ndarray, order: np.ndarray, leaf: int):
        self.real = order < len(points)
        self.order = np.minimum(order, len(points) - 1)
        self.points = points[self.order]
        shape = (len(order) // leaf, leaf, points.shape[1])
        leaves = self.points.reshape(shape)
        low, high = leaves.min(1), leaves.max(1)
        total, count = (self.points * self.real[:, None]).reshape(shape).sum(1), self.real.reshape(shape[:2]).sum(1)
        self.levels = [(low, high, total, count)]
        while len(low) > 1:
            low, high = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2])
            total, count = total[::2] + total[1::2], count[::2] + count[1::2]
            self.levels.insert(0, (low, high, total, count))


def box_distances(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of which all between points of the boxes are between."""
    gap = np.maximum(np.maximum(a[0] - b[1], b[0] - a[1]), 0)
    far = np.maximum(a[1] - b[0], b[1] - a[0])
    return np.einsum("ij,ij->i", gap, gap), np.einsum("ij,ij->i", far, far)


class Codebook:
    """The entries of one part position and the tree over them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # of equal entries only the first one ever wins
        first = np.sort(np.unique(entries, axis=0, return_index=True)[1]) if entries.shape[1] else np.zeros(1, np.int64)
        self.tree = Tree(entries[first], tree_order(entries[first], 1), 1)
        self.tree.order = first[self.tree.order]
        depth = len(self.tree.levels) - 1
        self.group_level = max(0, depth - GROUP.bit_length() + 1)
        #: Numbers of the entries of each group, ascending, so that the first of equal ones is the smallest.
        self.groups = [np.unique(g) for g in self.tree.order.reshape(1 << self.group_level, -1)]
        self.squares = (entries * entries).sum(1)


def walk(tree: Tree, book: Codebook) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """(whole nodes as (level, nodes, their entries), leaves, groups of entries each may still have).

    A pair of a node and a group of entries is left if no other pair rules it out: the bound is the
    smallest of the largest distances to a group and to the single entries of the nearest groups."""
    entry_levels = book.tree.levels
    depth = len(entry_levels) - 1
    node, other, at = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    whole = []
    for level, (lows, highs, _, _) in enumerate(tree.levels):
        if level:
            node, other = np.repeat(node * 2, 2), np.repeat(other, 2)
            node[1::2] += 1
        while at < min(book.group_level, level + 2):
            node, other = np.repeat(node, 2), np.repeat(other * 2, 2)
            other[1::2] += 1
            at += 1
        near, far = box_distances((lows[node], highs[node]), (entry_levels[at][0][other], entry_levels[at][1][other]))
        best = np.full(len(lows), np.iinfo(np.int64).max if far.dtype == np.int64 else np.inf, far.dtype)
        np.minimum.at(best, node, far)
        if at < book.group_level:
            keep = near <= best[node]
            node, other = node[keep], other[keep]
            continue
        order = np.lexsort((near, node))
        first = np.concatenate(([True], node[order][1:] != node[order][:-1]))
        place = np.arange(len(order))
        picked = order[place - np.maximum.accumulate(np.where(first, place, 0)) < FEW_GROUPS]
        size = 1 << (depth - at)
        single = (other[picked, None] * size + np.arange(size)).ravel()
        of = np.repeat(node[picked], size)
        single_near, single_far = box_distances((lows[of], highs[of]), (entry_levels[depth][0][single], entry_levels[depth][1][single]))
        np.minimum.at(best, of, single_far)
        keep = near <= best[node]
        decided = np.bincount(node[keep], minlength=len(lows)) == np.bincount(node[picked[keep[picked]]], minlength=len(lows))
        left = (single_near <= best[of]) & decided[of]
        alone = np.bincount(of[left], minlength=len(lows)) == 1
        done = left & alone[of]
        whole.append((level, of[done], book.tree.order[single[done]]))
        keep &= ~alone[node]
        node, other = node[keep], other[keep]
    return whole, node, other


class Assigned:
    """What a walk and the exact comparison of uncertain leaves give for one part position of a block."""

    def __init__(self, points: np.ndarray, order: np.ndarray, book: Codebook):
        self.tree, self.book = Tree(points, order, LEAF), book
        self.whole, leaf, group = walk(self.tree, book)
        size = len(self.tree.points)
        self.entry = np.full(size, -1, np.int64)
        best = np.zeros(size, points.dtype)
        for g in np.unique(group).tolist():
            rows = (leaf[group == g][:, None] * LEAF + np.arange(LEAF)).ravel()
            numbers = book.groups[g]
            distance = book.squares[numbers] - 2 * (self.tree.points[rows] @ book.entries[numbers].T)
            nearest = distance.argmin(1)
            found, number = distance[np.arange(len(rows)), nearest], numbers[nearest]
            better = (self.entry[rows] < 0) | (found < best[rows]) | ((found == best[rows]) & (number < self.entry[rows]))
            self.entry[rows[better]], best[rows[better]] = number[better], found[better]

    def add_to(self, total: np.ndarray, count: np.ndarray) -> None:
        """Sums and counts by entry: nodes that were assigned whole give their cached ones."""
        for level, nodes, entries in self.whole:
            _, _, sums, counts = self.tree.levels[level]
            np.add.at(total, entries, sums[nodes].astype(np.int64))
            np.add.at(count, entries, counts[nodes])
        rows = np.flatnonzero((self.entry >= 0) & self.tree.real)
        np.add.at(total, self.entry[rows], self.tree.points[rows].astype(np.int64))
        count += np.bincount(self.entry[rows], minlength=len(count))

    def codes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each of the block's ``n`` parts."""
        entry = self.entry.copy()
        for level, nodes, entries in self.whole:
            entry.reshape(len(self.tree.levels[level][0]), -1)[nodes] = entries[:, None]
        gap = self.tree.points - self.book.entries[entry]
        error = np.einsum("ij,ij->i", gap, gap).astype(np.int64)
        out, errors = np.zeros(n, np.int64), np.zeros(n, np.int64)
        out[self.tree.order[self.tree.real]], errors[self.tree.order[self.tree.real]] = entry[self.tree.real], error[self.tree.real]
        return out, errors


def _limit(width: int, parts: int) -> int:
    """Integers up to this size keep every error below 2 ** 62."""
    return isqrt((1 << 62) // (4 * parts * max(1, width)))


def _integers(array, width: int, parts: int) -> np.ndarray:
    """floor(SCALE * x) of an Arrow list array, one row a vector, zeros after the end of shorter ones."""
    lengths = np.diff(np.asarray(array.offsets)).astype(np.int64)
    scaled = np.floor(np.asarray(array.flatten()).astype(np.float64) * SCALE)
    bound = _limit(width, parts)
    out = np.zeros((len(lengths), parts * width), np.int64)
    out[np.arange(parts * width) < lengths[:, None]] = np.clip(scaled, -bound, bound).astype(np.int64)
    return out


def _exact(values: np.ndarray, entries: np.ndarray) -> type:
    """float64 where every sum of products is exact in it, which is much faster, else int64."""
    most = max(int(np.abs(values).max(initial=0)), int(np.abs(entries).max(initial=0)))
    return np.float64 if 4 * max(1, entries.shape[-1]) * most * most < 1 << 53 else np.int64


def _kept(vectors: DataFrame, id_col: str, vector_col: str, carried: Sequence[str]) -> DataFrame:
    kind = vectors.schema[vector_col].dataType.simpleString()
    vector = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(vector_col).isNotNull() & finite).select(F.struct(F.col(id_col).alias("_id"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(carried))).alias("row"), vector.alias("vector"))


def build_blocks(kept: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of vectors: rows (what each vector carries), data (their integers), orders (of the trees)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        step = max(LEAF, min(BLOCK_ROWS, BLOCK_VALUES // max(1, parts * width)))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                values = _integers(part.column(1), width, parts)
                orders = [tree_order(values[:, p * width : (p + 1) * width], LEAF) for p in range(parts)]
                rows = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([rows, pa.array([values.astype("<i4").tobytes()]), pa.array([np.concatenate(orders).astype("<u4").tobytes()])], ["rows", "data", "orders"])

    kind = kept.schema["row"].dataType.simpleString()
    return stage(kept.mapInArrow(run, f"rows array<{kind}>, data binary, orders binary"), "vector-blocks")


def _assigned(batch, i: int, books: np.ndarray) -> Iterator[tuple[int, Assigned, int]]:
    """Each part position of a block, assigned."""
    parts, _, width = books.shape
    n = len(batch.column("rows")[i])
    values = np.frombuffer(batch.column("data")[i].as_py(), "<i4").reshape(n, parts * width)
    orders = np.frombuffer(batch.column("orders")[i].as_py(), "<u4").astype(np.int64).reshape(parts, -1)
    kind = _exact(values, books)
    for p in range(parts):
        yield p, Assigned(values[:, p * width : (p + 1) * width].astype(kind), orders[p], _book(books, p, kind)), n


_books: dict[tuple, Codebook] = {}


def _book(books: np.ndarray, p: int, kind: type) -> Codebook:
    """One tree over the entries for each codebook that a worker process meets, of the latest codebooks."""
    key = (hashlib.sha256(books.tobytes()).digest(), p, kind)
    if key not in _books:
        if len(_books) >= 64:
            _books.clear()
        _books[key] = Codebook(books[p].astype(kind))
    return _books[key]


def lloyd_round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, size, width = books.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, count = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                for p, assigned, _ in _assigned(batch, i, books):
                    assigned.add_to(total[p], count[p])
        part, entry = np.nonzero(count)
        if len(part):
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), pa.array(list(total[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "total"])

    sums = blocks.mapInArrow(run, "part int, entry int, n bigint, total array<bigint>").groupBy("part", "entry")
    out = books.copy()
    for row in sums.agg(F.sum("n"), *(F.sum(F.col("total")[j]) for j in range(width))).collect():  # parts * entries rows
        out[row[0], row[1]] = [x // row[2] for x in row[3:]]
    return out


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", carried: Sequence[str] = (), parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(blocks, codebooks of shape (parts, entries, width) as integers)."""
    kept = _kept(vectors, id_col, vector_col, carried)
    width = -(-(kept.agg(F.max(F.size("vector"))).first()[0] or 0) // parts)
    first = kept.select(F.col("row._id").alias("_id"), "vector").orderBy(F.col("_id").asc_nulls_last(), "vector").limit(min(entries, ENTRIES)).collect()
    import pyarrow as pa

    start = _integers(pa.array([list(r["vector"]) for r in first], pa.list_(pa.float64())), width, parts)
    books = np.ascontiguousarray(start.reshape(len(first), parts, width).transpose(1, 0, 2))
    blocks = build_blocks(kept, width, parts)
    for _ in range(rounds if len(first) else 0):
        before, books = books, lloyd_round(blocks, books)
        if np.array_equal(before, books):
            break  # further rounds change nothing
    return blocks, books


def encode(blocks: DataFrame, books: np.ndarray, id_col: str, carried: Sequence[str] = ()) -> DataFrame:
    """id, the carried columns, code (one byte a part), error of every vector of ``blocks``."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                found = [assigned.codes(n) for _, assigned, n in _assigned(batch, i, books)]
                code = np.stack([c for c, _ in found], 1).astype(np.uint8)
                rows = batch.column("rows")[i].values
                yield pa.RecordBatch.from_arrays([rows, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(sum(e for _, e in found))], ["row", "code", "error"])

    kind = blocks.schema["rows"].dataType.elementType.simpleString()
    coded = blocks.mapInArrow(run, f"row {kind}, code binary, error bigint")
    return coded.select(F.col("row._id").alias(id_col), *(F.col(f"row._{i}").alias(c) for i, c in enumerate(carried)), "code", "error")


def decode(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """Add ``decoded``, the vector that the code stands for (of the blocks' full length)."""
    names = [f.name for f in coded.schema]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, len(books))
            vectors = np.concatenate([books[p][code[:, p]] for p in range(len(books))], 1) / SCALE
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(vectors), pa.list_(pa.float64()))], [*names, "decoded"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(run, f"{kinds}, decoded array<double>")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(id, code (one byte a part), error, label_error of each kept vector; the codebooks).

    Vectors that are null or hold null or non-finite components are left out. Component x becomes
    floor(1024 * x). The length of all is that of the longest one, rounded up to whole parts; shorter ones go on with
    zeros, so that an empty vector is all zeros. Each codebook starts with that part of the ``entries`` (256 at most)
    vectors of the smallest ids, in ties of the smallest vectors, null ids last; fewer vectors
    make a smaller one. Integers beyond about 2 ** 27 (for 64 components) count as that bound,
    which keeps errors in 64 bits. ``label_error`` adds up the errors of equal labels, null labels together; it
    is null where the sum exceeds 64 bits. Repeated rows count and are returned as often as they
    stand there; no rows give no rows. Other columns are not read."""
    blocks, books = train(vectors, id_col, vector_col, (label_col,), parts, entries, rounds)
    coded = stage(encode(blocks, books, "_id", (label_col,)).withColumnRenamed(label_col, "_label"), "vector-codes")
    sums = stage(coded.groupBy(F.col("_label").alias("_l")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    out = coded.join(sized_broadcast(sums, MAX_LABELS), F.col("_label").eqNullSafe(F.col("_l")))
    return out.select(F.col("_id").alias(id_col), "code", "error", "label_error"), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, errors and the digest of the codebooks of all embeddings."""
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """Every round by brute force, for vectors of equal lengths."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT i, p, best % {ENTRIES} AS e, best // {ENTRIES} AS error FROM (
    SELECT i, p, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * {ENTRIES} + e) AS best
    FROM parts JOIN c{r} USING (p) GROUP BY i, p))""")
        if r < ROUNDS:
            steps.append(f"""
n{r} AS (
  SELECT p, e, list(v ORDER BY j) AS c FROM (
    SELECT p, e, j, floor(sum(v) / count(*)) AS v FROM (SELECT p, e, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM a{r} JOIN parts USING (i, p)) GROUP BY p, e, j)
  GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(n{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN n{r} USING (p, e))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS i, vec_id, label, list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
w AS (SELECT (max(len(x)) // {PARTS})::BIGINT AS width FROM kept),
parts AS MATERIALIZED (SELECT i, p, x[p * width + 1:(p + 1) * width] AS x FROM kept, w, range({PARTS}) AS t(p)),
c0 AS MATERIALIZED (SELECT p, i AS e, x AS c FROM parts WHERE i < {ENTRIES}),{",".join(steps)},
digest AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda v: v::BIGINT), ','), ',' ORDER BY p, e)) AS d FROM c{ROUNDS}),
coded AS (SELECT i, string_agg(printf('%02x', e::INT), '' ORDER BY p) AS code, sum(error)::BIGINT AS error FROM a{ROUNDS} GROUP BY i)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, d AS codebooks_sha256
FROM kept JOIN coded USING (i), digest
"""


SQL = _sql()
