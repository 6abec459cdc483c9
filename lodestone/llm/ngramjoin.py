"""N-gram Jaccard join: count-vector R-trees over shingle sets, and the components of the links.

Two documents link when the Jaccard similarity of their sets of five-word shingles is 0.8 or more
(``100 * both >= 80 * either``).  The result is exact, whatever the size of a group of copies:

1. *Classes.*  Each text becomes its set of hashed shingles in one Arrow pass.  Documents with equal sets form
   a class at once; from here on a class is one point.  The pass also counts, in a table of fixed size, how
   many documents hold a shingle of each of ``SLOTS`` slots, over the whole corpus.
2. *Buckets.*  In the order (documents of the slot, hash) a set's first ``n - ceil(0.8 n) + 1`` shingles must
   hold one of any set it links with.  Classes that share such a shingle meet in a bucket.  Shingles of
   boilerplate come last in the order, so buckets are small unless texts are boilerplate throughout.
   Buckets with the same members are looked at once; one of many classes, or of classes with many counts, is dealt into
   parts (``in_parts``), of which each two meet in a task of their own.
3. *R-trees.*  A class is the point of its counts of shingles in hash groups (``GROUPS``, more for large sets, in
   which case boxes are on the coarser of two grids).  The sum of the
   coordinates' minima of two points bounds their overlap, the sum of the minima of two boxes' upper corners
   that of anything in them.  A bucket's points are packed into a tree of boxes, and the tree is joined with
   itself; pairs whose bound reaches the threshold join into families.  Only a spanning forest leaves a
   bucket, and pairs already in one family are passed over.
4. *Verification.*  A family's sets meet, at most ``CHUNK`` sets and ``CHUNK_SHINGLES`` shingles to a task: a
   large family is dealt into chunks, and each two chunks meet in a task of their own.  Overlaps are counted
   exactly through an inverted index of the chunk; a spanning forest of the links leaves, and for each class
   the number of texts that it links with, each pair of classes being met in one task only.
5. *Components* of the forests are found by large-star and small-star steps on tables.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case.  Defined cases: with under five words
the whole sequence is the one shingle; null, empty and blank texts have none and link with nothing (their
component is their own id); rows that share a doc_id count as one node; a null doc_id gets a null component;
``n_links`` counts the texts other than the row's own that link with it, a text being a doc_id with a set, so that
repeated rows count once and an id with two sets twice; it is null for a null doc_id;
repeated rows get a row each; an empty table gives no rows; extra columns are ignored.  Shingles are known by 64 bits of
hash, classes by 108 and their size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, drop_scratch_since, materialise, scratch_mark, small_side
from .shingles import mix, shingle_sets

GROUPS = 64
#: Shingles a hash group holds on average at most.
GROUP_SIZE = 12
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
_PARTS = 16
#: Points of a box of the tree, and boxes of a box above.
LEAF = 8
CHUNK = 2048
CHUNK_SHINGLES = 1_000_000
#: Members of families up to which their rows are broadcast to the texts (seven numbers, some 60 bytes each).
BROADCAST_MEMBERS = 1_000_000
#: A longer bucket is not compared with others member by member; it is looked at on its own.
LONGEST_KNOWN = 1_000_000
#: Names that a task remembers so as not to send them again; more of them are sent again, which changes nothing.
REMEMBERED = 200_000
#: Classes of a bucket that one task's tree holds; a task of a larger bucket holds two such parts.
BUCKET = 16_384

#: Counts that one task's tree holds of a bucket, four bytes each.
BUCKET_COUNTS = 1 << 24
#: Classes of a part of a bucket at least, however few rows the tasks have.
LEAST_PART = 256
#: Bits of hash in ``cid``, above the 20 of the size; fewer only in tests.
ID_BITS = 44

POINTS = "doc_id long, cid long, check long, n long, counts binary"


def class_ids(s: np.ndarray, bits: int = ID_BITS) -> tuple[int, int]:
    """A class is known by both numbers: ``cid``, hash bits over 20 bits of size, and ``check``, 64 bits of another hash."""
    if not len(s):
        return 0, 0
    sums = np.array([np.bitwise_xor.reduce(mix(s + np.uint64(11))), np.add.reduce(mix(s + np.uint64(23)), dtype=np.uint64)])
    one, two = (int(x) for x in mix(sums + np.uint64(len(s))))
    cid = (one >> (64 - bits) << 20) | min(len(s), (1 << 20) - 1)
    return _signed(cid), _signed(two)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def groups_for(n: int) -> int:
    """Hash groups of a set of n shingles: four times as many for each four times the size, from ``GROUPS`` on.

    With a few counts a group, unrelated sets of one size lie well apart whatever their size.
    """
    groups = GROUPS
    while n > groups * GROUP_SIZE:
        groups *= 4
    return groups


def count_vector(s: np.ndarray) -> bytes:
    """Counts by hash group; groups of a coarser grid are runs of these."""
    groups = groups_for(len(s))
    counts = np.bincount((s >> np.uint64(65 - groups.bit_length())).astype(np.intp), minlength=groups)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b"\1" + counts.astype(np.uint32).tobytes()


def vector_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32, offset=1) if len(data) % 2 else np.frombuffer(data, np.uint8)


def grids(vectors: list[np.ndarray], sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(indexes, points)`` on each grid in use: the points of the grid, and of the next finer one those that
    are small enough to link with them.  A grid's last pairs of finer points are also met on their own grid."""
    width = np.array([len(v) for v in vectors])
    for groups in np.unique(width).tolist():
        own = width == groups
        finer = (width == 4 * groups) & (4 * sizes <= 5 * groups * GROUP_SIZE)
        at = np.flatnonzero(own | finer) if own.any() else np.flatnonzero(own)
        yield at, np.stack([vectors[k].astype(np.int32) if len(vectors[k]) == groups else vectors[k].astype(np.int32).reshape(groups, 4).sum(axis=1) for k in at])


def _points(bits: int):
    """A row for each text; at the end the task's table of slots, in ``_PARTS`` rows with n = -1."""
    names = ["doc_id", "cid", "check", "n", "counts"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = np.zeros(SLOTS, np.int64)
        for batch in batches:
            rows = []
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1)), strict=True):
                rows.append((doc, *class_ids(s, bits), len(s), count_vector(s) if len(s) else b""))
                slots[(s & np.uint64(SLOTS - 1)).astype(np.intp)] += 1  # distinct in s, but not their slots: an estimate of order only
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
        if slots.any():
            parts = np.split(slots, _PARTS)
            rows = [(None, k, 0, -1, p.tobytes()) for k, p in enumerate(parts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _sum_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = np.frombuffer(data, np.int64)
            total[k] = total[k] + more if k in total else more
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["cid", "counts"])


def _prefixes(order: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = order.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            tokens, owners, checks = [], [], []
            for s in shingle_sets(batch.column(0)):
                n = len(s)
                if not n:
                    continue
                cid, check = class_ids(s, bits)
                if (cid, check) in seen:
                    continue
                if len(seen) < REMEMBERED:
                    seen.add((cid, check))
                m = n - -(-4 * n // 5) + 1
                held = slots[(s & np.uint64(SLOTS - 1)).astype(np.intp)]
                tokens.append(s[np.argsort(held, kind="stable")[:m]])
                owners.append(np.full(m, cid, np.int64))
                checks.append(np.full(m, check, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(checks))], ["token", "cid", "check"])

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (token, cid, check) in; ``(bucket, cid, check)`` of the tokens with two classes or more out."""
    none = np.zeros(0, np.int64)
    rest = (none, none, none)
    known: set[int] = set()
    long: int | None = None  # the token whose first pieces are out
    names = ["bucket", "cid", "check"]

    def cut(t: np.ndarray, c: np.ndarray, k: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.ones(len(t), bool)
        first[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1]) | (k[1:] != k[:-1])
        t, c, k = t[first], c[first], k[first]
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(t)]]))
        several = (sizes > 1) | (t[starts] == long) if long is not None else sizes > 1
        if not several.any():
            return
        starts, sizes = starts[several], sizes[several]
        rows = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        heads = np.cumsum(sizes) - sizes
        name = mix(np.add.reduceat(mix(mix(c[rows].view(np.uint64)) + k[rows].view(np.uint64)), heads) + sizes.astype(np.uint64)).view(np.int64)
        if long is not None and t[starts[0]] == long:
            name[0] = long  # the rest joins the pieces under the token
            known.discard(long)
        fresh = np.zeros(len(name), bool)
        for at, x in enumerate(name.tolist()):
            if x not in known:
                fresh[at] = True
                if len(known) < REMEMBERED:
                    known.add(x)
        take = np.repeat(fresh, sizes)
        if take.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(name, sizes)[take]), pa.array(c[rows][take]), pa.array(k[rows][take])], names)

    for batch in batches:
        t, c, k = (np.concatenate([r, batch.column(n).to_numpy()]) for n, r in enumerate(rest))
        if not len(t):
            continue
        stop = int(np.searchsorted(t, t[-1], side="left"))
        if len(t) - stop > LONGEST_KNOWN:  # one bucket without end: it goes out under its token, piece by piece
            if stop:
                yield from cut(t[:stop], c[:stop], k[:stop])
            yield pa.RecordBatch.from_arrays([pa.array(t[stop:]), pa.array(c[stop:]), pa.array(k[stop:])], names)
            long = int(t[-1])
            rest = t[-1:], c[-1:], k[-1:]
            continue
        if stop:
            yield from cut(t[:stop], c[:stop], k[:stop])
        rest = t[stop:], c[stop:], k[stop:]
    if len(rest[0]):
        yield from cut(*rest)


class Forest:
    """Union-find over 0..n-1; a tree's root is its least member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, a: int) -> int:
        up = self.up
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        return np.array([self.root(i) for i in range(len(self.up))], np.int64)


def reaches(overlap, sizes):
    """100 * overlap >= 80 * union, for an overlap of sets whose sizes sum to ``sizes``."""
    return 9 * overlap >= 4 * sizes


class CountTree:
    """A packed R-tree over count vectors: leaves of ``LEAF`` points, boxes with upper corner and least size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        spread = points.var(axis=0)
        axes = np.argsort(-spread)[:3]
        slab = np.argsort(sizes, kind="stable").argsort() // max(LEAF, int(len(sizes) ** 0.5))
        self.order = np.lexsort([*(points[:, a] for a in axes[::-1]), slab])
        self.points, self.sizes = points[self.order], sizes[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        upper, least, most = self.points, self.sizes, self.sizes
        while len(upper) > 1 or not self.levels:
            at = np.arange(0, len(upper), LEAF)
            upper, least, most = np.maximum.reduceat(upper, at, axis=0), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)
            self.levels.append((upper, least, most))

    def forest(self) -> list[tuple[int, int]]:
        """A spanning forest of the pairs whose bound reaches the threshold, as indexes of the given points."""
        joined = Forest(len(self.points))
        edges: list[tuple[int, int]] = []
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            if level < 0:
                continue
            upper, least, most = self.levels[level]
            if a != b:
                bound = np.minimum(upper[a], upper[b]).sum()
                if not reaches(bound, least[a] + least[b]) or 5 * most[a] < 4 * least[b] or 5 * most[b] < 4 * least[a]:
                    continue
            if level == 0:
                self._leaves(a, b, joined, edges)
                continue
            below = len(self.levels[level - 1][0])
            for i in range(a * LEAF, min(below, (a + 1) * LEAF)):
                for j in range(max(i, b * LEAF) if a == b else b * LEAF, min(below, (b + 1) * LEAF)):
                    stack.append((level - 1, i, j))
        return [(int(self.order[i]), int(self.order[j])) for i, j in edges]

    def _leaves(self, a: int, b: int, joined: Forest, edges: list) -> None:
        rows_a, rows_b = np.arange(a * LEAF, min(len(self.sizes), (a + 1) * LEAF)), np.arange(b * LEAF, min(len(self.sizes), (b + 1) * LEAF))
        root_a = np.array([joined.root(i) for i in rows_a.tolist()])
        root_b = np.array([joined.root(i) for i in rows_b.tolist()]) if b != a else root_a
        apart = root_a[:, None] != root_b[None, :]
        if not apart.any():
            return
        bound = np.minimum(self.points[rows_a][:, None, :], self.points[rows_b][None, :, :]).sum(axis=2, dtype=np.int64)
        ok = apart & reaches(bound, self.sizes[rows_a][:, None] + self.sizes[rows_b][None, :])
        for i, j in zip(*np.nonzero(ok), strict=True):
            if joined.join(int(rows_a[i]), int(rows_b[j])):
                edges.append((rows_a[i], rows_b[j]))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each value of the first ``keys`` columns together; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)])
        starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(c[s] for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held)


EDGES = "a long, b long"


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``bucket, i, j, class, n, counts`` sorted by bucket, i, j in; edges of the forests of the bounds out, between classes' numbers."""
    out: list[tuple[int, int]] = []
    done: set[tuple[int, int]] = set()
    for table in _runs(batches, 3):
        cids, sizes = table.column(3).to_numpy(), table.column(4).to_numpy()
        if len(cids) == 2 and (5 * sizes.min() < 4 * sizes.max() or (cids[0], cids[1]) in done):
            continue
        vectors = [vector_of(x) for x in table.column(5).to_pylist()]
        found = []
        for at, points in grids(vectors, sizes):
            if len(at) == 2:
                if reaches(int(np.minimum(*points).sum()), int(sizes[at].sum())):
                    found.append((int(at[0]), int(at[1])))
            elif len(at) > 2:
                found += [(int(at[i]), int(at[j])) for i, j in CountTree(points, sizes[at]).forest()]
        for i, j in found:
            pair = (int(cids[i]), int(cids[j]))
            if pair not in done:
                if len(done) < REMEMBERED:
                    done.add(pair)
                out.append(pair)
        if len(out) > 10_000:
            yield _edge_batch(out)
            out = []
    yield _edge_batch(out)


MEMBERS = "family long, i int, j int, chunk int, cid long, check long, rep long, docs long, n long, shingles binary"
LINKS = "a long, b long, cid long, check long, links long"


def _sets(bits: int):
    """``rep, docs, cid, check, family, chunk, chunks, text`` in; the class's set, once for each task it takes part in, out."""
    names = ["family", "i", "j", "chunk", "cid", "check", "rep", "docs", "n", "shingles"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(7)]
            for row, (rep, docs, cid, check, family, chunk, chunks) in enumerate(zip(*cols, strict=True)):
                s = next(shingle_sets(batch.column(7).slice(row, 1)))
                if class_ids(s, bits) != (cid, check):
                    continue  # another text under the same doc_id
                data = s.tobytes()
                for at in range(0, chunks, 64):
                    others = range(at, min(chunks, at + 64))
                    rows = [(family, min(chunk, k), max(chunk, k), chunk, cid, check, rep, docs, len(s), data) for k in others]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact links within each task's sets: a spanning forest, and the texts each class links with."""
    kinds = [pa.int64()] * 5
    names = ["a", "b", "cid", "check", "links"]
    for table in _runs(batches, 3):
        across = table.column(1)[0].as_py() != table.column(2)[0].as_py()
        _, first = np.unique(np.stack([table.column(4).to_numpy(), table.column(5).to_numpy()]), axis=1, return_index=True)
        chunk, cid, check, reps, docs, sizes = (table.column(k).to_numpy()[first] for k in range(3, 9))
        data = table.column(9).combine_chunks()
        sets = [np.frombuffer(data[int(k)].as_buffer(), np.uint64) for k in first]
        edges, linked = links(sets, sizes, chunk if across else None, docs)
        some = np.flatnonzero(linked)
        rows = [(int(reps[i]), int(reps[j]), None, None, None) for i, j in edges]
        rows += [(None, None, int(cid[k]), int(check[k]), int(linked[k])) for k in some]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def links(sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray | None, docs: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A spanning forest of the pairs of ``sets`` that link, with ``side`` of the pairs from two sides; and for
    each set the sum of ``docs`` over all sets it is paired with."""
    n = len(sets)
    linked = np.zeros(n, np.int64)
    joined, edges = Forest(n), []
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    starts = np.flatnonzero(new)
    counts = np.diff(np.concatenate([starts, [len(flat)]]))
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.cumsum(new) - 1  # of each shingle of each set, in the sets' order
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for i in range(n - 1):
        mine = rank[begin[i]:begin[i + 1]]
        held = counts[mine]
        mine, held = mine[held > 1], held[held > 1]
        if not len(mine):
            continue
        ends = np.cumsum(held)
        at = np.arange(int(ends[-1])) + np.repeat(starts[mine] - ends + held, held)
        overlap = np.bincount(owner[at], minlength=n)
        overlap[:i + 1] = 0
        ok = reaches(overlap, sizes + sizes[i]) & (overlap > 0)
        if side is not None:
            ok &= side != side[i]
        found = np.flatnonzero(ok)
        linked[found] += docs[i]
        linked[i] += docs[found].sum()
        for j in found.tolist():
            if joined.join(i, j):
                edges.append((i, j))
    return edges, linked


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each end of ``edges`` (a, b): root is the least node that can be reached.

    Large-star and small-star steps in turn, each a group-by on a node with the least neighbour as its
    aggregate, until nothing moves; every step's table is durable.
    """
    now = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialise(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        sums = [x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first() for x in (now, after)]
        for old in (now, large):
            drop_scratch(old)
        now, before = after, sums
        if before[0] == before[1]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def in_parts(met: DataFrame, most: int, counts: int = BUCKET_COUNTS) -> DataFrame:
    """``bucket, cid, check, i, j``: members of buckets of over ``most`` classes, or over ``counts`` counts, dealt into
    parts, a row for each two parts that meet.

    A class holds at most a third of its size in counts, or ``GROUPS``.  Only the large buckets' sizes are joined back: at
    most one for each ``most`` rows or ``counts`` counts, broadcast after a count.
    """
    size = F.col("cid").bitwiseAND(F.lit((1 << 20) - 1))
    held = F.sum(F.greatest(F.lit(GROUPS), F.ceil(size / 3)))
    parts = F.greatest(F.ceil(F.count("*") / most), F.ceil(held / counts)).cast("int")
    large = materialise(met.groupBy("bucket").agg(parts.alias("parts")).filter("parts > 1"), "large-buckets")
    dealt = met.join(small_side(large), "bucket", "left").withColumn("part", F.expr("cast(pmod(xxhash64(cid, check), parts) as int)"))
    others = F.explode(F.expr("if(parts is null, array(0), filter(sequence(0, parts - 1), k -> k <> part))")).alias("k")
    part = F.coalesce("part", F.lit(0))
    return dealt.select("bucket", "cid", "check", part.alias("part"), others).select("bucket", "cid", "check", F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"))


def join(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of each of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    mark = scratch_mark()
    points = materialise(texts.mapInArrow(_points(ID_BITS), POINTS), "points")
    parts = points.filter("n = -1").select("cid", "counts").repartition(_PARTS, "cid").mapInArrow(_sum_slots, "cid long, counts binary").collect()
    slots = np.zeros(SLOTS, np.int64)
    for cid, data in parts:
        slots[cid * (SLOTS // _PARTS):][: SLOTS // _PARTS] += np.frombuffer(data, np.int64)
    order = spark.sparkContext.broadcast(slots)

    rows = points.filter("n >= 0").select("doc_id", "cid", "check", "n")
    held = points.filter("n > 0 and doc_id is not null")
    classes = materialise(held.groupBy("cid", "check", "n").agg(F.min("doc_id").alias("rep"), F.count_distinct("doc_id").alias("docs"), F.first("counts").alias("counts")).withColumn("class", F.monotonically_increasing_id()), "classes")

    tokens = texts.filter("doc_id is not null").select("text").mapInArrow(_prefixes(order, ID_BITS), "token long, cid long, check long")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = tokens.repartition(width, "token").sortWithinPartitions("token", "cid", "check").mapInArrow(_buckets, "bucket long, cid long, check long").distinct()
    met = materialise(met, "buckets")
    # where tasks have few rows, smaller parts keep a large bucket from standing out; pairs and results are the same
    parts = in_parts(met, min(BUCKET, max(LEAST_PART, met.count() // width)))
    vectors = parts.join(classes.select("cid", "check", "class", "n", "counts"), ["cid", "check"]).select("bucket", "i", "j", "class", "n", "counts")
    near = vectors.repartition(width, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "class").mapInArrow(_families, EDGES)
    families = components(near)

    members = families.select(F.col("node").alias("class"), F.col("root").alias("family"))
    members = members.unionByName(members.select(F.col("family").alias("class"), "family").distinct())
    members = members.join(classes.select("class", "rep", "docs", "cid", "check", "n"), "class")
    load = members.groupBy("family").agg(F.count("*").alias("sets"), F.sum("n").alias("held"))
    chunks = F.greatest(F.ceil(F.col("sets") / CHUNK), F.ceil(F.col("held") / CHUNK_SHINGLES)).cast("int")
    members = materialise(members.join(load.select("family", chunks.alias("chunks")), "family").select(
        "rep", "docs", "cid", "check", "family", F.pmod(F.xxhash64("cid", "check"), F.col("chunks")).cast("int").alias("chunk"), "chunks"), "members")
    small = members.count() <= BROADCAST_MEMBERS
    chosen = (F.broadcast(members) if small else members).join(texts.withColumnRenamed("doc_id", "rep"), "rep").select("rep", "docs", "cid", "check", "family", "chunk", "chunks", "text")
    sets = chosen.mapInArrow(_sets(ID_BITS), MEMBERS).repartition(width, "family", "i", "j").sortWithinPartitions("family", "i", "j", "cid", "check")
    # rows of whole sets: few to an Arrow batch, so that a batch of long ones stays small
    rows_key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(rows_key)
    spark.conf.set(rows_key, 256)
    try:
        linked = materialise(sets.mapInArrow(_verify, LINKS), "links")
    finally:
        spark.conf.set(rows_key, usual)
    drop_scratch_since(mark, points, classes, linked)

    ids = rows.join(classes.select("cid", "check", "n", "rep", "docs"), ["cid", "check", "n"], "left")
    several = ids.filter("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.collect_set("rep").alias("reps")).filter("a < b")
    same_id = several.select("a", F.explode("reps").alias("b")).filter("a <> b")
    roots = components(linked.filter("a is not null").select("a", "b").unionByName(same_id))
    out = ids.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    counted = linked.filter("a is null").groupBy("cid", "check").agg(F.sum("links").alias("links"))
    out = out.join(counted, ["cid", "check"], "left")
    others = F.coalesce(F.col("docs") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "doc_id").alias("component_id"),
        F.when(F.col("doc_id").isNotNull(), others).cast("long").alias("n_links"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked texts, the one with the least doc_id, null ids last.

    Rows are told apart by a number written beside them, so repeated rows and rows without id are compared like
    any other, and rows that only share an id stay.  Texts without words link with nothing and stay.
    """
    keyed = materialise(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")), "keyed")
    found = join(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")))
    found = materialise(found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")), "groups")
    several = found.filter("key <> group").select("group").distinct()
    place = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), "key")
    members = found.join(several, "group", "left_semi").join(keyed.select("key", place.alias("place")), "key")
    kept = members.groupBy("group").agg(F.min("place")["key"].alias("kept"))
    gone = members.join(kept, "group").filter("key <> kept").select("key")
    return keyed.join(small_side(materialise(gone, "gone")), "key", "left_anti").select("row.*")
