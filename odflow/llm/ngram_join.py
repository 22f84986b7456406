"""Jaccard self-join of documents on word n-grams, with count-vector R-trees.

A document's set holds the distinct hashes of its k-word shingles.  Equal sets
are one class from the start (a 128-bit signature); joining, linking and
verifying is done between classes, so copies are never paired with each other.

Count vectors.  Shingle hashes fall into groups, and the numbers of shingles
by group are the set's point; larger sets have more groups (``resolution``: 256
to 4096), so that counts stay small and telling.  Two sets share at most the
sum of the coordinate minima of their points, which bounds their Jaccard
index; points of two resolutions meet on the lower one, groups added up.  An
R-tree over the points of a bucket holds the upper corner and the range of
sizes of each node: a node whose summed minima with a query point fall short
of the overlap needed is skipped with all below it.  Pairs that survive are
verified on the sets themselves.

Dealing out.  The trees cannot be one tree: in that many dimensions a query's box
meets most top-level nodes.  Points are dealt to buckets by their rare
shingles instead: sets alike enough must share one of the first shingles in a
common order (length filters give how many), rare ones first by a table of
corpus counts with a fixed number of cells.  The order affects cost only.
Taking a 16th of the set more into the prefix, sets that link must share that
many of them (less a little for their sizes), and a set with fewer prefix
shingles in common with anyone is out at once.

Hot buckets.  Each bucket names a leader, and every set is first verified
against the STARS leaders it shares most buckets with, STAR_ROUNDS times, each
time leaders of another component: stars that grow with the rows and not with
pairs.  Components of these links are found; only buckets that still hold sets
of two or more components, of sizes that can match, go on, and pairs inside a
component are not looked at, as they cannot change the components.  Trees over
the points of a bucket name the sets that have a partner left; pairs are not
written.  The sets themselves then go to their buckets and are verified there,
against a union-find of the components: only a link that joins two of them is
handed on, so rows grow with the sets.  For BUCKET_ROUNDS rounds only buckets go
on that are the fullest open one for half their sets or more, at most two places
a set; most groups are one component after the first, which closes all their
buckets.  Sets that met in such a bucket are settled, and before each round the
trees are asked again who has a partner left.  The last round sends each of
these to all open buckets it has left, where a pair is looked at in the first
one it shares.
``links`` spares no pair: it takes neither leaders nor labels and verifies all
pairs.  Buckets of over BLOCK sets or BLOCK_GRAMS shingles are cut into blocks,
and each pair of blocks is a task group of its own.  Nothing is capped or
dropped: a link lost would need a pair that shares no prefix shingle, which the
length filter excludes.

Hashes.  Shingles are compared as 64-bit hashes, classes as 128-bit
signatures; buckets name a class by 64 bits of its signature, which about 25
of 3e10 classes would share with another.

Empty and null texts have the empty set and link with nothing.  Null ids are
carried; a component without any id is null.  Repeated rows and ids are rows
of their own.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import WORD, masked, stored, table, unmasked
from odflow.llm.components import connected
from odflow.llm.textvec import WordHasher, mix, shingles, stretches

RESOLUTIONS = (256, 1024, 4096)
#: A link shares this share of the set's prefix shingles, not only one.
COMMON_PART = 16
STAR_ROUNDS = 2
#: Points in trees have no more groups; the pairs left meet on the full points.
TREE_GROUPS = 1024
STARS = 2
CELLS = 1 << 17
CELLS_PER_ROW = 1 << 12
BLOCK = 2048
BLOCK_GRAMS = 1 << 20
BUCKET_ROUNDS = 2
#: Rows whose sets are fetched by a broadcast of their keys (eight bytes each); beyond, by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000
FANOUT = 16
#: Numbers gathered before a task hands on a batch.
FLUSH = 200_000


def _lean(run):
    """``run`` as a function of batches that gives Arrow's free memory back when
    its task ends: workers stay, and would keep it beside the JVM's."""
    def lean(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return lean


def _sets(hasher: WordHasher, column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for row, data, offsets in stretches(column):
        h, bounds, _, _ = hasher.words(data, offsets)
        g, at = shingles(h, bounds, k)
        for d in range(len(at) - 1):
            yield row + d, np.unique(g[at[d]:at[d + 1]])


def _signature(s: np.ndarray) -> tuple[int, int]:
    a = np.sum(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
    b = np.sum(mix(s + np.uint64(0x6A09E667F3BCC909)), dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def resolution(n: int) -> int:
    """Number of groups for a set of n: the first of at least twice as many,
    or half as many where that would be over 256."""
    return RESOLUTIONS[0] if n <= 128 else RESOLUTIONS[1] if n <= 2048 else RESOLUTIONS[2]


def point(s: np.ndarray) -> bytes:
    """Group counts of a set."""
    r = resolution(len(s))
    return _packed(np.bincount((s >> np.uint64(65 - r.bit_length())).astype(np.int64), minlength=r))


def _packed(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes each that hold the largest, behind one byte
    that says how many bytes that is."""
    top = counts.max(initial=0)
    width = 1 if top < 256 else 2 if top < 65536 else 4
    return bytes([width]) + counts.astype({1: np.uint8, 2: np.uint16, 4: np.uint32}[width]).tobytes()


def counts_of(p: bytes) -> np.ndarray:
    return np.frombuffer(p, {1: np.uint8, 2: np.uint16, 4: np.uint32}[p[0]], offset=1)


def folded(counts: np.ndarray, r: int) -> np.ndarray:
    """Counts on a lower resolution: neighbouring groups added up."""
    return counts if len(counts) == r else counts.reshape(r, -1).sum(axis=1)


def coarse(p: bytes) -> bytes | None:
    """A point on the resolution that trees use at most, None if it is there."""
    counts = counts_of(p)
    return _packed(folded(counts, TREE_GROUPS)) if len(counts) > TREE_GROUPS else None


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """The sum of the coordinate minima of two points."""
    r = min(len(x), len(y))
    return int(np.minimum(folded(x, r), folded(y, r)).sum())


def _needed(a, b, num: int, den: int):
    """Least overlap of sets of sizes a and b with den * I >= num * U."""
    return -(-(num * (a + b)) // (num + den))


class CountTree:
    """R-tree over count vectors, packed bottom-up from points in order of
    size and then of their largest-spread coordinates."""

    def __init__(self, pts: np.ndarray, sizes: np.ndarray) -> None:
        wide = np.argsort(-pts.std(axis=0), kind="stable")[:2] if len(pts) else [0, 1]
        self.order = np.lexsort((pts[:, wide[1]], pts[:, wide[0]], sizes))
        self.levels = [(pts[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > FANOUT:
            upper, low, high = self.levels[-1]
            cut = np.arange(0, len(upper), FANOUT)
            self.levels.append((np.maximum.reduceat(upper, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def near(self, p: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Numbers of the points whose bound reaches the overlap needed."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, low, high = self.levels[depth]
            at = at[(high[at] * den >= num * size) & (low[at] * num <= den * size)]
            if depth == 0:
                need = _needed(size, low[at], num, den)
            else:    # the smallest member that is large enough at all needs least
                need = _needed(size, np.maximum(low[at], -(-num * size // den)), num, den)
            at = at[np.minimum(upper[at], p).sum(axis=1) >= need]
            if depth:
                at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


    def near_all(self, pts: np.ndarray, sizes: np.ndarray, num: int, den: int) -> Iterator[np.ndarray]:
        """``near`` of every query; a tree of one leaf is met by all at once."""
        if len(self.levels) > 1 or len(pts) > 4 * FANOUT:
            for p, size in zip(pts, sizes):
                yield self.near(p, int(size), num, den)
            return
        upper, low, _ = self.levels[0]
        bound = np.minimum(upper[None, :, :], pts[:, None, :]).sum(axis=2)
        small, large = np.minimum(low[None, :], sizes[:, None]), np.maximum(low[None, :], sizes[:, None])
        fits = (bound >= _needed(small, large, num, den)) & (small * den >= num * large)
        for row in fits:
            yield self.order[np.flatnonzero(row)]


class BucketLinks:
    """Verifies the sets of one bucket (or of two blocks of it) and keeps the
    components that its links join."""

    def __init__(self, sets: list[np.ndarray], labels: np.ndarray, num: int, den: int) -> None:
        self.sets, self.num, self.den = sets, num, den
        self.root = labels.copy()       # of each set, its component as far as known here

    def linked(self, q: int, others: np.ndarray) -> np.ndarray:
        """Which of the others' sets link with that of ``q``."""
        mine, sizes = self.sets[q], np.array([len(self.sets[o]) for o in others])
        theirs = np.concatenate([self.sets[o] for o in others])
        at = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
        shared = np.add.reduceat((mine[at] == theirs).astype(np.int64), np.cumsum(sizes) - sizes)
        return self.den * shared >= self.num * (len(mine) + sizes - shared)

    def join(self, q: int, found: np.ndarray) -> Iterator[tuple[int, int]]:
        """The links of ``q`` with ``found`` that join two components: a few
        sets of each other component are tried first, then more of those that
        are still apart."""
        tries = 1
        while len(found):
            found = found[self.root[found] != self.root[q]]
            of = self.root[found]
            order = np.argsort(of, kind="stable")
            found, of = found[order], of[order]
            place = np.arange(len(of)) - np.searchsorted(of, of)
            now = found[place < tries]
            if len(now):
                for o in now[self.linked(q, now)]:
                    a, b = self.root[q], self.root[o]
                    if a != b:
                        self.root[self.root == max(a, b)] = min(a, b)
                        yield q, int(o)
            found = found[place >= tries]
            tries *= 4


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of equal keys of sorted batches, each whole."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        columns = [rest.column(k).to_numpy() for k in keys]
        new = np.zeros(len(columns[0]), bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new)]
        for a, b in zip(cuts, cuts[1:]):
            yield rest.slice(a, b - a)
        rest = rest.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


class Sets:
    """The shingle sets of a table's texts, and the steps of the join."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int, doc_id: str = "doc_id", text: str = "text") -> None:
        self.k, self.num, self.den = k, num, den
        self.docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def signatures(self) -> DataFrame:
        """(doc_id, text_hash, n, s1, s2, point, coarse) of every row; coarse is
        the point folded for the trees, null where it is no different."""
        k = self.k

        def run(batches):
            hasher = WordHasher()
            for batch in batches:
                out = [(len(s), *_signature(s), point(s)) for _, s in _sets(hasher, batch.column(2), k)]
                n, s1, s2, pts = zip(*out) if out else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                     pa.array(pts, pa.binary()), pa.array([coarse(p) for p in pts], pa.binary())],
                    ["doc_id", "text_hash", "n", "s1", "s2", "point", "coarse"])

        return self.docs.mapInArrow(_lean(run), "doc_id long, text_hash long, n long, s1 long, s2 long, point binary, coarse binary")

    def levels(self) -> np.ndarray:
        """Rarity level (0 to 255) of every cell of shingle hashes: four
        steps for each doubling of the cell's count over the whole table."""
        k = self.k

        def count(batches):
            hasher, cells = WordHasher(), np.zeros(CELLS, np.int64)
            for batch in batches:
                for _, data, offsets in stretches(batch.column(0)):
                    h, bounds, _, _ = hasher.words(data, offsets)
                    g, _ = shingles(h, bounds, k)
                    cells += np.bincount((g & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
            yield from rows(cells.reshape(-1, CELLS_PER_ROW), range(CELLS // CELLS_PER_ROW))

        def rows(blocks, numbers):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(numbers), pa.int32()), pa.array([b.astype(np.int64).tobytes() for b in blocks], pa.binary())],
                ["block", "counts"])

        def add(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    sums[b] = sums.get(b, 0) + np.frombuffer(c, np.int64)
            if sums:
                yield from rows(sums.values(), sums)

        schema = "block int, counts binary"
        counts = self.docs.select("text").mapInArrow(_lean(count), schema).repartition("block").coalesce(CELLS // CELLS_PER_ROW).mapInArrow(_lean(add), schema)
        cells = np.zeros(CELLS)
        for r in counts.collect():      # a fixed number of cells, whatever the table holds
            cells[r.block * CELLS_PER_ROW:(r.block + 1) * CELLS_PER_ROW] = np.frombuffer(r.counts, np.int64)
        return np.minimum(255, 4 * np.log2(cells + 1)).astype(np.uint8)

    def prefixes(self, levels: np.ndarray) -> DataFrame:
        """(h, s1, n, short, core): the first shingles of every set in the
        common order; ``short``: also among the fewer that a set needs as the
        smaller one of a pair; ``core``: among those that hold the first shingle
        shared with any set it links with.  Equal sets of a task are written once."""
        k, num, den = self.k, self.num, self.den
        shared = self.docs.sparkSession.sparkContext.broadcast(levels)

        def run(batches):
            hasher, order, done = WordHasher(), shared.value.astype(np.uint64) << np.uint64(56), set()
            for batch in batches:
                hs, ids, sizes, shorts, cores, waiting = [], [], [], [], [], 0
                for _, s in _sets(hasher, batch.column(0), k):
                    n = len(s)
                    if not n:
                        continue
                    sig = _signature(s)
                    if sig in done:
                        continue
                    done.add(sig)
                    extra = 1 + n // COMMON_PART
                    long_part = n - -(-num * n // den) + extra
                    short_part = n - -(-2 * num * n // (num + den)) + extra
                    key = order[(s & np.uint64(CELLS - 1)).astype(np.int64)] | (s >> np.uint64(8))
                    first = np.argsort(key, kind="stable")[:long_part]
                    hs.append(s[first].view(np.int64))
                    ids.append(np.full(len(first), sig[0], np.int64))
                    sizes.append(np.full(len(first), n, np.int32))
                    place = np.arange(len(first))
                    shorts.append(place < short_part)
                    cores.append(place < long_part - extra + 1)
                    waiting += len(first)
                    if waiting >= FLUSH:
                        yield rows(hs, ids, sizes, shorts, cores)
                        hs, ids, sizes, shorts, cores, waiting = [], [], [], [], [], 0
                if hs:
                    yield rows(hs, ids, sizes, shorts, cores)

        def rows(*columns):
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["h", "s1", "n", "short", "core"])

        return self.docs.select("text").mapInArrow(_lean(run), "h long, s1 long, n int, short boolean, core boolean")

    def members(self, wanted: DataFrame) -> DataFrame:
        """(s1, s2, grams) of the rows that ``wanted`` (doc_id, text_hash)
        lists, sent everywhere if they are few."""
        k = self.k

        def run(batches):
            hasher = WordHasher()
            for batch in batches:
                out, size = [], 0
                for _, s in _sets(hasher, batch.column(0), k):
                    out.append((*_signature(s), s.tobytes()))
                    size += len(s)
                    if size >= FLUSH:
                        yield rows(out)
                        out, size = [], 0
                yield rows(out)

        def rows(out):
            return pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["s1", "s2", "grams"])

        # one number stands for a row; should two share it, the other's set is made too and not joined
        key = F.xxhash64("doc_id", "text_hash")
        keys = stored(wanted.select(key.alias("_key")), "join-keys")
        if keys.count() <= MAX_BROADCAST_KEYS:
            keys = F.broadcast(keys)
        docs = self.docs.withColumn("_row", key).join(keys, F.col("_row") == F.col("_key"), "left_semi")
        return docs.select("text").mapInArrow(_lean(run), "s1 long, s2 long, grams binary")

    def verified(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """Links (u, v) among the pairs (a, b): bounded by the points first;
        what is left is checked on the sets, made anew from the texts of one
        document of each class.  A document that comes twice repeats its links."""
        num, den = self.num, self.den

        def bound(batches):
            for batch in batches:
                na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
                best = np.array([most_shared(counts_of(x), counts_of(y)) for x, y in zip(
                    batch.column("pa").to_pylist(), batch.column("pb").to_pylist())], np.int64)
                keep = pa.array(best >= _needed(na, nb, num, den))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

        def check(batches):
            for batch in batches:
                keep = []
                for x, y in zip(batch.column("ga"), batch.column("gb")):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = np.concatenate([x, y])
                    both.sort()
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep.append(den * shared >= num * (len(both) - shared))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("u1", "u2", "v1", "v2")], ["u1", "u2", "v1", "v2"])

        def sides(p, left, right, columns):
            p = p.join(left.select(F.col("s1").alias("a"), *[F.col(c).alias(x) for c, x, _ in columns]), "a")
            return p.join(right.select(F.col("s1").alias("b"), *[F.col(c).alias(y) for c, _, y in columns]), "b")

        kept = sides(pairs, classes, classes, [("n", "na", "nb"), ("point", "pa", "pb")])
        kept = kept.filter(f"{den} * least(na, nb) >= {num} * greatest(na, nb)").mapInArrow(_lean(bound), "a long, b long")
        kept = stored(kept, f"join-{name}-pairs")
        ends = kept.select(F.col("a").alias("s1")).unionByName(kept.select(F.col("b").alias("s1"))).distinct()
        members = stored(self.members(classes.join(ends, "s1").select("r.doc_id", "r.text_hash")), f"join-{name}-members")
        full = sides(kept, members, members, [("s1", "u1", "v1"), ("s2", "u2", "v2"), ("grams", "ga", "gb")])
        links = full.select("u1", "u2", "v1", "v2", "ga", "gb").mapInArrow(_lean(check), "u1 long, u2 long, v1 long, v2 long")
        links = links.select(F.struct(F.col("u1").alias("s1"), F.col("u2").alias("s2")).alias("u"),
                             F.struct(F.col("v1").alias("s1"), F.col("v2").alias("s2")).alias("v"))
        return stored(links, f"join-{name}-links")

    def tree_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs (a, b) of different labels out of the buckets' trees, for ``links``.
        ``rows``: h, s1, n, short, label, point, and _n, the rows of h."""
        num, den = self.num, self.den
        rows = rows.withColumn("_blocks", F.ceil(F.col("_n") / BLOCK).cast("int"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("s1"), F.col("_blocks")).cast("int"))
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        rows = rows.select("h", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"),
                           "own", "s1", "n", "short", "label", "point")

        def flush(parts):
            pairs = np.unique(np.concatenate(parts, axis=1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

        def run(batches):
            parts, waiting = [], 0
            for t in _grouped(batches, ["h", "i", "j"]):
                full = [counts_of(p) for p in t.column("point").to_pylist()]
                least = min(map(len, full))
                pts = np.stack([folded(c, least) for c in full])
                ids, n = t.column("s1").to_numpy(), t.column("n").to_numpy().astype(np.int64)
                short = t.column("short").to_numpy(zero_copy_only=False).astype(bool)
                label, own = t.column("label").to_numpy(), t.column("own").to_numpy()
                i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
                tree_side, queries = np.flatnonzero(own == j), np.flatnonzero(own == i)
                tree = CountTree(pts[tree_side], n[tree_side])
                for q, found in zip(queries, tree.near_all(pts[queries], n[queries], num, den)):
                    found = tree_side[found]
                    found = found[(label[found] != label[q]) & ((short[q] & (n[q] <= n[found])) | (short[found] & (n[found] <= n[q])))]
                    if len(full[q]) > least:
                        found = found[[most_shared(full[q], full[f]) >= _needed(int(n[q]), int(n[f]), num, den) for f in found]]
                    if len(found):
                        parts.append(np.stack([np.minimum(ids[q], ids[found]), np.maximum(ids[q], ids[found])]))
                        waiting += len(found)
                if waiting >= FLUSH:
                    yield flush(parts)
                    parts, waiting = [], 0
            if parts:
                yield flush(parts)

        dealt = rows.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
        return dealt.mapInArrow(_lean(run), "a long, b long").distinct()

    @staticmethod
    def in_blocks(rows: DataFrame, columns: list[str]) -> DataFrame:
        """Rows of buckets dealt to pairs of blocks (h, i, j); ``own`` is the row's block."""
        rows = rows.withColumn("_blocks", F.greatest(F.ceil(F.col("_n") / BLOCK), F.ceil(F.col("_grams") / BLOCK_GRAMS)).cast("int"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("s1"), F.col("_blocks")).cast("int"))
        rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        rows = rows.select("h", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"), "own", *columns)
        return rows.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")

    @staticmethod
    def open_rows(rows: DataFrame) -> DataFrame:
        """The rows (h, s1, n, label, short) of buckets that hold two
        components, with their number of sets and of shingles.  Of buckets with
        the same sets, known by two hashes of them, one stands for all: near
        copies of a long text share hundreds of prefix shingles."""
        in_bucket = Window.partitionBy("h")
        rows = rows.select("h", "s1", "n", "label", "short", F.xxhash64("s1").alias("_a"), F.xxhash64("s1", F.lit(1)).alias("_b"))
        rows = rows.withColumns({
            "_low": F.min("label").over(in_bucket), "_high": F.max("label").over(in_bucket), "_n": F.count("*").over(in_bucket),
            "_grams": F.sum("n").over(in_bucket), "_x": F.bit_xor("_a").over(in_bucket), "_y": F.bit_xor("_b").over(in_bucket)}).filter("_low < _high")
        # each set is in all buckets of the same sets, so its least bucket of them is that of all
        same = rows.groupBy("_n", "_x", "_y", "s1").agg(
            F.min("h").alias("h"), F.first("n").alias("n"), F.first("label").alias("label"), F.max("short").alias("short"), F.first("_grams").alias("_grams"))
        return same.select("h", "s1", "n", "label", "short", "_n", "_grams")

    def with_partners(self, rows: DataFrame, pts: DataFrame, done: DataFrame | None = None) -> DataFrame:
        """The ``rows`` of open buckets that the trees leave a partner of
        another label.  ``done`` (s1, h): buckets verified before; two sets that
        met in one of them are settled and no partners."""
        num, den = self.num, self.den
        shown = rows.join(pts, "s1")
        if done is None:
            shown = shown.withColumn("done", F.array().cast("array<long>"))
        else:
            met = done.groupBy("s1").agg(F.collect_list("h").alias("done"))
            shown = shown.join(met, "s1", "left").withColumn("done", F.coalesce("done", F.array().cast("array<long>")))

        def run(batches):
            kept, waiting = [], 0
            for t in _grouped(batches, ["h", "i", "j"]):
                full = [counts_of(p) for p in t.column("point").to_pylist()]
                least = min(map(len, full))
                pts = np.stack([folded(c, least) for c in full])
                n = t.column("n").to_numpy().astype(np.int64)
                short = t.column("short").to_numpy(zero_copy_only=False).astype(bool)
                label, own = t.column("label").to_numpy(), t.column("own").to_numpy()
                tree_side, queries = np.flatnonzero(own == t.column("j")[0].as_py()), np.flatnonzero(own == t.column("i")[0].as_py())
                left, before = np.zeros(len(n), bool), t.column("done").to_pylist()
                number = {b: i for i, b in enumerate({b for bs in before for b in bs})}
                was_in = np.zeros((len(n), len(number)), bool)
                for i, bs in enumerate(before):
                    was_in[i, [number[b] for b in bs]] = True
                tree = CountTree(pts[tree_side], n[tree_side])
                for q, found in zip(queries, tree.near_all(pts[queries], n[queries], num, den)):
                    found = tree_side[found]
                    found = found[(label[found] != label[q]) & ((short[q] & (n[q] <= n[found])) | (short[found] & (n[found] <= n[q])))]
                    if number:
                        found = found[~(was_in[found] & was_in[q]).any(axis=1)]
                    if len(full[q]) > least:
                        found = found[[most_shared(full[q], full[f]) >= _needed(int(n[q]), int(n[f]), num, den) for f in found]]
                    if len(found):
                        left[q] = left[found] = True
                kept.append(t.select(columns).filter(pa.array(left)))
                waiting += len(kept[-1])
                if waiting >= FLUSH:
                    yield from pa.concat_tables(kept).to_batches()
                    kept, waiting = [], 0
            if waiting:
                yield from pa.concat_tables(kept).to_batches()

        columns = ["h", "s1", "n", "label", "short"]
        near = self.in_blocks(shown, [*columns[1:], "point", "done"]).mapInArrow(_lean(run), "h long, s1 long, n int, label long, short boolean")
        return near.repartition("h").dropDuplicates(["h", "s1"])

    def bucket_links(self, rows: DataFrame) -> DataFrame:
        """Links (u, v) that join two components of a bucket, from ``rows`` (h,
        s1, s2, n, label, grams, rest, _n, _grams).  ``rest``: the set's buckets
        of this round in order, null if it is in one only."""
        num, den = self.num, self.den

        def run(batches):
            for t in _grouped(batches, ["h", "i", "j"]):
                grams = [np.frombuffer(g.as_buffer(), np.uint64) for g in t.column("grams").combine_chunks()]
                rest = [None if r is None else set(r) for r in t.column("rest").to_pylist()]
                h, i, j = (t.column(c)[0].as_py() for c in ("h", "i", "j"))
                n, own = np.array([len(g) for g in grams]), t.column("own").to_numpy()
                full = [counts_of(point(g)) for g in grams]
                least = min(map(len, full))
                pts = np.stack([folded(c, least) for c in full])
                tree_side, queries = np.flatnonzero(own == j), np.flatnonzero(own == i)
                tree, known, out = CountTree(pts[tree_side], n[tree_side]), BucketLinks(grams, t.column("label").to_numpy(), num, den), []
                for q, found in zip(queries, tree.near_all(pts[queries], n[queries], num, den)):
                    found = tree_side[found]
                    found = found[found > q] if i == j else found
                    if rest[q] is not None:         # the pair's first bucket in common
                        found = found[known.root[found] != known.root[q]]
                        found = found[[min(rest[q] & rest[f]) == h for f in found]] if len(found) else found
                    out += known.join(int(q), found.astype(np.int64))
                if out:
                    u, v = map(list, zip(*out))
                    ends = [t.column(c).take(pa.array(k)).combine_chunks() for k in (u, v) for c in ("s1", "s2")]
                    yield pa.RecordBatch.from_arrays(ends, ["u1", "u2", "v1", "v2"])

        dealt = self.in_blocks(rows, ["s1", "s2", "label", "grams", "rest"])
        links = dealt.mapInArrow(_lean(run), "u1 long, u2 long, v1 long, v2 long")
        return stored(links.select(F.struct(F.col("u1").alias("s1"), F.col("u2").alias("s2")).alias("u"),
                                   F.struct(F.col("v1").alias("s1"), F.col("v2").alias("s2")).alias("v")), "join-bucket-links")

    def closed(self, rows: DataFrame, classes: DataFrame, labels: DataFrame | None) -> DataFrame:
        """The components once every bucket of ``rows`` (h, s1, n, short, core,
        label) has been verified or holds one component."""
        pts = classes.select("s1", F.coalesce("coarse", "point").alias("point")).dropDuplicates(["s1"])
        rows = rows.filter("core").select("h", "s1", "n", "short", "label")
        rows = stored(self.open_rows(self.with_partners(stored(self.open_rows(rows), "join-open"), pts)), "join-open")
        if rows.isEmpty():
            return labels
        ends = rows.select("s1").distinct()
        sets = stored(self.members(classes.join(ends, "s1").select("r.doc_id", "r.text_hash")).dropDuplicates(["s1", "s2"]), "join-sets")
        done = None
        for turn in range(BUCKET_ROUNDS + 1):
            if done is not None:        # only sets that have not met all of their partners go on
                rows = stored(self.open_rows(rows), "join-open")
                rows = stored(self.open_rows(self.with_partners(rows, pts, done)), "join-open")
                if rows.isEmpty():
                    break
            if turn < BUCKET_ROUNDS:
                # buckets that are the fullest one of half their sets: whole buckets, and on average two places a set
                fullest = rows.groupBy("s1").agg(F.max(F.struct("_n", "h")).alias("_best")).groupBy(F.col("_best.h").alias("h"), F.col("_best._n").alias("_of")).count()
                chosen = fullest.filter("2 * count >= _of").select("h")
                dealt = stored(rows.join(chosen.withColumn("_now", F.lit(True)), "h", "left"), "join-turn")
                now = dealt.filter("_now").drop("_now").withColumn("rest", F.lit(None).cast("array<long>"))
                rows = dealt.filter("_now is null").drop("_now")
            else:
                now = rows.join(rows.groupBy("s1").agg(F.sort_array(F.collect_list("h")).alias("rest")), "s1")
                rows = rows.limit(0)
            visits = now.select("s1", "h")
            done = visits if done is None else done.unionByName(visits)
            labels = self.merged(labels, self.bucket_links(now.join(sets.select("s1", "s2", "grams"), "s1")))
            if labels is not None:
                found = labels.select(F.col("node.s1").alias("s1"), F.col("root.s1").alias("_label")).dropDuplicates(["s1"])
                rows = rows.join(found, "s1", "left").withColumn("label", F.coalesce("_label", "label")).drop("_label")
        return labels

    @staticmethod
    def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
        """Components of the links so far (their stars stand for them) and the new ones."""
        if labels is None:
            return connected(links)
        if links.isEmpty():
            return labels
        return connected(labels.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))

    def buckets(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Signatures of the rows; (h, s1, n, short, core), the buckets of two
        sets or more; the classes with one of their documents and the point."""
        signatures = stored(self.signatures(), "join-signatures")
        in_bucket = Window.partitionBy("h")
        rows = self.prefixes(self.levels()).repartition("h").dropDuplicates(["h", "s1"])
        rows = rows.withColumns({"_low": F.min("s1").over(in_bucket), "_high": F.max("s1").over(in_bucket)}).filter("_low < _high")
        enough = F.expr(f"1 + ceil({self.num} * n / {self.den}) div {COMMON_PART}")
        rows = rows.withColumn("_shared", F.count("*").over(Window.partitionBy("s1"))).filter(F.col("_shared") >= enough)
        shared = stored(rows.select("h", "s1", "n", "short", "core"), "join-buckets")

        classes = stored(signatures.filter("n > 0").groupBy("s1", "s2").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("r"), F.first("n").alias("n"), F.first("point").alias("point"),
            F.first("coarse").alias("coarse")), "join-classes")
        return signatures, shared, classes

    def open_pairs(self, rows: DataFrame, classes: DataFrame) -> DataFrame:
        """Pairs (a, b) of different labels that buckets of ``rows`` (h, s1, n,
        short, core, label) leave to verify."""
        in_bucket, fits = Window.partitionBy("h"), f"{self.den} * least({{0}}, {{1}}) >= {self.num} * greatest({{0}}, {{1}})"
        # a pair's first shared shingle is a core one of both: the rest has served to count
        by_size = Window.partitionBy("h").orderBy("n")
        rows = rows.filter("core").withColumns({"_less": F.lag("n").over(by_size), "_more": F.lead("n").over(by_size)})
        rows = rows.filter(f"coalesce({fits.format('_less', 'n')}, false) or coalesce({fits.format('n', '_more')}, false)")
        rows = rows.withColumns({"_low": F.min("label").over(in_bucket), "_high": F.max("label").over(in_bucket), "_n": F.count("*").over(in_bucket)})
        rows = stored(rows.filter("_low < _high").select("h", "s1", "n", "short", "label", "_n"), "join-open-buckets")
        two = rows.filter("_n = 2").groupBy("h").agg(F.min(F.struct("n", "short", "s1")).alias("x"), F.max(F.struct("n", "short", "s1")).alias("y"))
        two = two.filter("x.short or (x.n = y.n and y.short)").select(F.least("x.s1", "y.s1").alias("a"), F.greatest("x.s1", "y.s1").alias("b"))
        pts = classes.select("s1", F.coalesce("coarse", "point").alias("point")).dropDuplicates(["s1"])
        many = self.tree_pairs(rows.filter("_n > 2").join(pts, "s1"))
        return two.unionByName(many).distinct()

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Signatures of the rows, and the links (u, v) of all pairs of classes:
        no label spares a pair, so the work grows with the links of a group."""
        signatures, shared, classes = self.buckets()
        return signatures, stored(self.verified(self.open_pairs(shared.withColumn("label", F.col("s1")), classes), classes, "all").distinct(), "join-links")

    def classes(self) -> DataFrame:
        """(doc_id, text_hash, n, s1, s2, root): root is the smallest class
        of the component, as a struct of s1 and s2."""
        signatures, shared, classes = self.buckets()
        in_bucket, fits = Window.partitionBy("h"), f"{self.den} * least({{0}}, {{1}}) >= {self.num} * greatest({{0}}, {{1}})"
        labels, met = None, None
        rows = shared.withColumn("label", F.col("s1"))
        for turn in range(STAR_ROUNDS):
            led = rows.withColumn("leader", F.min(F.struct("label", "s1", "n")).over(in_bucket))
            led = led.filter("label <> leader.label and " + fits.format("n", "leader.n")).groupBy("s1", F.col("leader.s1").alias("to")).count()
            best = Window.partitionBy("s1").orderBy(F.desc("count"), "to")
            led = led.withColumn("_rank", F.row_number().over(best)).filter(f"_rank <= {STARS}")
            led = led.select(F.least("to", "s1").alias("a"), F.greatest("to", "s1").alias("b")).distinct()
            led = stored(led if met is None else led.join(met, ["a", "b"], "left_anti"), "join-stars")
            met = led if met is None else met.unionByName(led)
            links = self.verified(led, classes, "star")
            labels = self.merged(labels, links)
            found = labels.select(F.col("node.s1").alias("s1"), F.col("root.s1").alias("_label"))
            rows = stored(shared.join(found, "s1", "left").select("h", "s1", "n", "short", "core", F.coalesce("_label", "s1").alias("label")), "join-labelled")

        labels = self.closed(rows, classes, labels)
        own = F.struct(F.col("s1").alias("s1"), F.col("s2").alias("s2"))
        out = signatures.withColumn("_node", own)
        out = out.withColumn("root", own) if labels is None else out.join(labels, F.col("_node") == F.col("node"), "left")
        return out.select("doc_id", "text_hash", "n", "s1", "s2", F.coalesce("root", "_node").alias("root"))


def components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, keeper): documents link
    when den * intersection >= num * union; component_id is the smallest
    doc_id reachable.  ``keeper``: the (doc_id, text_hash) that stands for
    the component.  A document without shingles is its own component."""
    rows = Sets(docs, k, num, den).classes()
    first = rows.filter("n > 0").groupBy("root").agg(
        F.min("doc_id").alias("component_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("keeper"))
    out = rows.join(first.withColumnRenamed("root", "_root"), (F.col("root") == F.col("_root")) & (F.col("n") > 0), "left")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    return out.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("keeper")).otherwise(own).alias("keeper"))


def links(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """All links, where ``components`` looks only for enough of them.

    First (a, b): the pairs of different classes that link, each once; a class
    is a struct of s1 and s2 and stands for all documents of one shingle set.
    Second (doc_id, text_hash, n_shingles, class, n_links) for every row: its
    class, null without shingles, and the number of other rows it links with,
    those of its own class among them.  Half the sum of n_links is the number
    of links between rows."""
    signatures, found = Sets(docs, k, num, den).links()
    pairs = found.select(F.col("u").alias("a"), F.col("v").alias("b"))
    rows = signatures.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.struct("s1", "s2")).alias("class"))
    sizes = stored(rows.filter("n_shingles > 0").groupBy("class").agg(F.count("*").alias("size")), "join-class-sizes")
    ends = pairs.select(F.col("a").alias("_end"), F.col("b").alias("class")).unionByName(pairs.select(F.col("b").alias("_end"), F.col("a").alias("class")))
    others = ends.join(sizes, "class").groupBy("_end").agg(F.sum("size").alias("_others"))
    counts = sizes.join(others, sizes["class"] == others["_end"], "left").select(
        F.col("class").alias("_class"), (F.col("size") - 1 + F.coalesce("_others", F.lit(0))).alias("_links"))
    members = rows.join(counts, rows["class"] == counts["_class"], "left")
    return pairs, members.select("doc_id", "text_hash", "n_shingles", "class", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` (with doc_id and text) that stand for their
    component, one of each; rows without words stay, repeated ones too."""
    rows, (doc_id, text), names = masked(docs, "doc_id", "text")
    found = components(rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), k, num, den)
    keepers = found.filter("n_shingles > 0").select(
        F.col("keeper.doc_id").alias("k_id"), F.col("keeper.text_hash").alias("k_hash")).distinct()
    keepers = keepers.withColumn("key", F.xxhash64("k_id", "k_hash"))
    rows = rows.withColumn("hash", F.xxhash64(text))
    rows = rows.withColumn("key", F.xxhash64(F.col(doc_id).cast("long"), "hash"))
    out = rows.join(keepers, (rows["key"] == keepers["key"]) & F.col(doc_id).eqNullSafe(F.col("k_id")) & (F.col("hash") == F.col("k_hash")), "left")
    out = out.withColumn("row_key", rows["key"]).drop("key")
    # equal rows of one id: the first; the join has dealt them by their key already
    one = out.filter(F.col("k_hash").isNotNull()).dropDuplicates(["row_key", "k_id", "k_hash"])
    no_words = F.coalesce(~F.col(text).rlike(WORD), F.lit(True))
    return unmasked(one.unionByName(out.filter(F.col("k_hash").isNull() & no_words)), names)


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return components(docs, 4, 85, 100).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(list_slice(words, i, i + 3), ' ')) AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g, count(*) AS df FROM s GROUP BY g),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM (SELECT s.* FROM s JOIN f USING (g) WHERE df > 1) a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a AS u, b AS v FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id AS u, doc_id AS c FROM documents
  UNION
  SELECT e.v, r.c FROM r JOIN e ON e.u = r.u WHERE r.c < e.v)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(c) FROM r WHERE r.u = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
"""
