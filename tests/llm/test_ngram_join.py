import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from odflow.llm import ngram_join as N
from odflow.llm.components import connected
from odflow.llm.textvec import WordHasher, shingles, stretches
from tests.llm import brute


def near_copies(seed=5):
    """Families of near copies around the threshold, chains, shared passages."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [r.choice(vocabulary) for _ in range(40)]
    out = []
    for family in range(9):
        words = [r.choice(vocabulary) for _ in range(r.choice([6, 30, 90, 160]))]
        if family % 3 == 0:
            words += passage
        for _ in range(r.choice([1, 4, 14])):
            out.append(" ".join(words))
            words = list(words)
            for _ in range(r.randint(0, max(1, len(words) // 40))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
    out += ["", None, "a", "A", "a b c", "b c d e", " ".join(passage)] + out[:5]
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [2048, 3])
def test_components_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 60, 100).collect()}
    sets = [brute.shingle_set(t, 3) for _, t in rows]
    want = brute.component_ids(sets, [i for i, _ in rows], 60, 100)
    assert got == {i: (len(s), c) for (i, _), s, c in zip(rows, sets, want)}


def test_one_row_of_each_component_stays(spark):
    rows = near_copies(6)
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), 3, 60, 100).collect()
    sets = [brute.shingle_set(t, 3) for _, t in rows]
    want = brute.component_ids(sets, [i for i, _ in rows], 60, 100)
    assert sorted(r.doc_id for r in kept) == sorted(set(want))
    assert all(r.text == rows[r.doc_id][1] for r in kept)


def test_edges(spark, edge_dir, empty_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").collect()]
    sets = [brute.shingle_set(t, 4) for _, t in rows]
    want = brute.component_ids(sets, [i for i, _ in rows], 85, 100)
    want = [w if s else i for (i, _), s, w in zip(rows, sets, want)]
    got = N.op1_ngram_join(spark, edge_dir).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, len(s), w) for (i, _), s, w in zip(rows, sets, want))
    assert N.op1_ngram_join(spark, empty_dir).collect() == []
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text for r in kept.collect())[None] == 2        # rows without words stay


def test_tree_finds_every_pair_that_its_bound_allows():
    r = np.random.default_rng(2)
    base = r.integers(0, 12, (30, 64))
    pts = np.concatenate([np.maximum(0, base + r.integers(-1, 2, base.shape)) for _ in range(9)])
    sizes = pts.sum(axis=1)
    tree = N.CountTree(pts, sizes)
    for q in range(len(pts)):
        overlap = np.minimum(pts, pts[q]).sum(axis=1)
        want = {i for i in range(len(pts)) if 100 * overlap[i] >= 85 * (sizes[i] + sizes[q] - overlap[i])}
        assert want <= set(tree.near(pts[q], int(sizes[q]), 85, 100).tolist())
        leaf = N.CountTree(pts[:N.FANOUT], sizes[:N.FANOUT])
        assert sorted(next(leaf.near_all(pts[q:q + 1], sizes[q:q + 1], 85, 100))) == sorted(leaf.near(pts[q], int(sizes[q]), 85, 100))
        assert set(tree.near(pts[q], int(sizes[q]), 85, 100).tolist()) <= {
            i for i in range(len(pts)) if overlap[i] >= N._needed(sizes[i], sizes[q], 85, 100)}


def test_connected_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100 + r.randrange(40), 100 + r.randrange(40)) for _ in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = {x.node: x.root for x in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_word_hashes_over_whole_columns(monkeypatch):
    from odflow.llm import textvec

    monkeypatch.setattr(textvec, "STRETCH", 64)
    texts = ["", None, " a b", "A B ", "x\ty\nz", "é" * 100, "one two three", "\x0b", "ab" * 200 + " cd"]
    hasher, seen = WordHasher(), {}
    for row, data, offsets in stretches(pa.array(texts)):
        h, bounds, _, _ = hasher.words(data, offsets)
        for d in range(len(bounds) - 1):
            words = brute.WORD.findall(brute.lower_ascii(texts[row + d] or ""))
            mine = h[bounds[d]:bounds[d + 1]].tolist()
            assert len(mine) == len(words)
            for w, x in zip(words, mine):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_short_texts_are_one_shingle():
    h = np.arange(1, 8, dtype=np.uint64)
    g, at = shingles(h, np.array([0, 0, 2, 7]), 4)
    assert at.tolist() == [0, 0, 1, 3] and len(set(g.tolist())) == 3


def test_points_of_any_size():
    for n in (3, 300, 5000, 200_000, 30_000_000):
        s = np.concatenate([np.full(n, 1 << 57, np.uint64), np.arange(0, 256, dtype=np.uint64) << np.uint64(56)])
        got = N.counts_of(N.point(s))
        assert len(got) == N.resolution(n + 256) and got.sum() == n + 256
        assert N.folded(got, 256).tolist() == np.bincount((s >> np.uint64(56)).astype(int), minlength=256).tolist()
        few = N.counts_of(N.coarse(N.point(s)) or N.point(s))
        assert len(few) <= N.TREE_GROUPS and few.tolist() == N.folded(got, len(few)).tolist()
    r = np.random.default_rng(1)
    for a, b in ((40, 60), (300, 5000), (20_000, 900)):
        x, y = np.unique(r.integers(0, 2**64, a, dtype=np.uint64)), np.unique(r.integers(0, 2**64, b, dtype=np.uint64))
        y[: min(a, b) // 2] = x[: min(a, b) // 2]
        assert N.most_shared(N.counts_of(N.point(x)), N.counts_of(N.point(y))) >= len(np.intersect1d(x, y))


@pytest.mark.parametrize("stars,rounds,block,grams", [(0, 0, 2048, 1 << 21), (0, 2, 2048, 60), (1, 2, 3, 60)])
def test_buckets_alone_find_the_components(spark, monkeypatch, stars, rounds, block, grams):
    """Without or with leaders, in one round or several, in blocks or not."""
    monkeypatch.setattr(N, "STAR_ROUNDS", stars)
    monkeypatch.setattr(N, "BUCKET_ROUNDS", rounds)
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "BLOCK_GRAMS", grams)
    rows = near_copies(7)
    got = {r.doc_id: r.component_id for r in N.components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 60, 100).collect()}
    want = brute.component_ids([brute.shingle_set(t, 3) for _, t in rows], [i for i, _ in rows], 60, 100)
    assert got == {i: c for (i, _), c in zip(rows, want)}


def test_links_of_a_bucket_join_components_only():
    """Links handed on make a forest, and its trees are the components."""
    r = np.random.default_rng(3)
    sets, labels = [], []
    for family in range(4):
        base = r.integers(0, 1 << 40, 60).astype(np.uint64)
        for _ in range(30):
            s = base.copy()
            s[r.integers(0, 60, 6)] = r.integers(0, 1 << 40, 6)
            sets.append(np.unique(s))
            labels.append(len(labels) // 3)             # three sets of a label from the start
    known = N.BucketLinks(sets, np.array(labels), 75, 100)
    out = [p for q in range(len(sets)) for p in known.join(q, np.arange(q + 1, len(sets)))]

    def roots(pairs):
        parent = list(range(len(sets)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, label in enumerate(labels):
            parent[find(i)] = find(labels.index(label))
        for a, b in pairs:
            parent[find(a)] = find(b)
        return [find(i) for i in range(len(sets))]

    every = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    want, got = roots(every), roots(out)
    assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))
    assert len(out) == len(set(labels)) - len(set(got)) < len(every)


def test_rows_of_a_group_grow_with_its_sets(spark):
    """A group of near copies where most pairs are no links: no step writes pairs."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(120)]

    def group(n):
        out = []
        for _ in range(n):
            w = list(words)
            for k in r.sample(range(len(w)), 5):
                w[k] = f"x{r.randrange(10**6)}"
            out.append(" ".join(w))
        return list(enumerate(out))

    counts = {}
    for n in (60, 120):
        sets = N.Sets(spark.createDataFrame(group(n), "doc_id long, text string"), 4, 85, 100)
        signatures, shared, classes = sets.buckets()
        rows = shared.withColumn("label", shared.s1)
        core = sets.open_rows(rows.filter("core"))
        near = sets.with_partners(core, classes.selectExpr("s1", "coalesce(coarse, point) as point"))
        counts[n] = (core.count(), near.count())
        assert near.count() <= core.count()
    assert counts[120][1] <= 3 * max(1, counts[60][1])
