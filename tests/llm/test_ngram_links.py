import random
from collections import Counter

import pytest

from odflow.llm import ngram_join as N
from tests.llm import brute
from tests.llm.test_ngram_join import near_copies


@pytest.mark.parametrize("block", [2048, 3])
def test_no_link_is_missing(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    r = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    # a group whose members nearly all link, in one component after a few links
    group = [" ".join(w if i != at else f"x{at}" for i, w in enumerate(base)) for at in (r.randrange(60) for _ in range(40))]
    rows = list(enumerate([t for _, t in near_copies()] + group))
    sets = [frozenset(brute.shingle_set(t, 3)) for _, t in rows]
    linked = lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 60 * len(a | b)
    pairs, members = N.links(spark.createDataFrame(rows, "doc_id long, text string"), 3, 60, 100)
    got = {x.doc_id: x for x in members.collect()}
    assert {i: x.n_links for i, x in got.items()} == {i: sum(linked(sets[i], sets[j]) for j, _ in rows if i != j) for i, _ in rows}
    assert all((got[i]["class"] == got[j]["class"]) == (sets[i] == sets[j]) for i, _ in rows for j, _ in rows)
    found = Counter(frozenset((tuple(x.a), tuple(x.b))) for x in pairs.collect())
    classes = {s: tuple(got[i]["class"]) for i, s in enumerate(sets) if s}
    assert found == Counter(frozenset((classes[a], classes[b])) for a in classes for b in classes if classes[a] < classes[b] and linked(a, b))


def test_links_of_edge_tables(spark, edge_dir, empty_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").select("doc_id", "text")
    rows = [brute.shingle_set(x.text, 4) for x in docs.collect()]
    want = Counter((len(s), sum(bool(s and t) and 100 * len(s & t) >= 85 * len(s | t) for t in rows) - bool(s)) for s in rows)
    assert Counter((x.n_shingles, x.n_links) for x in N.links(docs, 4, 85, 100)[1].collect()) == want
    pairs, members = N.links(spark.read.parquet(f"{empty_dir}/documents.parquet"))
    assert pairs.count() == members.count() == 0


def test_open_buckets_of_equal_sets_are_one_and_take_two_shuffles(spark):
    rows = [(1, 10, 5, 10, False), (1, 11, 6, 11, True), (2, 10, 5, 10, True), (2, 11, 6, 11, False),      # the same two sets
            (3, 10, 5, 10, False), (3, 12, 7, 10, True),                                                   # one component: closed
            (4, 10, 5, 10, False), (4, 11, 6, 11, False), (4, 13, 4, 13, False)]
    found = N.Sets.open_rows(spark.createDataFrame(rows, "h long, s1 long, n int, label long, short boolean"))
    assert sorted((r.h, r.s1, r.n, r.label, r.short, r._n, r._grams) for r in found.collect()) == [
        (1, 10, 5, 10, True, 2, 11), (1, 11, 6, 11, True, 2, 11),
        (4, 10, 5, 10, False, 3, 15), (4, 11, 6, 11, False, 3, 15), (4, 13, 4, 13, False, 3, 15)]
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") <= 2
