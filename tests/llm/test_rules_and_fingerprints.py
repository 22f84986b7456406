import hashlib
import math
import re
from collections import Counter

import duckdb
import pytest

from odflow.llm import quality_rules as Q
from odflow.llm import spotsigs as S
from tests.llm import brute


def base_counts(text):
    text = text or ""
    words = brute.WORD.findall(text)
    lines = [x for x in text.split("\n") if brute.WORD.search(x)]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def check_base(rows, got):
    want = Counter()
    for i, t in rows:
        c = base_counts(t)
        want[(i, *c, c[0] < 20 or 100 * c[4] > 30 * c[0])] += 1
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)


def test_base_counts(spark, edge_dir, empty_dir, small_docs):
    check_base(small_docs, Q.op4_line_cleaning(spark, "/root/testdata/sf0.001").collect())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{edge_dir}/documents.parquet").collect()]
    check_base(rows, Q.op4_line_cleaning(spark, edge_dir).collect())
    assert Q.op4_line_cleaning(spark, empty_dir).count() == 0


def test_lines_are_judged_one_by_one(spark):
    good = "This is a plain sentence that any cleaner should keep in the text."
    bad = ["Home | News | Sport | Contact", "BUY!! NOW!! CHEAP!! DEALS!!", "***### $$$ %%% &&&", "Please accept cookies to go on",
           "THIS LINE IS ALL CAPITALS", "----------", "Menu", good]
    text = "\n".join([good, *bad, good.replace("plain", "second"), "  "])
    r = Q.clean_lines(spark.createDataFrame([(1, text), (2, None)], "id long, text string")).orderBy("id").collect()
    assert r[0].clean_text == good + "\n" + good.replace("plain", "second")
    assert (r[0].n_lines, r[0].n_dup_lines) == (10, 1) and (r[1].clean_text, r[1].n_lines) == ("", 0)


def test_kept_follows_quality_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = {r.doc_id: r for r in Q.op4_line_cleaning(spark, "/root/testdata/sf0.01").collect()}
    clean = [got[d] for d, q in labels.items() if q == 1 and d in got and not got[d].base_failed]
    junk = [got[d] for d, q in labels.items() if q == 0 and d in got]
    assert all(r.kept for r in clean) and sum(r.kept for r in junk) <= 0.02 * len(junk)


def test_rules_match_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    df = Q.op4_line_cleaning(spark, "/root/testdata/sf0.001")
    res = con.execute(f"SELECT {', '.join(df.columns)} FROM ({Q.ORACLE})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(res)


def signatures(text):
    """Multiset of (anchor, chain) of a text."""
    words = [w for w in re.split(r"[^\w]+|_+", (text or "").lower()) if w]
    return words


def spots(text, hash_of):
    words, stop = signatures(text), set(S.ANCHORS)
    out = Counter()
    for i, w in enumerate(words):
        if len(words) < S.SHORT_TEXT or w in stop or hash_of[w] % S.EVERY == 0:
            chain = [x for x in words[i + 1:i + 1 + S.REACH] if x not in stop][:S.CHAIN]
            out[(w, *chain)] += 1
    return out


def likeness(a, b):
    if not a and not b:
        return 1.0
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def check_fingerprints(spark, path):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = {r.doc_id: r for r in S.op2_spot_signatures(spark, path).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: -r[0])
    words = sorted({w for _, t in rows for w in signatures(t)})
    hashed = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "hash(w) as h").collect()
    hash_of = {r.w: r.h for r in hashed}
    edited = {}
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        m = len(t) // 3
        edited[i] = t[:len(t) - m] + after[:m]
        assert got[i].edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest() and got[i].n_chars == len(t)
    for w in {w for t in edited.values() for w in signatures(t)} - set(hash_of):    # words cut in two
        hash_of[w] = spark.sql("SELECT hash(:w) AS h", {"w": w}).first().h
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        if signatures(t) and signatures(after):
            assert math.isclose(got[i].near_edited, likeness(spots(t, hash_of), spots(edited[i], hash_of)), abs_tol=1e-9), i
            assert math.isclose(got[i].near_next, likeness(spots(t, hash_of), spots(after, hash_of)), abs_tol=1e-9), i
    prints = {}
    for i, t in rows:
        assert prints.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        assert len(got[i].fingerprint) == 8 * got[i].n_signatures


def test_fingerprints_match_brute_force(spark, tmp_path, small_docs):
    docs = [(i, t) for i, t in small_docs if len(t) < 1500][:60] + [(9001, ""), (9002, None), (9003, "..."), (9004, "one")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    check_fingerprints(spark, str(tmp_path))


def test_next_row_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 3)
    ids = [5, 6, 7, 100, 101, 5000, -3, 12, 13, 14, 15, 16]
    df = spark.createDataFrame([(i, f"t{i}", [i]) for i in ids], "doc_id long, text string, sigs array<int>")
    got = {r.doc_id: (r.next_text, r.next_sigs) for r in S.with_next(df, len(ids)).collect()}
    order = sorted(ids, reverse=True)
    assert got == {i: (f"t{order[(k + 1) % len(order)]}", [order[(k + 1) % len(order)]]) for k, i in enumerate(order)}


def test_fingerprint_edges(spark, edge_dir, empty_dir):
    got = S.op2_spot_signatures(spark, edge_dir).collect()
    assert len(got) == spark.read.parquet(f"{edge_dir}/documents.parquet").count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert S.op2_spot_signatures(spark, empty_dir).count() == 0


def test_pruned_jaccard(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 3, 4, 5]), ([1], [1, 2, 3, 4, 5]), ([], [])], "a array<int>, b array<int>")
    r = df.select(S.jaccard("a", "b").alias("j"), S.pruned_jaccard("a", "b").alias("p"), S.length_part("a").alias("x"), S.length_part("b").alias("y")).collect()
    assert [x.j for x in r] == [0.8, 0.2, 1.0] and [x.p for x in r] == [0.8, 0.0, 1.0]
    assert abs(r[0].x - r[0].y) <= 1


@pytest.mark.parametrize("ids", [
    [-9 * 10**18, 3, 9 * 10**18],
    [-2**63, 2**63 - 1, 0, None, None],
    [hash((i, "x")) * 7919 % 2**64 - 2**63 for i in range(300)],
    [*range(200), 2**62],
    [7] * 100 + list(range(200)),
    [None] * 100 + list(range(200)),
])
def test_next_row_for_any_spread_of_ids(spark, monkeypatch, ids):
    """Wide and hashed ids, one outlier, one id on a third of the rows."""
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 20)
    df = spark.createDataFrame([(i, f"t{k}", [k]) for k, i in enumerate(ids)], "doc_id long, text string, sigs array<int>")
    rows = S.with_next(df, len(ids)).collect()
    assert len(rows) == len(ids)
    tie = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, -(ids[k] or 0), tie[f"t{k}"]))
    after = {f"t{k}": f"t{order[(p + 1) % len(order)]}" for p, k in enumerate(order)}
    assert {r.text: r.next_text for r in rows} == after


def test_a_hot_id_and_equal_rows_fall_into_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 50)
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 1L, id) as doc_id", "if(id % 3 = 0, 'same', string(id)) as text", "array(int(id)) as sigs")
    seen = []
    window = S.Window.partitionBy

    def spy(*columns):
        seen.append(columns)
        return window(*columns)

    monkeypatch.setattr(S.Window, "partitionBy", spy)
    out = S.with_next(df.repartition(4), 3000)
    assert out.count() == 3000 and seen == [("_part",)]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("xxhash64(monotonically_increasing_id()") >= 1
