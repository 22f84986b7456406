"""Language filters: membership, counts and held-out accuracy."""

import numpy as np
import pyarrow as pa
import pytest

from odflow.llm import langid
from odflow.llm.textvec import stretches


def of_texts(texts):
    (_, data, offsets), = stretches(pa.array(texts))
    return data, offsets


def test_grams_are_the_runs_of_bytes():
    texts = [" der hund ", "  ", " é ", "", " a "]
    data, offsets = of_texts(texts)
    for size, (values, bounds) in zip(langid.SIZES, langid.grams(data, offsets)):
        for i, t in enumerate(texts):
            b = t.encode()
            want = [int.from_bytes(b[k:k + size], "little") + (1 << 32 if size == 3 else 0) for k in range(len(b) - size + 1)]
            assert values[bounds[i]:bounds[i + 1]].tolist() == want


@pytest.mark.parametrize("n_languages", [1, 4, 9, 20])
def test_filters_hold_their_members_and_few_others(n_languages):
    r = np.random.default_rng(5)
    members = [np.unique(r.integers(0, 1 << 32, 100 + 500 * i).astype(np.uint64)) for i in range(n_languages)]
    f = langid.LanguageFilters([f"l{i}" for i in range(n_languages)], members)
    for i, m in enumerate(members):
        assert ((f.holders(m)[i // 8] >> i % 8) & 1).all()
    other = r.integers(1 << 40, 1 << 41, 100_000).astype(np.uint64)
    rates = np.array([((f.holders(other)[i // 8] >> i % 8) & 1).mean() for i in range(n_languages)])
    assert np.allclose(rates, f.chance, atol=0.003) and rates.max() < 0.02


def test_counts_are_those_of_exact_sets():
    words = " the house of the river and the mill "
    data, offsets = of_texts([words, " zz ", " the mill "])
    sets = [np.unique(np.concatenate([v[b[0]:b[1]] for v, b in langid.grams(data, offsets)])), np.zeros(0, np.uint64)]
    n, hits = langid.LanguageFilters(["en", "xx"], sets).counts(data, offsets)
    exact = np.zeros(3)
    for v, b in langid.grams(data, offsets):
        exact += [np.isin(v[b[i]:b[i + 1]], sets[0]).sum() for i in range(3)]
    assert n.tolist() == [len(t) * 2 - 5 for t in (words, " zz ", " the mill ")]
    assert np.allclose(hits[:, 0], exact, atol=1e-3 * n.max()) and np.allclose(hits[:, 1], 0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.op13_language_filters(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_neither_lang_nor_id_nor_source_decides(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.learn(docs.filter(~langid.held_out()))
    texts = docs.select("doc_id", "text")
    shifted = texts.selectExpr("doc_id + 1000000 as doc_id", "text", "'zz' as lang", "'other' as source")
    a = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(texts, model, ["doc_id"]).collect()}
    b = {r.doc_id - 1000000: (r.lang_pred, r.score) for r in langid.identify(shifted, model, ["doc_id"]).collect()}
    assert a == b


def test_edge_tables(spark, edge_dir, empty_dir):
    rows = langid.op13_language_filters(spark, edge_dir).collect()
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    assert {r.lang_pred for r in rows} == {"en", "und"}
    assert sum(r.lang_pred == "und" for r in rows) == sum(r.text is None or not any(c.isalpha() for c in r.text) for r in docs)
    assert langid.op13_language_filters(spark, empty_dir).count() == 0
    bare = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    nothing = langid.learn(bare.selectExpr("text", "cast(null as string) as lang"))
    assert [(r.lang_pred, r.score) for r in langid.identify(bare, nothing, ["doc_id"]).collect()] == [("und", 0.0)] * 2
    with pytest.raises(ValueError):
        langid.identify(bare.withColumn("score", bare.doc_id), nothing, ["score"])


def test_many_languages(spark):
    """More languages than bits in a byte, one with a third of the rows."""
    r = np.random.default_rng(8)
    rows = []
    for i in range(12):
        syllables = ["".join(r.choice(list("bcdfghklmnprst"), 1)) + str(r.choice(list("aeiou"))) + "bdgkmnrst"[i % 9] + "aeo"[i // 4] for _ in range(6)]
        rows += [(f"l{i}", " ".join("".join(r.choice(syllables, 2)) for _ in range(40))) for _ in range(100 if i == 0 else 20)]
    df = spark.createDataFrame([(k, lang, t) for k, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string")
    model = langid.learn(df.filter("doc_id % 2 = 0"))
    got = {r.doc_id: r.lang_pred for r in langid.identify(df, model, ["doc_id"]).collect()}
    assert np.mean([got[k] == lang for k, (lang, _) in enumerate(rows) if k % 2]) > 0.95
