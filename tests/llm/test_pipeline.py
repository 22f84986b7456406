import hashlib
import importlib.util
import re
import sys
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from odflow.llm import mil_quality, secret_scan
from odflow.llm.common import stored
from tests.llm import brute
from tests.llm.test_scans_and_quality import base

SF = "/root/testdata/sf0.001"


def brute_force(spark, path):
    """The rows of run(), stage by stage in plain Python; only the learned
    scores are taken from the classifier."""
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = mil_quality.train(docs, spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "quality"))
    good = {r.doc_id for r in mil_quality.score(docs, model, ["doc_id"]).collect() if r.predicted}
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect() if r.doc_id in good]
    sets = [brute.shingle_set(t, P.SHINGLE) for _, t, _ in rows]
    lead = brute.component_ids(sets, [r[0] for r in rows], P.ALIKE, P.OF)
    rows = [r for r, s, c in zip(rows, sets, lead) if not s or r[0] == c]
    limits = secret_scan.thresholds(spark.createDataFrame([(t,) for _, t, _ in rows], "text string"))
    clean = []
    for i, t, s in rows:
        spans = [(k, *x) for k, found in base(t).items() for x in found]
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}", t):
            found = secret_scan.infer_encoding(m[0])
            alone = not any(c and ord(c) > 127 for c in (t[m.start() - 1:m.start()], t[m.end():m.end() + 1]))
            if found and alone and secret_scan.cell(m[0], found[0]) in limits and all(m.end() <= a or m.start() >= b for _, a, b in spans if _ != "random"):
                if secret_scan.randomness(m[0], found[1]) >= limits[secret_scan.cell(m[0], found[0])]:
                    spans.append(("random", *m.span()))
        clean.append((i, secret_scan.redacted(t, sorted(spans, key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))), s))
    size, taken, _ = brute.mix(clean)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = Counter()
    for (i, t, s), z, k in zip(clean, size, taken):
        ids = library.encode(t, add_special_tokens=False).ids
        times = int(k / z + 0.5) if z else 0
        if times:
            out[i, s, tuple(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += times
    return out


def test_run_matches_brute_force(spark):
    got = Counter((r.doc_id, r.source, tuple(r.ids), r.decoded_sha256) for r in P.run(spark, SF).collect())
    assert got == brute_force(spark, SF)


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "secrets", "mix", "tokens"]


@pytest.mark.parametrize("which", ["edge", "empty"])
def test_stages_on_edge_tables(spark, edge_dir, empty_dir, which):
    path = edge_dir if which == "edge" else empty_dir
    docs = spark.read.parquet(f"{path}/documents.parquet").withColumn("n_assign", F.lit("mine")).withColumn("c3", F.lit(7))
    columns = docs.columns
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, path), f"edge-{name}")
        if name != "tokens":
            assert out.columns == columns and out.dtypes == docs.dtypes, name
            assert out.filter("n_assign <> 'mine' or c3 <> 7").count() == 0
        docs = out
    assert docs.count() == 0 or which == "edge"


def test_entry_works_without_the_training_data_files(monkeypatch):
    path = importlib.util.find_spec("__spark_entry__").origin

    class Gone:
        def find_spec(self, name, *_):
            if name == "corpus_pipeline" or name.startswith("odflow.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [m for m in sys.modules if m == "corpus_pipeline" or m.startswith("odflow.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    import odflow

    monkeypatch.delattr(odflow, "llm", raising=False)
    spec = importlib.util.spec_from_file_location("entry_alone", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    names = set(module.queries())
    assert "bq3_ranking" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)
    assert set(module.oracle_sql()) <= names
