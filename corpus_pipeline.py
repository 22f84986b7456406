"""Corpus pipeline: quality, near duplicates, secrets, mixing, tokens.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs,
sf_dir) and returns a DataFrame.  ``run`` applies them to ``documents`` in
order, each result written as Parquet to the shared folder and read again as
the next stage's documents.  All stages but the last return the columns of
``documents``; ``n_chars`` follows the text where a stage changes it.

Rows are kept or dropped whole: quality drops what the classifier rejects, the
join keeps one document of each group, the secret scan replaces spans inside
texts, the mix repeats or leaves out documents.  Null and empty texts, null
ids, repeated rows and empty tables go through by the rules of each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.llm import bpe, mil_quality, mixing, ngram_join, secret_scan
from odflow.llm.common import masked, stored, table, unmasked

#: Near duplicates: shingles of five words, a Jaccard index of 0.8 or more.
SHINGLE, ALIKE, OF = 5, 80, 100


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts, learned from ``labels`` on these rows."""
    model = mil_quality.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    rows, (text,), names = masked(docs, "text")
    return unmasked(mil_quality.score(rows, model, rows.columns, text).filter("predicted = 1"), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest
    doc_id; a document without words stays."""
    return ngram_join.keep_one(docs, SHINGLE, ALIKE, OF)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with secrets replaced in their texts."""
    rows, (text, n_chars), names = masked(docs, "text", "n_chars")
    found = secret_scan.scan(rows, rows.columns, text)
    changed = F.col("spans") != ""
    return unmasked(found.withColumns({
        n_chars: F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col(n_chars)), text: F.col("clean_text")}), names)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the digest of the decoded text."""
    import public_tokenizers

    spec = bpe.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    return bpe.encode_with_digest(docs, spec, ["doc_id", "source"])


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("tokens", tokens),
]

#: A trained classifier has no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
