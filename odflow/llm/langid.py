r"""Language of a text by language-bitmask n-gram filters.

Texts are lower-cased; runs of anything but letters and marks become one space,
and a space goes before and after.  Their n-grams are the runs of 3 and of 4
bytes of the UTF-8 form.  Every language has a Bloom filter of the n-grams
that are its own: those whose share of its n-grams is at least NEAR times the
largest share that any language gives them.  All filters have one size and one
set of hash functions, so they lie side by side: a position holds one bit for
each language, eight languages to a byte, and the AND of HASHES positions gives
all languages that hold an n-gram at once.

A language's hits in a text are counted from the bytes by their population;
of n lookups of which f go wrong by chance, f being the filter's filled share
to the power HASHES, ``(hits - n f) / (1 - f)`` are true.  The language with
most of them is the prediction (the first by name of several), their share of n
the score.

Learning uses about TRAIN_TEXTS different texts of each language, picked by
their hash (all, if it has fewer), and keeps at most MAX_GRAMS n-grams a
language; the filters' size follows from that, whatever the table holds.
Prediction covers every text whole.

A null text or one without a letter is ``und`` with score 0, and so is every
text if nothing was learned.  Rows with a null lang teach nothing; repeated
rows teach once and are predicted each; an empty table gives no rows.  A
column of the input that is called lang_pred or score cannot be kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import table, uniform_key
from odflow.llm.textvec import mix, stretches

SIZES = (3, 4)
NEAR = 0.25
MIN_COUNT = 3
TRAIN_TEXTS = 3000
MAX_GRAMS = 40_000
HASHES = 4
BITS_PER_GRAM = 12
UNKNOWN = "und"


def plain(text: str) -> str:
    """SQL: letters and marks in lower case, single spaces for the rest."""
    return rf"concat(' ', trim(regexp_replace(lower(coalesce(`{text}`, '')), '[^\\p{{L}}\\p{{M}}]+', ' ')), ' ')"


def grams(data: np.ndarray, offsets: np.ndarray):
    """For each size: the n-grams of consecutive texts as numbers, and where
    each text's begin."""
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    four = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    length = np.diff(offsets)
    for size in SIZES:
        n = np.maximum(length - size + 1, 0)
        bounds = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(bounds[-1]) + np.repeat(offsets[:-1] - bounds[:-1], n)
        value = four[at].astype(np.uint64)
        if size == 3:
            value = value & np.uint64(0xFFFFFF) | np.uint64(1 << 32)
        yield value, bounds


class LanguageFilters:
    """Bit-sliced Bloom filters of ``languages``, given each one's n-grams."""

    def __init__(self, languages: list[str], members: list[np.ndarray]) -> None:
        self.languages = languages
        largest = max((len(m) for m in members), default=0)
        self.size = 1 << max(10, int(largest * BITS_PER_GRAM - 1).bit_length())
        self.slices = np.zeros((-(-len(languages) // 8), self.size), np.uint8)
        for i, m in enumerate(members):
            for at in self._positions(m):
                self.slices[i // 8, at] |= np.uint8(1 << i % 8)
        bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
        self.bits = bits.astype(np.float64)
        filled = np.concatenate([np.bincount(s, minlength=256) @ self.bits for s in self.slices]) if languages else np.zeros(0)
        self.chance = (filled[:len(languages)] / self.size) ** HASHES

    def _positions(self, values: np.ndarray):
        h = mix(values * np.uint64(0x9E3779B97F4A7C15))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for _ in range(HASHES):
            yield (h & np.uint64(self.size - 1)).astype(np.int64)
            h = h + step

    def holders(self, values: np.ndarray) -> np.ndarray:
        """[slice, value]: a bit for every language that (perhaps) holds the n-gram."""
        out = np.full((len(self.slices), len(values)), 255, np.uint8)
        for at in self._positions(values):
            out &= self.slices[:, at]
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and of each language those that are true hits."""
        n_texts = len(offsets) - 1
        n, hits = np.zeros(n_texts), np.zeros((n_texts, 8 * len(self.slices)))
        for values, bounds in grams(data, offsets):
            n += np.diff(bounds)
            text = np.repeat(np.arange(n_texts), np.diff(bounds))
            for i, mask in enumerate(self.holders(values)):
                kinds = np.bincount(text * 256 + mask, minlength=n_texts * 256).reshape(n_texts, 256)
                hits[:, 8 * i:8 * i + 8] += kinds @ self.bits
        hits = hits[:, :len(self.languages)]
        return n, (hits - n[:, None] * self.chance) / (1 - self.chance)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def learn(docs: DataFrame, lang: str = "lang", text: str = "text", train_texts: int = TRAIN_TEXTS, max_grams: int = MAX_GRAMS) -> LanguageFilters:
    """Filters from the rows of ``docs`` that have a language and a text."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), uniform_key(F.col(text)).alias("key"))
    texts = rows.select("lang", "key").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    limit = texts.select(F.col("lang").alias("_lang"), (F.lit(2.0**52) * train_texts / F.col("n")).alias("_limit"))
    # one row a language; copies of a text are one before they are shuffled
    picked = rows.join(F.broadcast(limit), F.col("lang") == F.col("_lang")).filter(F.col("key") < F.col("_limit"))
    picked = picked.groupBy("lang", "key").agg(F.min("text").alias("text")).select("lang", F.expr(plain("text")).alias("text"))

    def count(batches):
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for row, data, offsets in stretches(batch.column(1)):
                for name in sorted(set(names[row:row + len(offsets) - 1])):
                    found = []
                    for values, bounds in grams(data, offsets):
                        mine = np.repeat(names[row:row + len(offsets) - 1] == name, np.diff(bounds))
                        found.append(np.unique(values[mine], return_counts=True))
                    gram, n = (np.concatenate(x) for x in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    of_size = Window.partitionBy("lang", F.col("gram") >= 1 << 32)
    share = F.col("n") / F.sum("n").over(of_size)
    shared = counted.withColumn("share", share).withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    own = shared.filter((F.col("n") >= MIN_COUNT) & (F.col("share") >= NEAR * F.col("most")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    kept = own.withColumn("place", place).filter(F.col("place") <= max_grams).select("lang", "gram").toPandas()
    languages = sorted(r["lang"] for r in texts.select("lang").collect())
    by_lang = {k: v["gram"].to_numpy().astype(np.uint64) for k, v in kept.groupby("lang")}
    return LanguageFilters(languages, [by_lang.get(k, np.zeros(0, np.uint64)) for k in languages])


def identify(docs: DataFrame, model: LanguageFilters, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``."""
    if {"lang_pred", "score"} & set(keep):
        raise ValueError("columns lang_pred and score cannot be kept")
    letters = F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], letters.alias("_letters"), F.expr(plain(text)).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-2]) + ", lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        filters = shared.value
        for batch in batches:
            names = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            letters = batch.column(len(keep)).to_numpy(zero_copy_only=False).astype(bool)
            if filters.languages:
                for row, data, offsets in stretches(batch.column(len(keep) + 1)):
                    n, hits = filters.counts(data, offsets)
                    best = hits.argmax(axis=1)
                    here = np.flatnonzero(letters[row:row + len(n)])
                    names[row + here] = np.array(filters.languages, object)[best[here]]
                    score[row + here] = np.clip(hits[here, best[here]] / np.maximum(n[here], 1), 0, 1)
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if i < len(keep)}
            columns |= {"lang_pred": pa.array(names.tolist(), pa.string()), "score": pa.array(score)}
            yield pa.RecordBatch.from_pydict(columns)

    return picked.mapInArrow(run, schema)


def op13_language_filters(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn(docs.filter(~held_out()))
    return identify(docs, model, ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
