r"""Importance resampling towards a target distribution.

Words are runs of ``[0-9a-z]`` and of characters outside ASCII, after A to Z
were lower-cased (no other letter changes).  A document's features are all its
runs of one to three consecutive words, joined by one space, repeats counted;
a feature's bucket is the CRC-32 of its UTF-8 bytes modulo BUCKETS.  A bucket's
gain compares its share in the target texts with its share in all documents:
``floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS))))``.  A document's
weight is the sum of the gains over its features, its score the weight plus
Gumbel noise from a hash of its id: the highest scores are a weighted draw
without replacement, and the same one on every run.

Texts are read twice: for the counts of the buckets and, once the gains are
known, for the weights.  Both times the words of a batch are interned, block by
block, in an open-addressed table (``gramtable``); a bucket is computed once
for each different string of a block, and occurrences gather it, or its gain,
by their slots.  A block holds at most BLOCK_WORDS words, of a part of a long
text or of many short ones, so memory follows the block and the longest text.

Counts leave a task as BUCKETS / PART fixed rows.  Ranks come from a sort by
ranges over narrow rows: places inside a range plus the sizes of the ranges
before it; rows of one score and id are spread by a row number, so no key is
held together.

Null and empty texts have no features and weight 0; documents of under
MIN_WORDS words are never drawn.  A null id is hashed as the empty text and
comes last among ties; repeated rows are documents of their own.  Without
target texts, or without documents, the gains follow from the formula all the
same; an empty table gives no rows.  The query reads two columns of a table,
so further columns and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import stored, table
from odflow.llm.gramtable import Bytes, Crc, GramTable
from odflow.llm.textvec import stretches

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
BLOCK_WORDS = 1 << 18
PART = 500
#: Rows of one range of the ranking.
RANGE_ROWS = 1_000_000


class Features:
    """The features of whole Arrow text columns, by block of words."""

    def __init__(self, buckets: int = BUCKETS, longest: int = LONGEST_RUN, block: int = BLOCK_WORDS) -> None:
        self.buckets, self.longest, self.block = buckets, longest, block
        self.crc = Crc()
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower
        kept = np.zeros(256, bool)
        kept[48:58] = kept[97:123] = kept[128:] = True
        self.kept = kept

    def blocks(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[GramTable], list[np.ndarray]]]:
        """(rows that have words here, their words, a table for each run
        length, the row of every run of that length)."""
        for row, data, offsets in stretches(column):
            data = self.lower[data]
            word = self.kept[data]
            begins, ends = word.copy(), word.copy()
            begins[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            edge = offsets[1:-1]
            edge = edge[(edge > 0) & (edge < len(data))]
            begins[edge] = word[edge]
            ends[edge - 1] = word[edge - 1]
            start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            doc = np.searchsorted(offsets, start, "right") - 1
            for first in range(0, len(start), self.block):
                # runs that begin in the block may end in the next one
                last = min(len(start), first + self.block)
                upto = min(len(start), last + self.longest - 1)
                mine, part = slice(first, upto), slice(start[first], end[upto - 1])
                yield self._block(data[part][word[part]], (end - start)[mine], doc[mine] + row, last - first)

    def _block(self, letters, size, doc, n_begin):
        n = len(size)
        end = np.cumsum(size + 1)
        at = end - size - 1
        plain = np.full(end[-1], 32, np.uint8)
        inside = np.ones(end[-1], bool)
        inside[end - 1] = False
        plain[inside] = letters
        text = Bytes(plain)
        rows, counts = np.unique(doc[:n_begin], return_counts=True)
        tables, where = [], []
        # words past the block, where runs of it end
        crc = np.zeros(n, np.uint32)
        crc[n_begin:] = text.crc32(at[n_begin:], size[n_begin:])
        spaced = None
        for k in range(1, self.longest + 1):
            begin = np.arange(max(0, min(n_begin, n - k + 1)))
            begin = begin[doc[begin] == doc[begin + k - 1]]
            length = at[begin + k - 1] + size[begin + k - 1] - at[begin]
            found = GramTable(text, at[begin], length)
            own = begin[found.owner]
            if k == 1:
                value = text.crc32(at[own], size[own])
            else:
                value = self._extended(crc, own, k, spaced, size, plain, at)
            of_slot = np.zeros(found.size, np.uint32)
            of_slot[found.used] = value
            found.bucket[found.used] = value % np.uint32(self.buckets)
            crc[begin] = of_slot[found.slots]
            if k == 1:
                spaced = self.crc.joined(np.full(n, self.crc.space), crc, np.minimum(size, self.crc.LONGEST))
            tables.append(found)
            where.append(doc[begin])
        return rows, counts, tables, where

    def _extended(self, crc, own, k, spaced, size, plain, at):
        """CRC-32 of the runs of k words that begin at ``own``, from those of k - 1 words."""
        last = own + k - 1
        width = size[last] + 1
        value = self.crc.joined(crc[own], spaced[last], np.minimum(width, self.crc.LONGEST))
        for i in np.flatnonzero(width > self.crc.LONGEST):
            value[i] = zlib.crc32(plain[at[own[i]]:at[last[i]] + size[last[i]]])
        return value


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How many features of ``texts`` (one column) fall into each bucket: a
    fixed number of sums, whatever the table holds."""
    def count(batches):
        features, sums = Features(buckets, longest), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, tables, _ in features.blocks(batch.column(0)):
                for t in tables:
                    sums += np.bincount(t.bucket[t.used], t.count[t.used], buckets).astype(np.int64)
        yield parts(range(0, buckets, PART), [sums[a:a + PART] for a in range(0, buckets, PART)])

    def parts(first, sums):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(first), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["first", "sums"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[first] = sums.get(first, 0) + np.frombuffer(part, np.int64)
        if sums:
            yield parts(sums, sums.values())

    schema = "first int, sums binary"
    total = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, schema).repartition("first").mapInArrow(add, schema).collect():
        total[r.first:r.first + PART] = np.frombuffer(r.sums, np.int64)
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket from its counts in the documents and in the target texts."""
    buckets = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST_RUN) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    def run(batches):
        features = Features(len(gain), longest)
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, counts, tables, where in features.blocks(batch.column(1)):
                n_words[rows] += counts
                for t, row in zip(tables, where):
                    if len(row):
                        of_slot = gain[t.bucket]
                        begins = np.flatnonzero(np.diff(row, prepend=-1))
                        n_features[row[begins]] += np.diff(np.append(begins, len(row)))
                        weight[row[begins]] += np.add.reduceat(of_slot[t.slots], begins)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def with_score(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus 1000 times Gumbel noise, rounded down."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(key, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return weighed.withColumn("score", (F.col("weight") + F.floor(-1000 * F.log(-F.log(u)))).cast("long"))


def ranked(df: DataFrame, order: list, n: int, out: str = "rank", n_rows: int | None = None) -> DataFrame:
    """The first ``n`` rows in ``order``, with their places from 1.

    Rows are dealt by ranges of the order and written with the number of
    their range; a place is that inside the range plus the rows of the ranges
    before.  Equal rows are told apart by a row number, so they spread too.
    """
    if n <= 0:
        return df.limit(0).withColumn(out, F.lit(0).cast("long"))
    n_rows = df.count() if n_rows is None else n_rows
    order = [*order, F.col("_row").asc()]
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-n_rows // RANGE_ROWS)), *order)
    dealt = stored(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)     # one row for each RANGE_ROWS rows
    sizes = dealt.groupBy("_range").count().select(
        F.col("_range").alias("_r"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")).filter(F.col("_before") < n)
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    found = dealt.withColumn(out, place).join(F.broadcast(sizes), F.col("_range") == F.col("_r"))
    return found.withColumn(out, (F.col(out) + F.col("_before")).cast("long")).filter(F.col(out) <= n).drop("_row", "_range", "_r", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` and ``target`` (doc_id, text; text) to (doc_id, n_words,
    n_features, weight, score, rank): the drawn ``percent`` of the documents of
    at least ``min_words`` words have ranks, the others a null."""
    gain = gains(bucket_counts(docs.select("text")), bucket_counts(target.select("text")))
    scored = stored(with_score(weigh(docs, gain), seed).withColumn("_at", F.monotonically_increasing_id()), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    n = able.count()
    drawn = ranked(able.select("score", "doc_id", "_at"), [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], percent * n // 100, n_rows=n)
    places = drawn.select(F.col("_at").alias("_drawn"), "rank")
    return scored.join(places, F.col("_at") == F.col("_drawn"), "left").select(
        "doc_id", "n_words", "n_features", "weight", "score", "rank")


def op11_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text")).select(
        "doc_id", "n_features", "weight", "score", "rank")


ORACLE = r"""
WITH step AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc),
d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT row_number() OVER () AS n, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
runs AS (
  SELECT of, n, array_to_string(list_slice(w, i, i + k - 1), ' ') AS f FROM (
    SELECT of, n, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (
      SELECT of, n, w, unnest([1, 2, 3]) AS k FROM (SELECT 'd' AS of, n, w FROM d UNION ALL SELECT 'b', n, w FROM b)))),
f AS (
  SELECT f, xor(list_reduce(list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
      lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM runs)), step),
c AS (
  SELECT bucket, count(*) FILTER (WHERE of = 'd') AS s, count(*) FILTER (WHERE of = 'b') AS t FROM runs JOIN f USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM c) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM c) + 10000)::DOUBLE)))::BIGINT AS gain FROM c),
m AS (
  SELECT n, count(*) AS n_features, sum(gain) AS weight FROM runs JOIN f USING (f) JOIN g USING (bucket) WHERE of = 'd' GROUP BY n),
o AS (
  SELECT d.n, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN m ON d.n = m.n),
r AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM o WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * able // 100 THEN place END AS rank
FROM o LEFT JOIN r USING (n)
"""
