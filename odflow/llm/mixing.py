"""Mixing sources to target weights with a low-discrepancy schedule.

Each source gets a target number of words: weights 5, 2, 1 (repeating, in
code-point order of the source names, null last) share SHARE times all words,
and no target exceeds MAX_EPOCHS times the words its source has; what that
leaves over goes to the others by weight (water-filling, solved in one pass
over the sources).

The mix is a sequence of slots of BLOCK words.  Slot n looks up the golden
ratio point frac(n * phi) in the cumulative shares of the sources, so every
stretch of the sequence is close to the target shares.  Ranking a source's
slots numbers the blocks it hands out; a source's documents, shuffled by a
hash of their id, form one stream of words that starts again at its end, and
block k is its k-th stretch of BLOCK words.  Points miss a share by a few
slots at most: slots a source has no use for go to sources still short.

Null or empty texts have size 0 and are never taken; a table whose texts are
all empty has targets of 0.  Repeated rows are separate documents of the
stream.  An empty table gives no rows.  DataFrame functions only; a source
may hold any share of the rows: no step keys on the source alone except
joins to the source table, which are broadcast when it has at most
MAX_BROADCAST_SOURCES rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.llm.common import masked, n_words, running_sum, stored, table, uniform_key, unmasked

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCK = 256
MAX_BROADCAST_SOURCES = 100_000

#: Points are multiples of 1/2**40; GOLDEN is 2**40 / phi, made odd.
_BITS = 40
GOLDEN = int(2**_BITS * (5**0.5 - 1) / 2) | 1
_CELLS = 4096


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) to (source, source_size, target).  One row per
    source: the windows below hold names and totals only."""
    rank = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(w) for w in WEIGHTS])
    out = sizes.withColumn("_weight", F.element_at(cycle, ((F.row_number().over(rank) - 1) % len(WEIGHTS) + 1).cast("int")))
    out = out.withColumn("_cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
    out = out.withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    left = F.sum("source_size").over(everything) * F.lit(SHARE) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight = F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    out = out.withColumn("_level", left / weight)
    # the first source, by cap per weight, that its level does not fill sets the level of all after it
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(everything)
    out = out.withColumn("_final", level["_level"])
    target = F.least(F.col("_cap"), F.coalesce(F.col("_final") * F.col("_weight"), F.col("_cap")))
    return out.select("source", "source_size", target.alias("target"))


def golden(n) -> F.Column:
    """frac(n * phi) as an integer below 2**40, without overflow."""
    m = F.lit(1 << _BITS)
    high, low = F.shiftright(n, 20), n.bitwiseAND(F.lit((1 << 20) - 1))
    return ((((high * F.lit(GOLDEN)) % m) * F.lit(1 << 20)) % m + (low * F.lit(GOLDEN)) % m) % m


def schedule(spark, targets: DataFrame, n_slots: int) -> DataFrame:
    """(slot, source, block): which stretch of which source comes when.
    ``targets`` has source, target, blocks, and start (blocks of the sources before)."""
    cell = F.floor(F.col("start") * F.lit(_CELLS) / F.lit(float(n_slots)))
    last = F.floor((F.col("start") + F.col("blocks") - 1) * F.lit(_CELLS) / F.lit(float(n_slots)))
    shares = (targets.filter("blocks > 0")
              .select("source", "start", "blocks", F.explode(F.sequence(cell.cast("long"), last.cast("long"))).alias("cell")))
    slots = spark.range(n_slots).withColumnRenamed("id", "slot")
    # the point scaled to [0, n_slots), in two halves so that the product stays in 63 bits
    point = golden(F.col("slot"))
    slots = slots.withColumn("point", F.floor(point / F.lit(float(1 << _BITS)) * F.lit(float(n_slots))).cast("long"))
    slots = slots.withColumn("cell", F.floor(F.col("point") * F.lit(_CELLS) / F.lit(float(n_slots))).cast("long"))
    # a row for each source and, in all, for each cell
    few = targets.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES
    picked = (slots.join(F.broadcast(shares) if few else shares, "cell")
              .filter("point >= start and point < start + blocks")
              .select("slot", "source", "blocks", (F.col("slot") * F.lit(2.0**52 / n_slots)).cast("long").alias("key")))
    ranked = running_sum(picked, ["source"], ["key", "slot"], None, "block", n_slots)
    ranked = stored(ranked.select("slot", "source", "blocks", "block"), "mix-slots")
    fits = ranked.filter("block < blocks").select("slot", "source", "block")
    # a few slots per source at most: each source's count is within the discrepancy of its share
    spare = ranked.filter("block >= blocks").select("slot", F.row_number().over(Window.orderBy("slot")).alias("_k"))
    counts = ranked.groupBy(F.col("source").alias("_s")).agg(F.count("*").alias("got"))
    short = (targets.filter("blocks > 0").join(counts, F.col("source").eqNullSafe(F.col("_s")), "left")
             .withColumn("got", F.coalesce("got", F.lit(0))).filter("got < blocks")
             .select("source", F.explode(F.sequence("got", F.col("blocks") - 1)).alias("block")))
    short = short.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source", "block")))
    return fits.unionByName(spare.join(short, "_k").select("slot", "source", "block"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row."""
    spark = docs.sparkSession
    narrow = stored(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        n_words(F.col(text)).alias("size")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes).withColumn("blocks", F.ceil(F.col("target") / BLOCK).cast("long"))
    before = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    targets = stored(targets.withColumn("start", F.coalesce(F.sum("blocks").over(before), F.lit(0))), "mix-targets")
    n_sources, n_slots = targets.agg(F.count("*"), F.coalesce(F.sum("blocks"), F.lit(0))).first()
    n_rows = narrow.count()
    small = F.broadcast if n_sources <= MAX_BROADCAST_SOURCES else (lambda df: df)

    aim = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rows = narrow.join(small(aim), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_key", uniform_key(F.col("doc_id")))
    empty = rows.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    if n_slots == 0:
        return empty
    stream = running_sum(rows.filter("size > 0"), ["source"], ["_key", "doc_id", "size"], "size", "start", n_rows)
    limit = F.round("target").cast("long")
    epochs = stream.withColumn("_from", F.explode(F.array(*[F.col("start") + F.lit(e) * F.col("source_size") for e in range(MAX_EPOCHS)])))
    epochs = epochs.withColumn("_to", F.least(F.col("_from") + F.col("size"), limit))
    first, last = F.floor(F.col("_from") / BLOCK), F.floor((F.col("_to") - 1) / BLOCK)
    # a stretch past the target keeps its row, with no block
    pieces = epochs.withColumn("block", F.explode(F.when(
        F.col("_to") > F.col("_from"), F.sequence(first, last)).otherwise(F.array(F.lit(-1).cast("long")))))
    plan = schedule(spark, targets, n_slots).select("slot", F.col("source").alias("_s"), F.col("block").alias("_b"))
    met = pieces.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")), "left")
    words = F.least("_to", (F.col("block") + 1) * BLOCK) - F.greatest("_from", F.col("block") * BLOCK)
    met = met.withColumn("_words", F.when(F.col("slot").isNotNull(), words).otherwise(F.lit(0)))
    taken = met.groupBy("doc_id", "source", "size", "source_size", "target", "start").agg(F.sum("_words").cast("long").alias("taken"))
    return taken.drop("start").unionByName(empty)


def repeat(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as many times as the mix takes it: ``taken`` over
    its size, to the nearest whole (only the document on which a source's
    target falls is taken in part).  Rows of size 0 are not taken."""
    rows, (doc_id, text, source), names = masked(docs, "doc_id", "text", "source")
    key = lambda *c: F.xxhash64(*c)
    taken = mix(rows, doc_id, text, source).filter("taken > 0").select(
        F.col("doc_id").alias("id"), F.col("source").alias("from"), F.col("size").alias("words"),
        F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("times")).filter("times > 0")
    # rows of one id, source and size may differ in how often they are taken: numbered, each gets its own
    taken = taken.withColumn("n", F.row_number().over(Window.partitionBy("id", "from", "words").orderBy("times")))
    taken = taken.withColumn("t_key", key("id", "from", "words"))
    rows = rows.withColumn("size", n_words(F.col(text))).withColumn("key", key(F.col(doc_id), F.col(source), "size"))
    rows = rows.repartition("key").withColumn(
        "k", F.row_number().over(Window.partitionBy("key", doc_id, source, "size").orderBy(F.xxhash64(text))))
    met = rows.join(taken, (F.col("key") == F.col("t_key")) & F.col(doc_id).eqNullSafe(F.col("id"))
                    & F.col(source).eqNullSafe(F.col("from")) & (F.col("size") == F.col("words")) & (F.col("k") == F.col("n")))
    return unmasked(met.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))), names)


def op5_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13) AS k FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / w AS ratio,
    (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM s WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM r WHERE level <= ratio) * w, cap)) AS target FROM r),
o AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(start + size, round(target)) - start)
   + greatest(0, least(start + source_size + size, round(target)) - start - source_size))::BIGINT AS taken
FROM o
"""
