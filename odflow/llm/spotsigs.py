r"""Document fingerprints from spot signatures, with DataFrame functions only.

Words are runs of letters and digits of the lower-cased text.  Every anchor
starts a chain: the next CHAIN words that are no common words, looked for
among the REACH words after it.  Anchors are the common words of ``ANCHORS``
and, for texts with few of them, every word whose hash is a multiple of
EVERY; in texts of under SHORT_TEXT words each word is an anchor.  Anchor,
chain and how often they came before are hashed to 32 bits: a set that stands
for the multiset of chains, so repetition counts.  Sorted, and written as
eight hex digits each, these signatures are the fingerprint.  A text without
letters or digits has one signature, its own hash; the empty or null text has
none and its fingerprint is ''.

Likeness is the Jaccard index of two signature sets, and 1 for two empty
ones.  Sets fall into partitions by their length (``length_part``): two sets
whose parts differ by more than one cannot reach the likeness TAU, and
``pruned_jaccard`` returns 0 for lengths that rule TAU out without looking at
the members.  The query returns the part and uses neither to choose what it
compares: only the edit and the next row of each text.  Repeated rows are fingerprinted each by itself; clashing column
names in the input are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odflow.functions.geo import last_not_above
from odflow.llm.common import table

# Common words of English, German, French and Spanish.
ANCHORS = """
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this
to was were which will with you
als am auch auf aus bei das dass dem den der des die ein eine einen einer es für hat ich im ist mit nach nicht sich sie
sind um und von war wie zu zum zur
au aux avec ce ces dans de du elle en est et il la le les leur mais ne nous ou par pas plus pour qu que qui sa se ses
son sur un une vous
al como con del el ella ellos era está fue lo las los más mi muy no nos para pero por porque sin su sus y ya
""".split()
CHAIN = 2
REACH = 5
EVERY = 8
SHORT_TEXT = 32
TAU = 0.44
ROWS_PER_BUCKET = 1024
MAX_RANGES = 16_384
KEYS_PER_RANGE = 16


def _in_anchors(word: str) -> str:
    return f"{word} in ({', '.join(repr(a) for a in sorted(set(ANCHORS)))})"


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sorted array of distinct 32-bit signatures."""
    following = ", ".join(f"get(_w, i + {k})" for k in range(1, REACH + 1))
    chain = f"slice(filter(array({following}), y -> y is not null and not ({_in_anchors('y')})), 1, {CHAIN})"
    df = df.withColumn("_w", F.expr(f"filter(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"))
    anchor = f"size(_w) < {SHORT_TEXT} or {_in_anchors('x')} or pmod(hash(x), {EVERY}) = 0"
    df = df.withColumn("_s", F.expr(
        f"sort_array(filter(transform(_w, (x, i) -> case when {anchor} then hash(x, {chain}) end), s -> s is not null))"))
    # runs of equal values, each value hashed with its number in the run
    df = df.withColumn("_at", F.expr("filter(transform(_s, (s, i) -> case when i = 0 or get(_s, i - 1) <> s then i end), i -> i is not null)"))
    df = df.withColumn("_runs", F.expr(
        "zip_with(_at, slice(_at, 2, size(_at)), (a, b) -> struct(get(_s, a) as s, coalesce(b, size(_s)) - a as n))"))
    df = df.withColumn(out, F.expr(f"""case
        when size(_s) > 0 then sort_array(flatten(transform(_runs, r -> transform(sequence(1, r.n), k -> case when k = 1 then r.s else hash(r.s, k) end))))
        when coalesce({text}, '') <> '' then array(hash({text}))
        else cast(array() as array<int>) end"""))
    return df.drop("_w", "_s", "_at", "_runs")


def as_text(signatures: str) -> Column:
    return F.expr(f"array_join(transform({signatures}, s -> lpad(lower(hex(cast(s as bigint) & 4294967295L)), 8, '0')), '')")


def length_part(signatures: str, tau: float = TAU) -> Column:
    """Number of the length partition: widths grow by 1/tau, so sets with
    likeness of tau or more are in the same part or in neighbours."""
    return F.expr(f"cast(floor(ln(greatest(size({signatures}), 1)) / {math.log(1 / tau)}D + 1e-9D) as int)")


def jaccard(a: str, b: str) -> Column:
    return F.expr(f"""case when size({a}) + size({b}) = 0 then 1.0D
        else cast(size(array_intersect({a}, {b})) as double) / (size({a}) + size({b}) - size(array_intersect({a}, {b}))) end""")


def pruned_jaccard(a: str, b: str, tau: float = TAU) -> Column:
    """The likeness where the lengths allow ``tau`` or more, else 0."""
    fits = F.expr(f"least(size({a}), size({b})) >= {tau}D * greatest(size({a}), size({b}))")
    return F.when(fits, jaccard(a, b)).otherwise(F.lit(0.0))


def _sortable(number: str) -> str:
    """SQL: sixteen hex digits in the order of a signed 64-bit number."""
    return f"lpad(hex({number} ^ shiftleft(1L, 63)), 16, '0')"


def with_next(docs: DataFrame, n_rows: int) -> DataFrame:
    """(doc_id, text, sigs) with ``next_text`` and ``next_sigs`` of the row
    that follows in falling doc_id (null ids last, ties by text hash; after
    the last row comes the first).

    Rows are cut into ranges of about ROWS_PER_BUCKET rows, each ordered by
    itself; only the first row of every range is carried to its neighbour.  The
    borders are keys out of the rows, from a sample of KEYS_PER_RANGE for each
    range; it fixes where ranges end and nothing else, so any spread of ids does.  A key goes
    on with the text's hash and a number of the row: a third of the rows under
    one id, or equal altogether, still fall into many ranges.
    """
    df = docs.withColumn("_row", F.xxhash64(F.monotonically_increasing_id())).withColumn("_key", F.expr(
        f"concat(if(doc_id is null, '1', '0'), {_sortable('~coalesce(doc_id, 0L)')}, {_sortable('xxhash64(text)')}, hex(_row))"))
    ranges = min(MAX_RANGES, -(-n_rows // ROWS_PER_BUCKET))
    sample = df.filter(F.pmod("_row", F.lit(max(1, n_rows // max(1, KEYS_PER_RANGE * ranges)))) == 0).select("_key")
    keys = sorted(r["_key"] for r in sample.collect())
    borders = sorted({"", *(keys[i * len(keys) // ranges] for i in range(1, ranges))}) if keys else [""]
    listed = f"split('{','.join(borders)}', ',')"       # a constant of the plan
    df = df.withColumn("_part", F.expr(last_not_above(listed, "_key", str(len(borders) - 1)))).drop("_row")

    order = Window.partitionBy("_part").orderBy("_key")
    df = (df.withColumn("_rank", F.row_number().over(order))
          .withColumn("_next", F.lead(F.struct("text", "sigs")).over(order)).drop("_key"))
    first = df.filter("_rank = 1").select(F.col("_part").alias("_p"), F.struct("text", "sigs").alias("_first"))
    parts = first.select("_p")
    rising = Window.orderBy("_p")       # one small row a range, at most MAX_RANGES
    after = parts.select("_p", F.coalesce(
        F.lead("_p").over(rising), F.first("_p").over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    ).alias("_to"))
    heads = after.join(first.withColumnRenamed("_p", "_to"), "_to").select(F.col("_p").alias("_part"), "_first")
    out = df.join(heads, "_part", "left")
    following = F.coalesce("_next", "_first")
    return out.select("doc_id", "text", "sigs", following["text"].alias("next_text"), following["sigs"].alias("next_sigs"))


def op2_spot_signatures(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n_rows = docs.count()
    df = with_next(with_signatures(docs, "text", "sigs"), n_rows)
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    df = df.withColumn("edited", F.expr(
        "concat(substring(text, 1, cast(n_chars - n_chars div 3 as int)), substring(next_text, 1, cast(n_chars div 3 as int)))"))
    df = with_signatures(df, "edited", "edited_sigs")
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("sigs").alias("fingerprint"), as_text("edited_sigs").alias("edited_fingerprint"),
        jaccard("sigs", "edited_sigs").alias("near_edited"), jaccard("sigs", "next_sigs").alias("near_next"),
        F.size("sigs").cast("long").alias("n_signatures"), length_part("sigs").alias("length_part"))
