"""Sharding by best-fit-decreasing bin packing.

Rows with equal texts form a group that stays together.  Items, largest
first, enter the bin whose remaining room fits them most tightly; bins are
found in a balanced search tree (a treap) keyed by remaining room.

``pack`` fills shards of a fixed capacity, as few as it can; ``balance`` asks
for a number of shards and searches the smallest capacity that
best-fit-decreasing needs for it, so sizes come out near equal (law
``bytes``).  Both are exact on groups of at least a PIECES-th of a shard.
Smaller groups are first poured together, by a hash of their text, into
composite items of about that size, so that one packing task sees a bounded
number of items (under 2 * PIECES a shard) however many rows there are.
``pack`` cuts the table into cells of CELL_SHARDS shards that are packed side
by side.

A group larger than a whole shard cannot be kept together at any capacity: it
is split by a hash of the id into parts of a SPLIT-th of a shard.  Sizes are
UTF-8 bytes plus one, so empty and null texts (one group) weigh 1.  Repeated
rows are separate rows of one group.  An empty table gives no rows.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow.llm.common import running_sum, stored, table, uniform_key

PIECES = 512
SPLIT = 16
CELL_SHARDS = 64


class RoomTree:
    """Treap of (room, bin) pairs with a smallest-at-least search."""

    def __init__(self) -> None:
        self.root = None
        self.random = random.Random(7)

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, [key, self.random.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the pair of least room that holds ``size``."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, rest = self._split(self.root, best)
            _, high = self._split(rest, (best[0], best[1] + 1))
            self.root = self._merge(low, high)
        return best

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each size; ``sizes`` in falling order.  A size over the
    capacity gets a bin to itself."""
    tree, bins, out = RoomTree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            found, bins = (max(capacity, size), bins), bins + 1
        out.append(found[1])
        tree.add((found[0] - size, found[1]))
    return out


def fewest_room(sizes: list[int], n_bins: int) -> list[int]:
    """Best fit at the least capacity, to one part in 10,000, that needs at
    most ``n_bins`` bins."""
    if not sizes:
        return []
    low = max(sizes[0], -(-sum(sizes) // n_bins))
    high, best = low, best_fit(sizes, low)
    while max(best) >= n_bins:
        low, high = high, high + max(1, high // 4)
        best = best_fit(sizes, high)
    while high - low > max(1, high // 10_000):
        middle = (low + high) // 2
        found = best_fit(sizes, middle)
        if max(found) < n_bins:
            high, best = middle, found
        else:
            low = middle
    return best


def _items(rows: DataFrame, per_cell: int, shard_bytes: float) -> DataFrame:
    """Adds ``cell`` and ``item``: what a row is packed with."""
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"))
    groups = groups.filter(F.col("_bytes") * PIECES >= shard_bytes)   # at most PIECES a shard
    out = rows.join(groups, "_group", "left")
    parts = F.ceil(F.col("_bytes") / F.lit(max(1.0, shard_bytes / SPLIT)))
    part = F.when(F.col("_bytes") > shard_bytes, F.pmod(uniform_key(F.col("doc_id"), F.lit("part")), parts)).otherwise(F.lit(0))
    big = F.concat_ws(":", F.lit("g"), "_group", part.cast("string"))
    small = F.concat(F.lit("c"), F.pmod(F.conv(F.substring("_group", 21, 10), 16, 10).cast("long"), F.lit(per_cell * PIECES)).cast("string"))
    return out.withColumn("item", F.when(F.col("_bytes").isNull(), small).otherwise(big)).drop("_bytes")


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return stored(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.sha1(t.cast("binary")).alias("_group")), "shard-rows")


def _packed(rows: DataFrame, cells: int, n_bins: int | None, capacity: int | None) -> DataFrame:
    """Adds ``cell`` and ``bin``."""
    rows = rows.withColumn("cell", F.pmod(F.conv(F.substring("_group", 31, 10), 16, 10).cast("long"), F.lit(cells)))
    items = rows.groupBy("cell", "item").agg(F.sum("size").alias("size"))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        sizes = [int(x) for x in pdf["size"]]
        bins = fewest_room(sizes, n_bins) if n_bins else best_fit(sizes, capacity)
        return pd.DataFrame({"cell": pdf["cell"], "item": pdf["item"], "bin": bins})

    # a cell holds a bounded number of items (see the module's text), not of rows
    bins = stored(items.groupBy("cell").applyInPandas(fill, "cell long, item string, bin long"), "shard-bins")
    bound = cells * 3 * PIECES * CELL_SHARDS
    return rows.join(F.broadcast(bins) if cells == 1 and bound <= 100_000 else bins, ["cell", "item"])


def balance(docs: DataFrame, n_shards: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its size, text_crc32, shard (0 to n_shards - 1) and
    slot (gapless in its shard): shards of near equal bytes."""
    rows = _measured(docs, doc_id, text)
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    rows = _items(rows, n_shards, total / n_shards)
    out = _packed(rows, 1, n_shards, None).withColumn("shard", F.col("bin").cast("int"))
    out = out.withColumn("_key", uniform_key(F.col("doc_id")))
    return running_sum(out.drop("cell", "bin", "item"), ["shard"], ["_key", "doc_id", "text_crc32"], None, "slot", n)


def pack(docs: DataFrame, capacity: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with its size and shard (``cell:bin``): shards of at most
    ``capacity`` bytes, except that a single larger row has its own."""
    rows = _measured(docs, doc_id, text)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cells = max(1, -(-total // (capacity * CELL_SHARDS)))
    out = _packed(_items(rows, CELL_SHARDS, float(capacity)), cells, None, capacity)
    return out.select("doc_id", "size", "text_crc32", F.concat_ws(":", "cell", "bin").alias("shard"))


def op6_best_fit_shards(spark, sf_dir: str) -> DataFrame:
    return balance(table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
