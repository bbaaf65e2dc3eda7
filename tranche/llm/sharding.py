"""Sharding by best-fit-decreasing bin packing (operator 8).

A group (equal texts) is never divided.  Groups too large to be noise are
packed one by one; the many small ones are first gathered by hash into lots of
graded sizes, each as indivisible as a group, so that the driver sees a number
of items that the shard count bounds, whatever the table's size.  Items sorted
by size enter the shard whose remaining capacity is the tightest that holds
them, found in a balanced search tree.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, stored, text_key
from .numbering import rank_within

SHARDS = 16
#: lots per shard and the share of the small groups that goes to them
LOT_GRADES = ((512, 0.90), (256, 0.09), (128, 0.01))
BIG_SHARE = 1 / 1024     # of a shard: larger groups are packed by themselves


class SpaceTree:
    """Treap of (remaining capacity, bin): expected logarithmic depth."""

    def __init__(self):
        self.root, self.rng = None, random.Random(0)

    def add(self, key):
        a, b = self._split(self.root, key)
        self.root = self._join(self._join(a, [key, self.rng.random(), None, None]), b)

    def take_tightest(self, size):
        """Remove and return the smallest key with at least ``size`` remaining."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            return None
        node = b
        while node[2] is not None:
            node = node[2]
        low, b = self._split(b, (node[0][0], node[0][1] + 1))
        self.root = self._join(a, b)
        return low[0]

    def _split(self, t, key):
        if t is None:
            return None, None
        if t[0] < key:
            a, b = self._split(t[3], key)
            t[3] = a
            return t, b
        a, b = self._split(t[2], key)
        t[2] = b
        return a, t

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """Bin of each size; None if more than ``most`` bins would be needed.  A
    size above the capacity raises."""
    tree, bins, out = SpaceTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        if sizes[i] > capacity:
            raise ValueError(f"group of {sizes[i]} bytes exceeds the capacity {capacity}")
        found = tree.take_tightest(sizes[i])
        if found is None:
            found = (capacity, bins)
            bins += 1
            if most is not None and bins > most:
                return None
        out[i] = found[1]
        tree.add((found[0] - sizes[i], found[1]))
    return out


def near_equal_bins(sizes: list[int], bins: int) -> list[int]:
    """Best-fit-decreasing at the smallest capacity that needs at most
    ``bins`` bins.  A group above the even share gets a bin of its own, and
    the even share of the others is taken anew."""
    out = [0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda k: (-sizes[k], k))
    total, used = sum(sizes), 0
    while order and bins - used > 1 and sizes[order[0]] * (bins - used) > total:
        out[order[0]] = used
        total -= sizes[order[0]]
        used += 1
        order = order[1:]
    rest = [sizes[k] for k in order]
    if rest:
        low = max(-(-total // (bins - used)), rest[0])
        high, best = low, None
        while best is None:                 # the first capacity that suffices
            best = best_fit_decreasing(rest, high, bins - used)
            high = high if best else high + max(1, high // 64)
        while low < high:
            mid = (low + high) // 2
            fits = best_fit_decreasing(rest, mid, bins - used)
            if fits is None:
                low = mid + 1
            else:
                high, best = mid, fits
        for k, b in zip(order, best):
            out[k] = used + b
    return out


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1.  A null text is an empty one, and
    in its group.  Repeated or null ids are rows like others; an empty table
    gives no rows.  Only group keys and sizes are shuffled, added up before the
    shuffle, so a text shared by a third of the rows is one row per task.
    The driver holds the lots and at most ``shards / BIG_SHARE`` groups.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), text_key().alias("key"),
                              F.monotonically_increasing_id().alias("uid")), "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    big_from = max(2, int(total * BIG_SHARE / shards))
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    is_big = F.col("bytes") >= big_from

    # lot of a small group: a grade by one part of the hash, a place in it by another
    lots, first, below = F.lit(None).cast("int"), 0, 0.0
    u, h = F.pmod(F.xxhash64(F.lit(1), "key"), F.lit(1 << 20)) / F.lit(float(1 << 20)), F.xxhash64(F.lit(2), "key")
    for per_shard, share in LOT_GRADES:
        n = per_shard * shards
        lots = F.when((u >= below) & (u < below + share), (F.pmod(h, F.lit(n)) + first).cast("int")).otherwise(lots)
        first, below = first + n, below + share
    lots = F.coalesce(lots, F.lit(first - 1))
    summed = groups.groupBy(F.when(is_big, F.col("key")).alias("key"), F.when(~is_big, lots).alias("lot")).agg(F.sum("bytes").alias("bytes"))
    items = sorted(((r["key"] and bytes(r["key"]), r["lot"], r["bytes"]) for r in summed.collect()), key=lambda r: (-r[2], r[0] or b"", r[1] or 0))
    placed = near_equal_bins([r[2] for r in items], shards)

    # both lists are bounded by the number of shards
    spark = docs.sparkSession
    big = spark.createDataFrame([(r[0], s) for r, s in zip(items, placed) if r[0] is not None], "key binary, big_shard int")
    of_lot = spark.createDataFrame([(r[1], s) for r, s in zip(items, placed) if r[0] is None], "lot int, lot_shard int")
    sharded = (rows.join(F.broadcast(big), "key", "left").withColumn("lot", lots)
               .join(F.broadcast(of_lot), "lot", "left")
               .select("doc_id", "size", "text_crc32", "uid", F.coalesce("big_shard", "lot_shard").alias("shard")))
    ranked = rank_within(stored(sharded, "sharded"), "shard", "uid", "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    return shard_documents(read(spark, sf_dir, "documents"))
