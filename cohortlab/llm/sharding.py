"""Sharding by best-fit-decreasing bin packing (operator 5).

Groups of documents (equal texts, or any key) are indivisible. Sorted by size,
each goes to the bin with the tightest remaining capacity that still holds it;
a balanced search tree over the remaining capacities finds that bin. A group
larger than the fair share of what is left fills a shard alone before the others
are packed evenly into the remaining shards.

Only a bounded list is packed in order. A group larger than 1/``grain`` of the
fair share of the remaining shards is an item of its own: there are at most
shards * grain of these. All smaller groups are hashed into shards * grain parcels, which are
items as well; parcels have no fixed size, so they are packed by their true
sizes with the rest. Counting, grouping and the way back to the documents are
Spark joins; at most 2 * shards * grain (key, size) pairs reach the packer.

Slots: inside a shard documents are counted by hash bucket, the counts summed
up, and only the rank within a bucket needs its rows together, so no task sees
a whole shard.

Defined cases: a null text has no bytes and equals the empty text; an empty
table gives an empty result; a group larger than the fair share fills a
shard alone; repeated and null ids get slots of their own; input columns named like an
output are replaced.
"""

from __future__ import annotations

import bisect
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlab.llm.common import table, without, written


class CapacityTree:
    """Treap over (remaining capacity, bin): insert, and take the tightest fit."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, priority, left, right]
        self.draw = random.Random(7)

    def _split(self, node, key):
        """Trees of the keys below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def insert(self, key: tuple[int, int]) -> None:
        a, b = self._split(self.root, key)
        self.root = self._join(self._join(a, [key, self.draw.random(), None, None]), b)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest key whose capacity is at least ``size``."""
        a, b = self._split(self.root, (size, -1))
        if b is None:
            self.root = a
            return None
        node = b
        while node[2] is not None:
            node = node[2]
        _, rest = self._split(b, (node[0][0], node[0][1] + 1))
        self.root = self._join(a, rest)
        return node[0]


def best_fit_decreasing(items: list[tuple[str, int]], capacity: int) -> tuple[dict[str, int], list[int]]:
    """Item -> bin, and the fill of each bin; as many bins as it takes.

    Items larger than the capacity get a bin alone. Ties go by key, then by bin.
    """
    tree, fill, place = CapacityTree(), [], {}
    for key, size in sorted(items, key=lambda x: (-x[1], x[0])):
        found = tree.take_tightest(size)
        if found is None:
            found = (capacity, len(fill))
            fill.append(0)
        left, at = found
        place[key] = at
        fill[at] += size
        if left - size > 0:
            tree.insert((left - size, at))
    return place, fill


def oversized(sizes: list[int], total: int, shards: int) -> tuple[int, int]:
    """How many of the descending ``sizes`` get a shard alone, and what the others weigh.

    A size above the fair share of what is left takes a shard; the share of the
    others shrinks with it, so the next size is held against the new share.
    """
    alone = 0
    for size in sizes:
        if alone == shards - 1 or size * (shards - alone) <= total:
            break
        alone, total = alone + 1, total - size
    return alone, total


def pack_into(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Items above the fair share get bins alone; the others the smallest
    capacity (by bisection) at which the remaining bins suffice, then levelled."""
    items = sorted(items, key=lambda x: (-x[1], x[0]))
    alone, _ = oversized([s for _, s in items], sum(s for _, s in items), shards)
    place = {key: at for at, (key, _) in enumerate(items[:alone])}
    rest = _pack_evenly(items[alone:], shards - alone)
    return {**place, **{key: alone + at for key, at in rest.items()}}


def _pack_evenly(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    if not items:
        return {}
    total = sum(s for _, s in items)
    low, high = max(-(-total // shards), max(s for _, s in items)), total
    best = None
    while low < high:
        mid = (low + high) // 2
        place, fill = best_fit_decreasing(items, mid)
        if len(fill) <= shards:
            best, high = place, mid
        else:
            low = mid + 1
    if best is None or high != low or len(set(best.values())) > shards or not _fits(best, items, low):
        best = best_fit_decreasing(items, low)[0]
    return _levelled(best, items, shards)


def _levelled(place: dict[str, int], items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """``place`` after moves from the fullest to the emptiest bin, while one lessens their gap.

    Best fit fills bins to the capacity one after the other, so the last ones
    hold what is left over.
    """
    own: list[list[tuple[int, str]]] = [[] for _ in range(max(shards, 1 + max(place.values())))]
    for key, size in items:
        own[place[key]].append((size, key))
    for held in own:
        held.sort()
    fill = [sum(size for size, _ in held) for held in own]
    while True:
        top, low = fill.index(max(fill)), fill.index(min(fill))
        at = bisect.bisect_right(own[top], ((fill[top] - fill[low]) // 2, chr(0x10FFFF))) - 1
        if at < 0 or own[top][at][0] == 0:
            break
        size, key = own[top].pop(at)
        bisect.insort(own[low], (size, key))
        fill[top], fill[low] = fill[top] - size, fill[low] + size
    return {key: at for at, held in enumerate(own) for _, key in held}


def _fits(place: dict[str, int], items: list[tuple[str, int]], capacity: int) -> bool:
    fill: dict[int, int] = {}
    for key, size in items:
        fill[place[key]] = fill.get(place[key], 0) + size
    return max(fill.values()) <= capacity


def group_items(rows: DataFrame, shards: int, grain: int) -> tuple[DataFrame, list[tuple[str, int]]]:
    """(group, item) of every group, and the bounded list of (item, size)."""
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    parts = shards * grain
    # at most ``shards`` rows; the grain follows the share of what the oversized leave
    largest = [int(r["size"]) for r in groups.select("size").orderBy(F.desc("size")).limit(shards).collect()]
    alone, rest = oversized(largest, int(total), shards)
    parcel = F.concat(F.lit("p"), F.pmod(F.xxhash64("group"), F.lit(parts)).cast("string"))
    named = groups.withColumn("item", F.when(F.col("size") * ((shards - alone) * grain) > rest, F.concat(F.lit("g"), "group")).otherwise(parcel))
    listed = named.groupBy("item").agg(F.sum("size").alias("size")).collect()
    return named.select("group", "item"), [(r["item"], int(r["size"])) for r in listed]


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = 24,
                    grain: int = 512, slot_buckets: int = 1024) -> DataFrame:
    """``docs`` with size, shard (0 .. shards-1) and slot (gapless in the shard)."""
    spark = docs.sparkSession
    docs = without(docs, ("size", "shard", "slot"))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       (F.octet_length(whole) + 8).cast("long").alias("size"), F.sha2(whole, 256).alias("group"),
                       F.col(id_col).alias("id"))
    items_of, items = group_items(rows.select("group", "size"), shards, grain)
    place = pack_into(items, shards)
    # bounded by 2 * shards * grain rows
    bins = spark.createDataFrame(sorted(place.items()), "item string, shard int")
    homes = items_of.join(F.broadcast(bins), "item").select("group", "shard")
    # a text copied in a third of all rows: the group side is one row, and the
    # join's hot partition is split by the adaptive skew join
    placed = rows.join(homes, "group")
    bucket = F.pmod(F.xxhash64("group", "id"), F.lit(slot_buckets)).cast("int")
    placed = placed.withColumn("bucket", bucket)
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("group", F.col("id").asc_nulls_last())) - 1
    return (placed.withColumn("rank", rank).join(F.broadcast(starts), ["shard", "bucket"])  # shards * slot_buckets rows
            .select("row.*", "size", "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    narrow = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sharded = shard_documents(narrow.select("doc_id", "text", F.crc32("text").alias("text_crc32")))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
