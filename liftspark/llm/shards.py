"""Minimax contiguous partition into shards, with DataFrame functions only.

Documents with equal texts form an atomic group; groups are ordered by a hash of their text. The smallest
capacity for which a greedy pass over the ordered group sizes needs no more than the given number of shards
is found by binary search. The pass runs on sizes summed over hash ranges: a bounded table. Ranges in which a
cut can lie, for any capacity still possible, are summed anew in finer ranges until they hold one group
each; then the search is exact. Neither documents nor groups come to the driver.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from liftspark.llm.common import stored

FIRST_BITS, MORE_BITS = 12, 8
ROWS_PER_RANGE = 8192


@dataclass(frozen=True)
class Range:
    """Consecutive groups: smallest and largest hash, bytes."""

    low: int
    high: int
    size: int

    @property
    def single(self) -> bool:
        return self.low == self.high


def greedy(prefix: list[int], shards: int, capacity: int) -> list[int] | None:
    """Cut positions in ``prefix`` when each shard takes all that fits, or None if something is left."""
    cuts, at = [], 0
    for _ in range(shards):
        at = bisect_right(prefix, prefix[at] + capacity) - 1
        cuts.append(at)
    return cuts if at == len(prefix) - 1 else None


def smallest_capacity(prefix: list[int], shards: int, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if greedy(prefix, shards, mid) else (mid + 1, high)
    return low


def undecided(ranges: list[Range], prefix: list[int], shards: int, low: int, high: int) -> list[Range]:
    """Ranges of several groups in which the greedy pass can cut, for a capacity from ``low`` to ``high``."""
    found: dict[int, Range] = {}
    earliest = latest = 0
    for _ in range(shards - 1):
        earliest = prefix[bisect_right(prefix, earliest + low) - 1]
        latest += high
        first = bisect_right(prefix, earliest) - 1
        for i in range(first, len(ranges)):
            if prefix[i] >= latest:
                break
            if not ranges[i].single:
                found[i] = ranges[i]
    return [found[i] for i in sorted(found)]


def summed(groups: DataFrame, bits: int) -> list[Range]:
    """Sizes by the first ``bits`` of the hash."""
    rows = (
        groups.groupBy(F.shiftright("h", 64 - bits).alias("cell"))
        .agg(F.min("h"), F.max("h"), F.sum("size"))
        .orderBy("cell")
        .collect()  # at most 2**FIRST_BITS rows, or 2**MORE_BITS for each undecided range
    )
    return [Range(low, high, size) for _, low, high, size in rows]


def cut_hashes(groups: DataFrame, shards: int) -> list[int]:
    """The largest hash of every shard but the last, for groups (``h``, ``size``)."""
    ranges, bits = summed(groups, FIRST_BITS), FIRST_BITS
    if not ranges:
        return []
    largest = groups.agg(F.max("size")).first()[0]
    while True:
        prefix = [0]
        for r in ranges:
            prefix.append(prefix[-1] + r.size)
        low = max(largest, -(-prefix[-1] // shards))
        high = smallest_capacity(prefix, shards, low, prefix[-1])
        doubtful = undecided(ranges, prefix, shards, low, high)
        if not doubtful:
            cuts = greedy(prefix, shards, high)
            return [ranges[i - 1].high for i in cuts[:-1]]
        bits = min(64, bits + MORE_BITS)
        near = F.lit(False)
        for r in doubtful:
            near = near | F.col("h").between(r.low, r.high)
        finer = summed(groups.filter(near), bits)
        ranges = sorted([*(r for r in ranges if r not in set(doubtful)), *finer], key=lambda r: r.low)


def shard_documents(documents: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``documents``.

    The law is ``bytes``: the largest shard is as small as contiguous cuts between groups allow; trailing shards
    may stay empty if groups are few. ``size`` is UTF-8 bytes plus 1. Equal texts share a shard, null texts
    too (two texts of one 64-bit hash would as well, which breaks no rule). Slots count from 0 in each shard, dealt by a hash
    of the id so that no shard is numbered by one task; equal rows are interchangeable. Only the two named
    columns are read; an empty table gives an empty result.
    """
    rows = stored(
        documents.select(
            F.col(id).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(text), F.col(text).isNull()).alias("h"),
        ),
        "shards",
    )
    groups = stored(rows.groupBy("h").agg(F.sum("size").alias("size")), "shard-groups")
    cuts = cut_hashes(groups, shards)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("h") > c).cast("int")
    ranges = max(1, -(-rows.count() // (rows_per_range * shards)))
    dealt = rows.select("*", shard.cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id", "h"), F.lit(ranges)).alias("part"))
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(F.col("shard").alias("s"), F.col("part").alias("p"))
        .agg(F.count("*").alias("n"))
        .select("s", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    turn = F.row_number().over(Window.partitionBy("shard", "part").orderBy("doc_id", "h", "size")) - 1
    return dealt.join(starts, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p"))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + turn).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
