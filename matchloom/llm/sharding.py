"""Shards of near-equal size by a minimax contiguous partition. DataFrame functions only.

Rows with equal texts form a group that is never divided. Groups stand in the order of a hash of their
text, and the smallest capacity for which a greedy pass needs no more than the given number of shards is found
by binary search. The driver holds no groups but sums over ranges of the order: a pass with rounded-down
and one with rounded-up cuts bound the capacity, and only the ranges in which a cut may still fall are read
again in finer ranges, until these are single groups. Then the partition is exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import hash60, running, stored

_BITS = 60


def _greedy(pieces: list[tuple], shards: int, capacity: int, up: bool) -> list[int] | None:
    """Numbers of the pieces before which (or, if up, within or after which at the latest) the shards end; None where
    they do not suffice. Pieces: (lowest key, bits, bytes, groups, largest group)."""
    ends, room = [], capacity
    for i, (_, _, size, groups, largest) in enumerate(pieces):
        if groups == 1 or not up:
            if size > capacity:
                return None
            if size > room:
                ends.append(i)
                room = capacity
            room -= size
        else:  # as if it could be cut anywhere
            if largest > capacity:
                return None
            while size > room:
                size -= room
                ends.append(i + 1)
                room = capacity
            room -= size
        if len(ends) >= shards:
            return None
    return ends


def _smallest(pieces: list[tuple], shards: int, low: int, high: int, up: bool) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if _greedy(pieces, shards, middle, up) is not None else (middle + 1, high)
    return low


def _between(pieces: list[tuple], shards: int, low: int, high: int) -> list[tuple[int, int]]:
    """For each shard but the last, the pieces between which a greedy pass ends it, for any capacity from low to high: the
    ends never move back as the capacity grows."""
    first, k = [], 0
    while len(first) < shards - 1:
        room = low
        while k < len(pieces) and pieces[k][2] <= room:
            room -= pieces[k][2]
            k += 1
        first.append(k)
    last = _greedy(pieces, shards, high, True)
    last += [len(pieces)] * (shards - 1 - len(last))
    return list(zip(first, last, strict=True))


def _pieces(groups: DataFrame, ranges: list[tuple[int, int]] | None, bits: int) -> list[tuple]:
    """Sums over ranges of 2**bits keys, within the given (lowest key, bits) ranges."""
    if ranges is not None:
        inside = [F.col("key").between(a, a + (1 << b) - 1) for a, b in ranges]
        groups = groups.filter(reduce(Column.__or__, inside))
    at = F.shiftright("key", bits)
    rows = groups.groupBy(at.alias("at")).agg(F.sum("bytes"), F.count("*"), F.max("bytes"), F.min("key")).collect()
    return sorted((r[4], 0, r[1], 1, r[3]) if r[2] == 1 else (r[0] << bits, bits, *r[1:4]) for r in rows)


def capacity_and_cuts(groups: DataFrame, shards: int, first_bits: int = 13) -> tuple[int, list[int]]:
    """The smallest capacity and the keys at which shards 1, 2, ... begin. groups: key (60 bits, unique), bytes."""
    bits = _BITS - first_bits
    pieces = _pieces(groups, None, bits)
    low, high = 1, max(1, sum(p[2] for p in pieces))
    while pieces:
        low, high = _smallest(pieces, shards, low, high, True), _smallest(pieces, shards, low, high, False)
        if low == high:
            break
        open_pieces = {i for a, b in _between(pieces, shards, low, high) for i in range(a, min(b + 1, len(pieces))) if pieces[i][3] > 1}
        bits = max(pieces[i][1] for i in open_pieces)
        widest = sorted((i for i in open_pieces if pieces[i][1] == bits), key=lambda i: -pieces[i][2])[:200]
        finer = _pieces(groups, [pieces[i][:2] for i in widest], max(0, bits - 7))
        pieces = sorted([p for i, p in enumerate(pieces) if i not in set(widest)] + finer)
    return low, [pieces[i][0] for i in _greedy(pieces, shards, low, False)] if pieces else []


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """One row per document: doc_id, size (bytes of the text plus 1), text_crc32, key, shard, slot.

    A null text counts as empty, of size 1. Repeated rows are rows of their own and share a shard. Slots are gapless
    from 0 in each shard, in the order of a hash of doc_id. With fewer groups than shards the last
    shards stay empty. A text of any length counts whole, and a group larger than all others alone sets the capacity; columns besides doc_id and text are not read, and no rows give no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 4).alias("key"), hash60(F.col("doc_id")).alias("h"), F.monotonically_increasing_id().alias("uid"),
        ), "sizes",
    )
    groups = stored(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "group-sizes")
    _, cuts = capacity_and_cuts(groups, shards)
    shard = sum((F.when(F.col("key") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    placed = rows.withColumn("shard", shard.cast("int"))
    numbered = running(placed, ["shard"], ["h", "doc_id", "key", "uid"], F.lit(1).cast("long"), "slot")
    return numbered.select("doc_id", "size", "text_crc32", "key", "shard", "slot")
