"""Sharding: minimax contiguous partition of atomic groups, capacity found by binary search."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import running_totals, store

#: Rows of a summary of cut positions that the driver may hold at once, whatever the input.
SUMMARY = 65_536


class _Ends:
    """What is known of the sorted group ends: per bucket its least and largest end and their number."""

    def __init__(self, rows):
        self.rows = sorted((int(lo), int(hi), int(n)) for lo, hi, n in rows)
        self.lows = [r[0] for r in self.rows]

    def last_up_to(self, at: int) -> tuple[int, int]:
        """Bounds (least, largest possible) of the largest end that is at most `at`."""
        i = bisect.bisect_right(self.lows, at) - 1
        if i < 0:
            return 0, 0
        lo, hi, n = self.rows[i]
        if at >= hi:
            return hi, hi
        return (lo, lo) if n <= 2 else (lo, at)


def _chain(ends: _Ends, capacity: int, shards: int, side: int, giants) -> list[int]:
    """Greedy cuts under `capacity`; side 0 takes the least possible positions, side 1 the largest. A giant above it stands alone."""
    at, cuts = 0, []
    for _ in range(shards):
        now = ends.last_up_to(at + capacity)[side]
        now = max(at, next((s for s, e in giants if s < now < e), now))  # no group ends inside another
        if now == at:
            now = next((e for s, e in giants if s == at), at)
        at = now
        cuts.append(at)
    return cuts


def _smallest(ends: _Ends, total: int, shards: int, lo: int, hi: int, side: int, giants) -> int:
    while lo < hi:
        mid = (lo + hi) // 2
        if _chain(ends, mid, shards, side, giants)[-1] >= total:
            hi = mid
        else:
            lo = mid + 1
    return lo


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int, summary: int = SUMMARY, giants=()) -> list[int]:
    """The `shards` cut positions of the contiguous partition whose largest part is smallest.

    `ends` has one row per atomic group in order, column `end` = sizes up to and with it. The driver
    never holds more than about `summary` rows: it gets the least and largest end of so many
    equal-width buckets, binary-searches the capacity between the bounds these allow, and asks again only
    about the stretches where a cut may still lie, until capacity and cuts are exact.

    `largest` is the size of the largest group, which is the least capacity; unless the `shards` largest groups are given as
    `giants` (start, end): then one above the capacity takes a part of its own, and the capacity is the smallest for all others.
    """
    windows = [(0, total)]
    lo, hi = 1 if giants else max(-(-total // shards), largest), total
    known: list[tuple[int, int, int]] = []
    width = 2 * total + 2
    while True:
        # at least halved every time, so the search ends even where a tiny summary leaves all in doubt
        width = max(1, min(width // 2, -(-sum(b - a for a, b in windows) // summary)))
        inside, bucket, base = F.lit(False), F.lit(None).cast("long"), 0
        for a, b in windows:
            here = (F.col("end") > a) & (F.col("end") <= b)
            bucket = F.when(here, F.floor((F.col("end") - a - 1) / width) + base).otherwise(bucket)
            inside = inside | here
            base += (b - a) // width + 1
        rows = ends.where(inside).groupBy(bucket.alias("b")).agg(F.min("end").alias("lo"), F.max("end").alias("hi"), F.count_distinct("end").alias("n")).collect()
        known = [k for k in known if not any(a < k[1] and k[0] <= b for a, b in windows)] + [(r["lo"], r["hi"], r["n"]) for r in rows]
        at = _Ends(known)
        lo, hi = _smallest(at, total, shards, lo, hi, 1, giants), _smallest(at, total, shards, lo, hi, 0, giants)
        least, most = _chain(at, lo, shards, 0, giants), _chain(at, hi, shards, 1, giants)
        if lo == hi and least == most:
            return least
        # a bucket that a doubtful stretch touches is asked about as a whole
        wanted = sorted((max(0, min([k[0] for k in at.rows if k[0] <= a < k[1]], default=a) - 1), max([k[1] for k in at.rows if k[0] <= b < k[1]], default=b)) for a, b in zip(least, most) if a < b or any(k[0] <= a < k[1] for k in at.rows))
        merged: list[tuple[int, int]] = []
        for a, b in wanted:
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        windows = merged


def shard(docs: DataFrame, shards: int = 16, summary: int = SUMMARY) -> DataFrame:
    """Put all rows of (doc_id, text) into shards of near-equal bytes; equal texts stay together.

    Result: doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('bytes'), shard (from 0), slot (gapless
    from 0 in each shard), grown_shard (null under this law). Groups of equal texts are atomic and
    stand in one order, that of their md5, and shards are ranges of it. The capacity is the smallest with which a greedy
    pass needs no more than `shards` shards; only a group that is itself above it makes a larger one, alone.

    A null text is of size 1 and its rows form one group, the last, apart from empty texts; text_crc32 of null is
    that of no bytes (0). Repeated rows count each. An empty table gives an empty result. Other columns
    of `docs` are ignored.
    """
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = store(
        docs.select(
            "doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"), F.crc32(data).cast("long").alias("text_crc32"),
            F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.md5(data)).alias("group"),
        )
    )
    groups = store(rows.groupBy("group").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    placed = store(running_totals(groups.withColumn("all", F.lit(0)), ["all"], ["group"], {"bytes": "before"}).select("group", "before", (F.col("before") + F.col("bytes")).alias("end")))
    giants = [(r["before"], r["end"]) for r in placed.orderBy((F.col("before") - F.col("end")), "group").limit(shards).collect()]
    cuts = minimax_cuts(placed, total, 0, shards, summary, giants) if total else []
    number = F.lit(0)
    for c in cuts[:-1]:
        number = number + (F.col("end") > c).cast("int")
    out = rows.join(placed.select("group", number.alias("shard")), "group").withColumn("one", F.lit(1).cast("long"))
    out = running_totals(out, ["shard"], ["group", "doc_id"], {"one": "slot"})
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int"), "slot", F.lit(None).cast("int").alias("grown_shard"))
