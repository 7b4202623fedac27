"""SimHash near-dedup: segment-popcount embedding, grid range-join under Manhattan distance, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import store
from citespark.llm.components import connected_components

#: 32 segments of two bits: the popcount vector of a fingerprint, two bits a component.
SEGMENTS = 32
#: A cell of more fingerprints than this is split into blocks that are compared pair by pair of blocks.
BLOCK = 4096
_CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64 bits; a bit is 1 if set in over half of the XXH64 (seed 42) of the word shingles; 0 for no words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-shingle] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = np.array(hashes[i : i + _CHUNK], np.uint64)
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and its fingerprint as a (signed) long, one row per input row."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return docs.select("doc_id", of("text").alias("fp"))


def _cells(fps: DataFrame, max_bits: int) -> DataFrame:
    """Grid cells of each fingerprint: (cell, tag, fp).

    The popcount vector's Manhattan distance is a lower bound of the Hamming distance. The segments
    are dealt into parts so that within `max_bits` some part differs by 2 at most; two such
    sub-vectors share a grid point within 1 of both, so each fingerprint goes to its own cell and
    to those one step away, in each part.
    """
    parts = max_bits // 3 + 1
    with_pop = fps.select("fp", _popcounts(F.col("fp")).alias("pop"))
    cells = []
    for p in range(parts):
        mine, near = _steps(F.col("pop"), range(p * SEGMENTS // parts, (p + 1) * SEGMENTS // parts))
        cells.append(F.struct(F.array_compact(F.array(mine, *near)).alias("cells"), F.lit(p).cast("long").alias("tag")))
    by_part = with_pop.select("fp", F.explode(F.array(*cells)).alias("c"))
    return by_part.select(F.explode("c.cells").alias("cell"), F.col("c.tag").alias("tag"), "fp")


_LOW = 0x5555555555555555


def _signed(n: int):
    return F.lit(int(np.uint64(n).view(np.int64)))


def _popcounts(x):
    """The number of set bits of each two-bit segment, two bits each."""
    up = F.shiftrightunsigned(x, 1)
    return F.shiftleft(x.bitwiseAND(up).bitwiseAND(F.lit(_LOW)), 1).bitwiseOR(x.bitwiseXOR(up).bitwiseAND(F.lit(_LOW)))


def _steps(pop, fields) -> tuple:
    """The cell of a popcount vector's `fields`, and the cells one step away (null where a step leaves 0 .. 2)."""
    mine = pop.bitwiseAND(_signed(sum(3 << 2 * f for f in fields)))
    near = []
    for f in fields:
        v = F.shiftrightunsigned(pop, 2 * f).bitwiseAND(F.lit(3).cast("long"))
        near.append(F.when(v < 2, mine.bitwiseXOR(_signed(1 << 2 * f))))  # 0 to 1 and 1 to 0
        near.append(F.when(v > 0, mine.bitwiseXOR(_signed(3 << 2 * f))))  # 1 to 2 and 2 to 1
    return mine, near


def _code_cells(nodes: DataFrame, words: int, parts: int, steps: bool) -> DataFrame:
    """Grid cells of codes (root, code: array of `words` longs): (cell, tag, fp, other, root).

    Each word gives `parts` sub-vectors of popcounts. All go to their own cell, those of an odd sum to the cells one step
    away as well (whose sums are even): so sub-vectors at Manhattan distance 1, and two odd ones at distance 2, share a
    cell. `fp` is the first word, `other` the word that the cell is of, or the second for cells of the first. Without `steps`
    all go to their own cell alone.
    """
    pops = nodes.select("root", *[F.col("code")[w].alias(f"w{w}") for w in range(words)])
    cells = []
    for w in range(words):
        pop = _popcounts(F.col(f"w{w}"))
        for p in range(parts):
            fields = range(p * SEGMENTS // parts, (p + 1) * SEGMENTS // parts)
            mine, near = _steps(pop, fields)
            own = F.col(f"w{w}").bitwiseAND(_signed(sum(3 << 2 * f for f in fields)))
            odd = F.bit_count(own) % 2 == 1  # the sum of the popcounts
            here = F.when(odd, F.array_compact(F.array(mine, *near))).otherwise(F.array(mine)) if steps else F.array(mine)
            cells.append(F.struct(here.alias("cells"), F.lit(w * parts + p).cast("long").alias("tag"), F.col(f"w{w or 1}").alias("other")))
    by_part = pops.select("root", F.col("w0").alias("fp"), F.explode(F.array(*cells)).alias("c"))
    return by_part.select(F.explode("c.cells").alias("cell"), F.col("c.tag").alias("tag"), "fp", F.col("c.other").alias("other"), "root")


_PAIR_SCHEMA = "kind byte, a long, b long, cell long, tag long, other long, root long"


def _links(batches: Iterator[pa.RecordBatch], max_bits: int, bound: int) -> Iterator[pa.RecordBatch]:
    """Links inside the groups of rows (cell, tag, fp, and perhaps other, root) sorted by group: kind 0, a spanning forest of each chunk.

    All pairs of a group are compared (blocks of numpy) by the bits of fp and other; links are between roots (fp where there is none), and of
    links that join what is joined already none is returned. Members of a group above `bound` come back as kind 1 with b = block number.
    """

    def record(kind, a, b, cell=None, tag=None, other=None, root=None):
        n = len(a)
        none = np.zeros(n, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int8)), *(pa.array(np.asarray(c if c is not None else none, np.int64)) for c in (a, b, cell, tag, other, root))],
            names=["kind", "a", "b", "cell", "tag", "other", "root"],
        )

    def compare(fp, other, root, size, pos):
        values, index = np.unique(fp if root is None else root, return_inverse=True)
        parent = np.arange(len(values))
        bits, more = fp.view(np.uint64), other.view(np.uint64) if other is not None else None
        left = size - pos - 1  # members of the group that follow
        active = np.flatnonzero(left > 0)
        d, out_a, out_b = 1, [], []
        while len(active):
            differ = np.bitwise_count(bits[active] ^ bits[active + d])
            if more is not None:
                differ = differ + np.bitwise_count(more[active] ^ more[active + d])
            near = active[differ <= max_bits]
            if len(near):
                i, j = index[near], index[near + d]
                new = parent[i] != parent[j]
                if new.any():
                    for p, q in zip(i[new].tolist(), j[new].tolist()):
                        r, s = p, q
                        while parent[r] != r:
                            r = parent[r]
                        while parent[s] != s:
                            s = parent[s]
                        if r != s:
                            parent[max(r, s)] = min(r, s)
                            out_a.append(p), out_b.append(q)
                    while not np.array_equal(up := parent[parent], parent):
                        parent = up
            d += 1
            active = active[left[active] >= d]
        if out_a:
            return record(0, values[out_a], values[out_b])
        return None

    def groups(cell, tag):
        starts = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (tag[1:] != tag[:-1]))))
        sizes = np.diff(np.append(starts, len(cell)))
        return starts, sizes

    def done(cell, tag, fp, other, root):
        starts, sizes = groups(cell, tag)
        size = np.repeat(sizes, sizes)
        pos = np.arange(len(cell)) - np.repeat(starts, sizes)
        large = size > bound
        if large.any():
            cells, tags, fps, *more = cut((cell, tag, fp, other, root), large)
            yield record(1, fps, pos[large] // bound, cells, tags, *more)
        keep = (size > 1) & ~large
        if keep.any() and (r := compare(*cut((fp, other, root), keep), size[keep], pos[keep])) is not None:
            yield r

    held: list[tuple] = []
    n_held, open_key, open_at = 0, None, 0
    cut = lambda arrays, part: tuple(x[part] if x is not None else None for x in arrays)
    joined = lambda: tuple(np.concatenate(x) if x[0] is not None else None for x in zip(*held))
    for batch in batches:
        rows = tuple(batch.column(i).to_numpy() for i in range(batch.num_columns)) + (None,) * (5 - batch.num_columns)
        if open_key is not None:  # more of a large group that was cut off
            same = int(((rows[0] == open_key[0]) & (rows[1] == open_key[1])).sum())
            if same:
                cell, tag, fp, *more = cut(rows, slice(same))
                yield record(1, fp, (open_at + np.arange(same)) // bound, cell, tag, *more)
                open_at += same
                rows = cut(rows, slice(same, None))
            if len(rows[0]):
                open_key = None
        if not len(rows[0]):
            continue
        held.append(rows)
        n_held += len(rows[0])
        if n_held < _CHUNK:
            continue
        rows = joined()
        starts, sizes = groups(*rows[:2])
        last = starts[-1]
        if last:
            yield from done(*cut(rows, slice(last)))
        rows = cut(rows, slice(last, None))
        held, n_held = [rows], len(rows[0])
        if n_held > bound:
            cell, tag, fp, *more = rows
            yield record(1, fp, np.arange(n_held) // bound, cell, tag, *more)
            open_key, open_at, held, n_held = (cell[0], tag[0]), n_held, [], 0
    if n_held:
        yield from done(*joined())


def links(fps: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that differ in at most `max_bits` bits.

    Not all pairs: enough that what is connected through pairs is connected through links.
    """
    return _linked(_cells(fps, max_bits), max_bits, block)


def code_groups(nodes: DataFrame, words: int = 5, parts: int = 3, max_bits: int = 28, block: int = BLOCK) -> DataFrame:
    """(node, root) of the codes (fp, code: array of `words` longs, fp the first) that are connected with others; root is the smallest fp reachable.

    Connected are pairs that share a grid cell (see `_code_cells`) and differ in at most `max_bits` of the 128 bits compared
    there; all pairs that differ in at most 2 * words * parts - 1 bits in all share a cell. A first pass over own cells alone joins
    the bulk of a large group, so that the many cells of the second have few links left to tell.
    """
    first = connected_components(store(_linked(_code_cells(nodes.withColumn("root", F.col("fp")), words, parts, False), max_bits, block)))
    first = store(first)
    joined = store(nodes.join(first, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "code"))
    second = connected_components(store(_linked(_code_cells(joined, words, parts, True), max_bits, block))).select(F.col("node").alias("root"), F.col("root").alias("top"))
    out = joined.select("fp", "root").join(second, "root", "left").select(F.col("fp").alias("node"), F.coalesce("top", "root").alias("root"))
    out = store(out)
    several = out.groupBy(F.col("root").alias("of")).agg(F.count("*").alias("n")).where("n > 1")
    return out.join(several, F.col("root") == F.col("of")).select("node", "root")


def _linked(cells: DataFrame, max_bits: int, block: int) -> DataFrame:
    def small(batches):
        return _links(batches, max_bits, block)

    def blocks(batches):
        return _links(batches, max_bits, 1 << 62)

    more = [c for c in ("other", "root") if c in cells.columns]
    found = store(cells.repartition("cell", "tag").sortWithinPartitions("cell", "tag", "fp").mapInArrow(small, _PAIR_SCHEMA))
    edges = found.where("kind = 0").select("a", "b")
    large = found.where("kind = 1").select("cell", "tag", F.col("a").alias("fp"), F.col("b").alias("block"), *more)
    count = large.groupBy("cell", "tag").agg((F.max("block") + 1).alias("n"))
    # every pair of blocks of a large cell is a task's group of its own, of two blocks at most
    each = large.join(count, ["cell", "tag"]).withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).where("other_block != block or n = 1")
    pair = F.least("block", "other_block") * F.lit(1 << 24) + F.greatest("block", "other_block")
    paired = each.select("cell", (F.col("tag") + pair * 64).alias("tag"), "fp", *more)
    again = paired.repartition("cell", "tag").sortWithinPartitions("cell", "tag", "fp").mapInArrow(blocks, _PAIR_SCHEMA)
    return edges.unionByName(again.select("a", "b"))


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Near-duplicate groups of (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints at `max_bits` or fewer differing bits link; component_id is the smallest doc_id of all documents
    reachable. Equal fingerprints become one node before any comparison, so groups of copies cost nothing.

    A null, empty or blank text has fingerprint zero, linked like any other. A null doc_id takes part and never
    is a component_id unless its group has no other. Repeated rows come back each. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = store(fingerprints(docs.select("doc_id", "text"), shingle))
    nodes = store(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    members = connected_components(links(nodes.select("fp"), max_bits, block)).withColumnRenamed("node", "fp")
    members = store(members.join(nodes, "fp"))
    least = members.groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = members.join(least, "root").select("fp", "component_id")
    every = nodes.join(joined, "fp", "left").select("fp", F.coalesce("component_id", "rep").alias("component_id"))
    return rows.join(every, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
