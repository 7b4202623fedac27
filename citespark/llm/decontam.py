"""Benchmark decontamination: q-gram lemma over diagonal bands, then banded alignment."""

from __future__ import annotations

import re
import sys

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import forget, packed, store, unpacked

Q = 8
#: A leak is a window of so many normalised bytes of an item (the whole item, if shorter) with at most one edit per TEN of them.
WINDOW, STRIDE, TEN = 100, 50, 10
#: Diagonals step from band to band; a band is twice as wide, so any BAND + 1 neighbouring diagonals lie in one.
BAND = WINDOW // TEN
#: Bytes of text scanned at once, shared q-grams looked at at once, and benchmark characters indexed at once (more go in further passes).
CHUNK, HITS, INDEX_CHARS = 1 << 21, 1 << 21, 4_000_000
#: Bytes that neighbouring parts of a long text share: more than any window within its budget covers.
OVERLAP = 2 * WINDOW + 4 * BAND + Q
_GAP = b"\0" * 64
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SLOTS, _BUCKETS = 22, 20

#: ASCII letters in lower case, digits and other bytes as they are, all else a blank.
_TABLE = bytes(c if c >= 0x80 or c == 0 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256))


#: Lower case of single code points, where it has as many bytes; the others stay as they are.
_FOLD = {i: low for i in range(128, sys.maxunicode + 1) if (low := chr(i).lower()) != chr(i) and len(low.encode()) == len(chr(i).encode())} | {i: chr(i).lower() for i in range(65, 91)}
#: Those that whole strings fold otherwise: by neighbours, or to another length.
_ODD = re.compile("[" + "".join(map(re.escape, ["Σ", *(chr(i) for i in range(128, sys.maxunicode + 1) if i not in _FOLD and not 0xD800 <= i < 0xE000 and chr(i).lower() != chr(i))])) + "]")


def _bytes(text: str) -> bytes:
    """UTF-8 of the text, lower case code point by code point where that keeps the length; ASCII punctuation and controls become blanks."""
    own = text.encode()
    if own.isascii():
        low = own.lower()
    else:
        low = (text.translate(_FOLD) if _ODD.search(text) else text.lower()).encode()
    return low.replace(b"\0", b" ").translate(_TABLE)


def _collapse(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of blanks become one; returns the bytes kept and where they were."""
    blank = joined == 32
    keep = np.ones(len(joined), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return joined[keep], np.flatnonzero(keep)


def _keys(data: np.ndarray) -> np.ndarray:
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for o in range(min(Q, n)):
        whole = (len(data) - o) // Q
        out[o::Q] = data[o : o + whole * Q].view(np.uint64)[: len(out[o::Q])]
    return out


class Index:
    """q-grams of segments of benchmark items; a segment holds the windows at STRIDE offsets, so all offsets are covered. Items of under Q normalised bytes have no q-gram and match nothing."""

    def __init__(self, items: list[tuple[int, str]]):
        texts, owner, sizes, post_key, post_win, post_at = [], [], [], [], [], []
        for item, text in items:
            data = _collapse(np.frombuffer(_bytes(text).strip(), np.uint8))[0]
            n = len(data)
            if n < Q:
                continue
            for s in range(0, max(n - WINDOW, 0) + 1, STRIDE):
                window = data[s : s + WINDOW + STRIDE - 1]
                keys = _keys(window)
                post_key.append(keys)
                post_win.append(np.full(len(keys), len(texts)))
                post_at.append(np.arange(len(keys)))
                texts.append(window)
                owner.append(item)
                sizes.append(min(n, WINDOW))
        self.texts, self.owner = texts, owner
        self.size = size = np.array(sizes, np.int64)
        # the budget leaves at least one q-gram that must be shared
        self.edits = np.minimum(size // TEN, np.maximum(size - Q, 0) // Q)
        self.need = size - Q + 1 - self.edits * Q
        keys = np.concatenate(post_key) if post_key else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.ends = np.append(first, len(keys)).astype(np.int64)
        self.win = (np.concatenate(post_win)[order] if post_win else np.zeros(0)).astype(np.int32)
        self.at = (np.concatenate(post_at)[order] if post_at else np.zeros(0)).astype(np.int32)
        # a hash table of one key per slot; the few keys that share a slot are searched for
        self.slots = np.full(1 << _SLOTS, -1, np.int32)
        self.slots[(self.keys * _MIX) >> np.uint64(64 - _SLOTS)] = np.arange(len(self.keys))

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of keys that are indexed, and their numbers."""
        j = self.slots[(keys * _MIX) >> np.uint64(64 - _SLOTS)]
        hits = np.flatnonzero(j >= 0)
        j = j[hits]
        other = np.flatnonzero(self.keys[j] != keys[hits])
        j[other] = np.minimum(np.searchsorted(self.keys, keys[hits[other]]), len(self.keys) - 1)
        real = np.ones(len(hits), bool)
        real[other] = self.keys[j[other]] == keys[hits[other]]
        return hits[real], j[real]


def _distances(data: np.ndarray, patterns: np.ndarray, low: np.ndarray, width: int, fixed: bool = False) -> np.ndarray:
    """Edit distances in the last row of banded alignments: patterns[n, m] against data from the diagonals low .. low + width.

    Text before and after is free, unless `fixed`: then the text begins at diagonal 0 of `low`.
    """
    n, m = patterns.shape
    at = low[:, None] + np.arange(m + width - 1)
    text = np.ascontiguousarray(np.where((at >= 0) & (at < len(data)), data[np.clip(at, 0, len(data) - 1)], 0).T)
    pattern = np.ascontiguousarray(patterns.T)
    step = np.arange(width, dtype=np.int16)[:, None]
    rows = np.zeros((width, n), np.int16) if not fixed else np.repeat(step, n, axis=1)
    for i in range(m):
        best = rows + (text[i : i + width] != pattern[i])
        np.minimum(best[:-1], rows[1:] + 1, out=best[:-1])
        best -= step
        np.minimum.accumulate(best, axis=0, out=best)
        best += step
        rows = best
    return rows.T


def _scan(data: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """(window, first byte, end, edits) of the regions of collapsed bytes that hold a window within its budget."""
    hits, j = index.lookup(_keys(data))
    n = index.ends[j + 1] - index.ends[j]
    total = int(n.sum())
    if total > HITS and len(data) > 4 * OVERLAP:  # q-grams of many windows: half the text at a time
        half = len(data) // 2
        right = _scan(data[half:], index)
        return _scan(data[: half + OVERLAP], index) + [(w, a + half, e + half, x) for w, a, e, x in right]
    if not total:
        return []
    which = np.repeat(index.ends[j] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(total)
    win, place = index.win[which], index.at[which]
    diagonal = np.repeat(hits.astype(np.int32), n) - place
    band = (diagonal + np.int32(4 * WINDOW)) // np.int32(BAND)
    # hits by window and narrow band, hashed; two neighbours make a band, and each diagonal lies in two of these
    slot = (win * np.int32(40_503) + band) & np.int32((1 << _BUCKETS) - 1)
    count = np.bincount(slot, minlength=1 << _BUCKETS)
    both = count + np.roll(count, -1)
    dense = np.flatnonzero(np.maximum(both, np.roll(both, 1))[slot] >= index.need[win])
    if not len(dense):
        return []
    win, band, place, diagonal = (x[dense].astype(np.int64) for x in (win, band, place, diagonal))
    found = []
    for shift in (0, 1):
        k, c = np.unique((win << 32) + band - shift, return_counts=True)
        found.append(k[c >= index.need[k >> 32]])
    every = np.unique(np.concatenate(found))
    if not len(every):
        return []
    # the hits of each candidate, side by side
    of, spot, line = [], [], []
    for shift in (0, 1):
        key = (win << 32) + band - shift
        c = np.minimum(np.searchsorted(every, key), len(every) - 1)
        mine = np.flatnonzero(every[c] == key)
        of.append(c[mine]), spot.append(place[mine]), line.append(diagonal[mine])
    of, spot, line = (np.concatenate(x) for x in (of, spot, line))
    order = np.argsort(of, kind="stable")
    of, spot, line = of[order], spot[order], line[order]
    out = []
    for at in range(0, len(every), 2048):
        some = slice(*np.searchsorted(of, (at, at + 2048)))
        out += _verify(data, index, every[at : at + 2048], of[some] - at, spot[some], line[some])
    return out


def _verify(data: np.ndarray, index: Index, cand: np.ndarray, of: np.ndarray, place: np.ndarray, diagonal: np.ndarray) -> list[tuple[int, int, int, int]]:
    """The windows, at every offset, of candidate segments and bands (sorted keys) that are within their budget: as _scan.

    Hit k of candidate of[k] is the segment's q-gram at place[k], found on diagonal[k].
    """
    seg, low = cand >> 32, (cand & 0xFFFFFFFF) * BAND - 4 * WINDOW
    span = WINDOW + STRIDE
    shared = np.bincount(of * span + place, minlength=len(cand) * span).reshape(-1, span)
    diagonals = np.bincount(of * 2 * BAND + diagonal - low[of], minlength=len(cand) * 2 * BAND).reshape(-1, 2 * BAND)
    upto = np.concatenate((np.zeros((len(cand), 1), np.int64), np.cumsum(shared, 1)), 1)
    # the next place from each on whose q-gram is not shared
    lost = np.full((len(cand), span + Q + 1), 4 * span, np.int64)
    lost[:, :span] = np.where(shared == 0, np.arange(span), 4 * span)
    lost = np.minimum.accumulate(lost[:, ::-1], axis=1)[:, ::-1]
    lengths = index.size[seg]
    top = low + diagonals.argmax(1)
    out = []
    for m in np.unique(lengths):
        own = np.flatnonzero(lengths == m)
        # windows by offset that share as many q-grams as theirs must
        offsets = np.arange(STRIDE if m == WINDOW else 1)
        grams = upto[own][:, offsets + int(m) - Q + 1] - upto[own][:, offsets]
        inside = offsets + m <= np.array([len(index.texts[w]) for w in seg[own]])[:, None]
        row, offset = np.nonzero((grams >= index.need[seg[own], None]) & inside)
        # every q-gram that is not shared holds an edit: so many edits, Q bytes apart, are needed at least
        need, last = np.zeros(len(row), np.int64), offset + int(m) - Q
        at = lost[own[row], offset]
        for _ in range(int(m) // TEN + 1):
            going = at <= last
            need += going
            at = np.where(going, lost[own[row], np.minimum(at + Q, span + Q)], at)
        few = need <= index.edits[seg[own[row]]]
        row, offset = row[few], offset[few]
        these = own[row]
        # unchanged copies on the densest diagonal need no alignment
        for at in range(0, len(these), 2048):
            part, o = these[at : at + 2048], offset[at : at + 2048]
            if not len(part):
                continue
            patterns = np.stack([index.texts[w][x : x + m] for w, x in zip(seg[part], o)])
            first = top[part] + o
            where = first[:, None] + np.arange(int(m))
            same = (first >= 0) & (first + m <= len(data))
            same &= (data[np.clip(where, 0, len(data) - 1)] == patterns).all(1)
            out += [(int(w), int(f), int(f + m), 0) for w, f in zip(seg[part][same], first[same])]
            rest = ~same
            if not rest.any():
                continue
            part, start, patterns = part[rest], low[part[rest]] + o[rest], patterns[rest]
            w, budget = seg[part], index.edits[seg[part]]
            most = int(m) // TEN
            width = 2 * BAND + 2 * most + 1
            rows = _distances(data, patterns, start - most, width)
            best = rows.argmin(1)
            edits = rows[np.arange(len(part)), best]
            ok = np.flatnonzero(edits <= budget)
            if not len(ok):
                continue
            end = start[ok] - most + best[ok] + int(m)
            # backwards from each end, for where the region begins
            flipped = data[::-1]
            back = _distances(flipped, patterns[ok][:, ::-1], len(data) - end, 2 * most + 1, fixed=True)
            # diagonal k of the flipped alignment has consumed m + k bytes
            short = [_start(flipped, patterns[i][::-1], len(data) - e, int(x)) for i, e, x in zip(ok, end, edits[ok])] if (back.min(1) > edits[ok]).any() else None
            consumed = np.array(short) if short else int(m) + back.argmin(1)
            out += [(int(a), int(e - c), int(e), int(x)) for a, e, c, x in zip(w[ok], end, consumed, edits[ok])]
    return out


def _start(flipped: np.ndarray, pattern: np.ndarray, at: int, edits: int) -> int:
    """Bytes that the best alignment of the whole pattern consumes from `at` on: plain, for the few matches with deletions."""
    text = flipped[at : at + len(pattern) + edits]
    row = np.arange(len(text) + 1)
    step = np.arange(len(text) + 1)
    for i, c in enumerate(pattern):
        best = np.empty_like(row)
        best[0] = i + 1
        best[1:] = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        row = np.minimum.accumulate(best - step) + step
    return int(row.argmin())


def find_in(texts: list[str | None], index: Index) -> list[list[tuple[int, int, int, int]]]:
    """For each text its matches (item, start, end, edits), one per item: first to last code point covered, fewest edits."""
    out: list[dict] = [{} for _ in texts]

    def flush(parts: list[tuple[int, int, bytes]]):
        joined = np.frombuffer(_GAP.join([b"", *(p[2] for p in parts), b""]), np.uint8)
        starts = np.cumsum([len(_GAP)] + [len(p[2]) + len(_GAP) for p in parts[:-1]])
        data, where = _collapse(joined)
        for window, first, end, edits in _scan(data, index):
            middle = where[(first + end) // 2]
            k = int(np.searchsorted(starts, middle, "right")) - 1
            number, base, own = parts[k]
            a = max(0, int(where[max(first, 0)]) - int(starts[k]))
            b = min(len(own), int(where[min(end, len(where)) - 1]) + 1 - int(starts[k]))
            item = index.owner[window]
            old = out[number].get(item, (base + a, base + b, edits))
            out[number][item] = (min(old[0], base + a), max(old[1], base + b), min(old[2], edits))

    parts, size = [], 0
    for number, text in enumerate(texts):
        data = _bytes(text) if text else b""
        for at in range(0, max(len(data) - OVERLAP, 1), CHUNK):
            piece = data[at : at + CHUNK + OVERLAP]
            if not piece:
                continue
            parts.append((number, at, piece))
            size += len(piece)
            if size >= CHUNK:
                flush(parts)
                parts, size = [], 0
    if parts:
        flush(parts)
    result = []
    for text, found in zip(texts, out):
        rows = []
        if found:
            lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
            upto = np.concatenate(([0], np.cumsum(lead)))
            rows = sorted((item, int(upto[a]), int(upto[b]), x) for item, (a, b, x) in found.items())
        result.append(rows)
    return result


def _indexes(benchmark: DataFrame, limit: int):
    """Indexes of at most about `limit` characters each; the driver holds one block of items at a time."""
    rows = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // limit))
    for b in range(blocks):
        yield blocks, Index([(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()])


_LEAKS = "array<struct<item_id:long,start:int,end:int,edits:int>>"


def _with_leaks(rows: DataFrame, benchmark: DataFrame, limit: int) -> DataFrame:
    """(row, leaks) of (row, text): one match for each item found. One index at a time is alive; of several, each adds its matches in a pass."""
    spark = rows.sparkSession

    def finder(shared):
        @F.pandas_udf(_LEAKS)
        def of(texts: pd.Series) -> pd.Series:
            names = ("item_id", "start", "end", "edits")
            return pd.Series([[dict(zip(names, m)) for m in row] for row in find_in(list(texts), shared.value)])

        return of("text")

    now = rows.withColumn("leaks", F.array().cast(_LEAKS))
    for blocks, index in _indexes(benchmark, limit):
        shared = spark.sparkContext.broadcast(index)  # of `limit` characters at most
        if blocks == 1:
            return rows.select("row", finder(shared).alias("leaks"))
        before = now
        now = store(now.select("row", "text", F.concat("leaks", finder(shared)).alias("leaks")))
        forget(before)
        shared.destroy()
    # an item's texts may lie in several indexes
    own = lambda i, f: F.transform(F.filter("leaks", lambda x: x["item_id"] == i), lambda x: x[f])
    merged = F.transform(
        F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x["item_id"]))),
        lambda i: F.struct(i.alias("item_id"), F.array_min(own(i, "start")).alias("start"), F.array_max(own(i, "end")).alias("end"), F.array_min(own(i, "edits")).alias("edits")),
    )
    return now.select("row", merged.alias("leaks"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, limit: int = INDEX_CHARS) -> DataFrame:
    """Documents of (doc_id, text) that hold passages of benchmark (item_id, text): doc_id, item_id, start, end, edits.

    A row for each document and item of which a window of WINDOW normalised bytes (the whole item, if shorter) occurs
    with at most one edit per TEN bytes. Normalised: lower case (code points whose lower case has another number of bytes stay),
    ASCII punctuation and blanks as one blank. By the q-gram lemma such a region shares at least window - Q + 1 - edits * Q
    q-grams within neighbouring diagonals, so counting over overlapping diagonal bands loses none; banded alignment then
    decides. start and end (exclusive) are code points of the text, from the first to the last window found; edits is the fewest
    of a window. The result is the same whatever `limit`, the characters indexed at once.

    Null and empty texts and null items match nothing, nor do items of under Q normalised bytes. Repeated items count once,
    several texts of one item_id are one item, repeated documents come back each. Empty tables give an empty result; other columns are ignored.
    """
    rows = _with_leaks(docs.select(F.struct("doc_id").alias("row"), "text"), benchmark, limit)
    return rows.select("row.doc_id", F.explode("leaks").alias("m")).select("doc_id", "m.item_id", "m.start", "m.end", "m.edits")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, limit: int = INDEX_CHARS) -> DataFrame:
    """`docs` without the rows in which `find_leaks` finds something; all columns are kept, whatever their names."""
    clean = _with_leaks(packed(docs, text=F.col("text")), benchmark, limit).where(F.size("leaks") == 0)
    return unpacked(clean, docs.columns)
