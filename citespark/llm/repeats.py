"""Suffix-array dedup: bytes covered by a string of given length that also starts elsewhere are removed.

Content-defined anchors cut each text into regions of windows, so that equal windows lie in regions of equal anchor at
equal distance from it. Chunks of documents and buckets of anchors exchange packed rows (each anchor and region at
most once per chunk, so frequent passages are no hot keys):

1. regions whose whole content occurs twice are repeats throughout; anchors of one region have none;
2. the remaining regions that share an anchor go, with their bytes, to the anchor's bucket, where a suffix array over
   eight-byte symbols (grouping.suffix_array) finds the windows that occur twice;
3. each chunk removes what the repeated windows cover.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import forget, store
from citespark.llm.grouping import suffix_array

#: Bytes hashed for an anchor (a power of two), and bytes of the symbols that suffixes are sorted by.
ANCHOR, SYMBOL = 64, 8
CHUNK_BYTES, BUCKET_BYTES, PIECE = 8 << 20, 12 << 20, 1 << 20
#: Symbols of one suffix array. An anchor of more regions than HOT is split further, by what lies around it.
BLOCK, HOT = 100_000, 20_000
_ROW = "kind string, chunk long, bucket int, blob binary"
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64((1 << 24) - 1)


def _pack(*arrays) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes) -> tuple:
    return pickle.loads(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True))


def _rows(kind: str, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(kind, *r) for r in rows], columns=["kind", "chunk", "bucket", "blob"])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ANCHOR bytes from each place on, by doubling."""
    with np.errstate(over="ignore"):
        h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        n, multiplier = 1, _MULTIPLIER
        while n < ANCHOR:
            h = h[:-n] * multiplier + h[n:]
            multiplier = np.uint64(int(multiplier) ** 2 & 0xFFFFFFFFFFFFFFFF)
            n *= 2
        h ^= h >> np.uint64(32)
        h *= _MULTIPLIER
        h ^= h >> np.uint64(32)
    return h


def _owners(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` hashes the place of its least one, the first of equals."""
    n = len(h) - width + 1
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    rows = np.concatenate((key, np.full(-len(key) % width, np.uint64(0xFFFFFFFFFFFFFFFF)))).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & _LOW).astype(np.int64)


def regions_of(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: anchor hash, place of the anchor, first window and the one after the last."""
    out = []
    for s in range(0, max(len(data) - length + 1, 0), PIECE):
        piece = np.frombuffer(data, np.uint8)[s : s + PIECE + length - 1]
        h = _gram_hashes(piece)
        own = _owners(h, length - ANCHOR + 1)
        first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        out.append((h[own[first]], own[first] + s, first + s, np.append(first[1:], len(own)) + s))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


def _chunks(frames: Iterator[pd.DataFrame], length: int, buckets: int, chunk_bytes: int) -> Iterator[pd.DataFrame]:
    part = TaskContext.get().partitionId() << 24
    number, held, size = 0, [], 0

    def flush():
        ids = np.array([int(i) if i is not None else 0 for i, _ in held], np.int64)
        none = np.array([i is None for i, _ in held])
        lens = np.array([len(d) for _, d in held], np.int64)
        anchor, place, last, content, number_of = [], [], [], [], []
        for _, d in held:
            h, p, i, j = regions_of(d, length)
            digest = xxhash.xxh64_intdigest
            content.append(np.array([digest(d[x : y + length - 1], z) for x, y, z in zip(i.tolist(), j.tolist(), (p - i).tolist())], np.uint64))
            anchor.append(h), place.append(p - i), last.append(j - i), number_of.append(len(h))
        anchor, place, last, content = (np.concatenate(x) for x in (anchor, place, last, content))
        bucket = (anchor % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((content, anchor, bucket))
        a, c, b = anchor[order], content[order], bucket[order]
        new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])))) if len(a) else np.zeros(0, np.int64)
        count = np.diff(np.append(new, len(a))).astype(np.uint32)
        which = np.empty(len(a), np.uint32)
        which[order] = np.repeat(np.arange(len(new)), count)
        chunk = part + number
        rows = [(chunk, -1, _pack(ids, none, lens, b"".join(d for _, d in held), np.array(number_of), place.astype(np.uint16), last.astype(np.uint16), which))]
        a, c, b = a[new], c[new], b[new]
        ends = np.searchsorted(b, np.arange(buckets + 1))
        rows += [(chunk, k, _pack(a[i:j], c[i:j], count[i:j])) for k, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j]
        return _rows("chunk", rows)

    for frame in frames:
        for doc_id, text in zip(frame.doc_id, frame.text):
            data = (text or "").encode()
            held.append((doc_id, data))
            size += len(data)
            if size >= chunk_bytes:
                yield flush()
                number, held, size = number + 1, [], 0
    if held:
        yield flush()


#: What a chunk is told of one of its regions.
_REPEATED, _SHARED, _SHOWN, _HOT = 1, 2, 4, 8


def _match(hot: int):
    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        blobs = [_unpack(b) for b in frame.blob]
        anchor, content, count = (np.concatenate([b[k] for b in blobs]) for k in range(3))
        order = np.lexsort((content, anchor))
        a, c = anchor[order], content[order]
        new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (c[1:] != c[:-1]))))
        total = np.add.reduceat(count[order].astype(np.int64), new)
        group = np.flatnonzero(np.concatenate(([True], a[new][1:] != a[new][:-1])))
        kinds = np.diff(np.append(group, len(new)))
        alone = np.repeat(np.add.reduceat((total == 1).astype(np.int64), group), kinds)
        kinds = np.repeat(kinds, kinds)
        state = np.where(total > 1, _REPEATED, 0) | np.where((total == 1) & (kinds > 1), _SHARED, 0) | np.where((kinds > 1) & (alone > 0) & (kinds > hot), _HOT, 0)
        state = np.repeat(state, np.diff(np.append(new, len(a))))
        state[new[(total > 1) & (kinds > 1) & (alone > 0)]] |= _SHOWN  # one chunk shows a repeated region to those that differ
        told = np.empty(len(a), np.uint8)
        told[order] = state
        ends = np.cumsum([0] + [len(b[0]) for b in blobs])
        return _rows("state", [(k, b, _pack(told[i:j])) for k, b, i, j in zip(frame.chunk, frame.bucket, ends[:-1], ends[1:])])

    return of


def _aligned(rows: pd.DataFrame) -> np.ndarray | None:
    parts = [_unpack(b)[0] for b in rows.sort_values("bucket").blob]
    return np.concatenate(parts) if parts else None


class _Chunk:
    """A chunk with the state of its regions, and the items that it shows to buckets."""

    def __init__(self, frame: pd.DataFrame, length: int, buckets: int):
        own = frame[frame.kind == "chunk"].sort_values("bucket")
        self.chunk = int(own.chunk.iloc[0])
        self.ids, self.none, self.lens, self.data, number, offset, windows, which = _unpack(own.blob.iloc[0])
        # the regions of a text follow each other from its start on
        windows, self.which = windows.astype(np.int64), which.astype(np.int64)
        begun = np.cumsum(windows) - windows
        head = np.cumsum(number) - number
        full = number > 0
        shift = (np.cumsum(self.lens) - self.lens)[full] - begun[head[full]]
        self.first = begun + np.repeat(shift, number[full])
        self.last, self.place = self.first + windows, self.first + offset
        state = _aligned(frame[frame.kind == "state"])
        self.state = state if state is not None else np.zeros(0, np.uint8)
        anchors = np.concatenate([_unpack(b)[0] for b in own.blob.iloc[1:]]) if len(own) > 1 else np.zeros(0, np.uint64)
        # of equal regions within the chunk, the first speaks for all
        _, head = np.unique(self.which, return_index=True)
        asked = head[(self.state[self.which[head]] & (_SHARED | _SHOWN)) > 0] if len(head) else head
        hot = (self.state[self.which[asked]] & _HOT) > 0
        plain, split = asked[~hot], asked[hot]
        place, low, high = self.place, self.place - self.last + 1, self.place - self.first
        items = [(anchors[self.which[plain]], plain, low[plain], high[plain])]
        keys, who, lows, highs = [], [], [], []
        for r in split.tolist():  # eight neighbouring windows share all but seven bytes: they meet by these
            p, h = int(place[r]), int(anchors[self.which[r]])
            for u in range(int(low[r]) // SYMBOL, int(high[r]) // SYMBOL + 1):
                inner = self.data[p - SYMBOL * u : p + length - SYMBOL * u - SYMBOL + 1]
                keys.append(xxhash.xxh64_intdigest(inner, h + u & 0xFFFFFFFFFFFFFFFF)), who.append(r)
                lows.append(max(int(low[r]), SYMBOL * u)), highs.append(min(int(high[r]), SYMBOL * u + SYMBOL - 1))
        if keys:
            items.append((np.array(keys, np.uint64), *(np.array(x, np.int64) for x in (who, lows, highs))))
        key, self.region, self.low, self.high = (np.concatenate(x) for x in zip(*items))
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((key, bucket))
        self.key, self.region, self.low, self.high, self.bucket = (x[order] for x in (key, self.region, self.low, self.high, bucket))


def _show(length: int, buckets: int):
    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        c = _Chunk(frame, length, buckets)
        rows = []
        ends = np.searchsorted(c.bucket, np.arange(buckets + 1))
        for b, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
            if i < j:
                p = c.place[c.region[i:j]]
                text = [c.data[x - hi : x + length - lo] for x, lo, hi in zip(p.tolist(), c.low[i:j].tolist(), c.high[i:j].tolist())]
                rows.append((c.chunk, b, _pack(c.key[i:j], c.low[i:j].astype(np.uint16), c.high[i:j].astype(np.uint16), b"".join(text))))
        return _rows("item", rows)

    return of


def repeated_windows(key: np.ndarray, low: np.ndarray, high: np.ndarray, data: bytes, length: int, block: int = BLOCK) -> np.ndarray:
    """Which windows occur in another item: a row for each item, a column for each distance of window start to anchor.

    Item k holds the bytes from `high[k]` before its anchor to length - low[k] after it, that is, the windows that start low[k] .. high[k]
    before the anchor. Items of one key share their anchor; each belongs to another place of the corpus.
    """
    most = length - ANCHOR + 1
    out = np.zeros((len(key), most), bool)
    size = high - low + length
    at = np.concatenate(([0], np.cumsum(size)[:-1]))
    order = np.argsort(key, kind="stable")
    k = key[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    counts = np.diff(np.append(first, len(k)))
    before, after = -(-high // SYMBOL), -(-(length - low) // SYMBOL)
    symbols = (before + after + 1)[order]
    weight = np.add.reduceat(symbols, first) if len(first) else np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)

    def settle(items: np.ndarray):
        """One suffix array over whole groups of items."""
        b, a = before[items], after[items]
        start = np.concatenate(([0], np.cumsum(b + a + 1)[:-1]))  # in symbols, one separator after each item
        total = int((b + a + 1).sum())
        text = np.zeros(total * SYMBOL, np.uint8)
        n = size[items]
        to = np.repeat((start + b) * SYMBOL - high[items], n) + (np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n))
        text[to] = raw[np.repeat(at[items], n) + (np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n))]
        word = text.view(">u8").astype(np.uint64)
        _, code = np.unique(word, return_inverse=True)
        code = code + 1
        code[start + b + a] = 0
        rank = np.empty(total, np.int64)
        rank[np.array(suffix_array(code.tolist()), np.int64)] = np.arange(total)
        padded = np.concatenate((word, np.zeros(length // SYMBOL + 2, np.uint64)))
        anchor = start + b
        for u in range(int(low[items].min()) // SYMBOL, int(high[items].max()) // SYMBOL + 1):
            have = np.flatnonzero((low[items] <= SYMBOL * u + SYMBOL - 1) & (high[items] >= SYMBOL * u))
            if len(have) < 2:
                continue
            have = have[np.argsort(rank[anchor[have] - u])]
            s = anchor[have] - u
            # bytes that neighbours in suffix order have in common, as far as windows go
            common, going = np.zeros(len(s) - 1, np.int64), np.arange(len(s) - 1)
            for step in range(-(-length // SYMBOL)):
                x = padded[s[going] + step] ^ padded[s[going + 1] + step]
                equal = x == 0
                rest = x[~equal]
                common[going[~equal]] = SYMBOL * step + sum((rest < np.uint64(1 << (64 - 8 * t))).astype(np.int64) for t in range(1, SYMBOL))
                going = going[equal]
                if not len(going):
                    break
            common[going] = length
            group = key[items[have]]
            common[group[1:] != group[:-1]] = 0
            left = np.where(s > 0, padded[np.maximum(s - 1, 0)], 0)
            for v in range(SYMBOL):
                d = SYMBOL * u + v
                run = np.concatenate(([0], np.cumsum(common < length - v)))
                mine = np.flatnonzero((low[items[have]] <= d) & (high[items[have]] >= d))
                if len(mine) < 2:
                    continue
                tail = left[mine] & np.uint64((1 << 8 * v) - 1)
                o = np.lexsort((tail, run[mine]))
                r, t = run[mine][o], tail[o]
                same = (r[1:] == r[:-1]) & (t[1:] == t[:-1])
                twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
                out[items[have[mine[o[twice]]]], d] = True

    held, load = [], 0
    for f, n, w in zip(first.tolist(), counts.tolist(), weight.tolist()):
        if n < 2:
            continue
        held.append(order[f : f + n])
        load += w
        if load >= block:
            settle(np.concatenate(held))
            held, load = [], 0
    if held:
        settle(np.concatenate(held))
    return out


def _sort(length: int, block: int):
    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        blobs = [_unpack(b) for b in frame.blob]
        key, low, high = (np.concatenate([b[k] for b in blobs]) for k in range(3))
        found = np.packbits(repeated_windows(key, low.astype(np.int64), high.astype(np.int64), b"".join(b[3] for b in blobs), length, block), axis=1)
        ends = np.cumsum([0] + [len(b[0]) for b in blobs])
        return _rows("found", [(k, b, _pack(found[i:j])) for k, b, i, j in zip(frame.chunk, frame.bucket, ends[:-1], ends[1:])])

    return of


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(length: int, buckets: int):
    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        c = _Chunk(frame, length, buckets)
        edge = np.zeros(len(c.data) + 1, np.int32)
        whole = (c.state[c.which] & _REPEATED) > 0 if len(c.which) else np.zeros(0, bool)
        np.add.at(edge, c.first[whole], 1)
        np.add.at(edge, c.last[whole] - 1 + length, -1)
        found = _aligned(frame[frame.kind == "found"])
        if found is not None:
            item, distance = np.nonzero(np.unpackbits(found, axis=1))
            window = c.place[c.region[item]] - distance
            np.add.at(edge, window, 1)
            np.add.at(edge, window + length, -1)
        gone = np.cumsum(edge[:-1]) > 0
        ends = np.cumsum(c.lens)
        starts = ends - c.lens
        total = np.concatenate(([0], np.cumsum(gone)))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = starts[(starts < len(gone)) & (c.lens > 0)]
        begins[inner] = gone[inner]
        spans = np.concatenate(([0], np.cumsum(begins)))
        raw = np.frombuffer(c.data, np.uint8)
        kept = [hashlib.sha256(raw[i:j][~gone[i:j]].tobytes() if total[j] > total[i] else c.data[i:j]).hexdigest() for i, j in zip(starts.tolist(), ends.tolist())]
        return pd.DataFrame({
            "doc_id": pd.array([None if x else i for i, x in zip(c.ids.tolist(), c.none)], dtype="Int64"), "n_bytes": c.lens,
            "n_removed": total[ends] - total[starts], "n_spans": spans[ends] - spans[starts], "kept_sha256": kept,
        })

    return of


def remove_repeats(docs: DataFrame, length: int = 200, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """Drop from every whole text of (doc_id, text), as UTF-8, each byte that a repeated string of `length` bytes covers.

    Result: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256. A string is repeated if it also starts anywhere
    else in the corpus, same text included, overlapping or not; matches never cross texts; all is judged on the input.

    A null text is empty; texts under `length` bytes lose nothing. Repeated rows repeat each other's strings, so both lose them. A null
    doc_id stays null. An empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(8192, max(4, -(-size // bucket_bytes)))
    table = store(rows.mapInPandas(lambda frames: _chunks(frames, length, buckets, chunk_bytes), _ROW))
    told = store(table.where("bucket >= 0").groupBy("bucket").applyInPandas(_match(hot), _ROW))

    def every() -> DataFrame:
        return table.unionByName(told)

    shown = every().groupBy("chunk").applyInPandas(_show(length, buckets), _ROW)
    found = store(shown.groupBy("bucket").applyInPandas(_sort(length, block), _ROW))
    del shown
    out = store(every().unionByName(found).groupBy("chunk").applyInPandas(_remove(length, buckets), _RESULT))
    for x in (table, told, found):
        forget(x)
    return out
