"""Word shingles of many texts at once: 64-bit hashes and SimHash codes, all in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

#: Texts are read in parts of about so many bytes, cut at blanks; so many shingles are counted at once.
PART, SLICE = 1 << 20, 1 << 16
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, *range(9, 14)]] = True
_LETTER = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_LETTER[65:91] = _LETTER[97:123]  # A-Z as a-z
_TABLES: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64 and of its inverse, at least n of each."""
    if len(_TABLES.get("up", ())) < n:
        size = max(n, 4 * PART)
        _TABLES["up"], _TABLES["down"] = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)
    return _TABLES["up"], _TABLES["down"]


def _parts(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > PART:
            cut = _BLANK.search(data, at + PART)
            end = cut.start() if cut else end
        yield data[at:end]
        at = end


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word: a polynomial in its bytes, from prefix sums over the whole part."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _IS_BLANK[raw], [True])).view(np.int8)))
    first, last = edge[::2], edge[1::2]
    up, down = _tables(len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTER[raw] * up[: len(raw)], dtype=np.uint64)))
    return _mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)), first


def shingle_hashes(texts: list[str | None], n: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of n words, A-Z in lower case.

    A text of fewer words has one shingle, all its words; one of none (or null) has that of no word.
    """
    out: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(texts)
    held: list[tuple[int, bytes]] = []
    size = 0

    def emit(number: int, words: np.ndarray):
        total = np.zeros(max(len(words) - n + 1, 1), np.uint64)
        for j in range(min(n, len(words))):
            total = (total + words[j : j + len(total)]) * np.uint64(0xD6E8FEB86659FD93)
        out[number] = np.unique(_mix(total))

    def flush():
        starts = np.cumsum([0] + [len(d) + 1 for _, d in held])
        words, first = _words(b" ".join(d for _, d in held))
        cut = np.searchsorted(first, starts)
        for (number, _), i, j in zip(held, cut[:-1].tolist(), cut[1:].tolist()):
            emit(number, words[i:j])

    for number, text in enumerate(texts):
        data = (text or "").encode()
        if len(data) > PART:
            emit(number, np.concatenate([_words(p)[0] for p in _parts(data)]))
            continue
        held.append((number, data))
        size += len(data) + 1
        if size >= PART:
            flush()
            held, size = [], 0
    if held:
        flush()
    return out


#: The bits of a byte as the bytes of a 64-bit number, so that one addition counts eight bits.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(-1).view(np.uint64)


def codes(sets: list[np.ndarray], words: int) -> np.ndarray:
    """SimHash codes of 64 * words bits, a row of uint64 for each set of shingle hashes.

    A bit is set if it is in over half of the derived hashes; where it is in exactly half, a fixed pattern decides, so that
    short texts do not crowd at few codes.
    """
    tie = np.unpackbits(_mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(_ODD)).view(np.uint8), bitorder="little").astype(np.int64)
    lens = np.array([len(s) for s in sets], np.int64)
    counts = np.zeros((len(sets), 64 * words), np.int64)
    # runs of at most 255 hashes, so that no count overflows its byte
    owner, begin = [], []
    at = 0
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    for k, m in enumerate(lens.tolist()):
        begin += range(at, at + m, 255)
        owner += [k] * -(-m // 255)
        at += m
    begin_at, of = np.array([*begin, at], np.int64), np.array(owner, np.int64)
    i = 0
    while i < len(of):
        j = max(i + 1, int(np.searchsorted(begin_at, begin_at[i] + SLICE, "right")) - 1)
        part = flat[begin_at[i] : begin_at[j]]
        runs = begin_at[i:j] - begin_at[i]
        for w in range(words):
            derived = _mix(part ^ np.uint64((w + 1) * 0xC2B2AE3D27D4EB4F & _MASK))
            lanes = np.add.reduceat(_SPREAD[derived.view(np.uint8).reshape(-1, 8)], runs, axis=0)
            some = lanes.view(np.uint8).reshape(len(runs), 64).astype(np.int64)
            heads = np.flatnonzero(np.concatenate(([True], of[i:j][1:] != of[i:j][:-1])))
            counts[of[i:j][heads], 64 * w : 64 * w + 64] += np.add.reduceat(some, heads, axis=0)
        i = j
    return np.packbits(2 * counts + tie > lens[:, None], axis=1, bitorder="little").view(np.uint64).reshape(len(sets), words)
