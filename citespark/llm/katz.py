"""Katz backoff language model of any order: Good-Turing discounted counts, exactly normalised backoff weights.

The corpus is cut into chunks of about a million tokens, each a file in the shared folder. Level by level (single tokens, pairs,
triples ...) a chunk tells buckets of contexts its distinct n-grams, and is told their corpus counts, so every n-gram travels once
per chunk, packed: frequent words are no hot keys. Tables (Parquet, in the shared folder), one for each level, by bucket of contexts:

* n-gram replies: per chunk the corpus counts of its n-grams, whether other chunks have them, for each context the least count of its
  continuations, and for contexts before an n-gram of the chunk that training never saw, which alone back off, the whole numbers that the
  backoff weight is made of; the first level also gives words short numbers, by which n-grams are named from then on
* parts: the same numbers of contexts so frequent that their continuations are dealt to several tasks

A context that occurs in one chunk alone is settled there and asks nobody. Evaluation is recursive: the probability at a
level is the discounted count where the n-gram was seen, else the context's weight times the probability one level below.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import filesystem, forget, shared_dir, store

#: Good-Turing discounts apply to counts up to this.
K = 5
CHUNK_TOKENS = 1_000_000
#: Bytes of text for each bucket of contexts; continuations of a context of more than SPLIT occurrences go to several tasks.
BUCKET_BYTES, SPLIT = 12 << 20, 4_000_000
#: Words hold no blank, so these are no words: the context before the first token, and the end.
_START, _END = xxhash.xxh64_intdigest(b"\t"), xxhash.xxh64_intdigest(b"\n")
_ROW = "kind string, chunk string, bucket int, split int, blob binary"


def _pack(*arrays) -> bytes:
    raw = pickle.dumps([_planes(x) for x in arrays], protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes) -> list[np.ndarray]:
    return [_whole(x) for x in pickle.loads(pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True))]


def _planes(x: np.ndarray) -> np.ndarray:
    """The bytes of 64-bit numbers plane by plane, as many as the largest needs, which packs better; other arrays as they are."""
    if x.dtype not in (np.int64, np.uint64):
        return x
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)
    top = int(np.bitwise_or.reduce(x.view(np.uint64))) if len(x) else 0
    return np.ascontiguousarray(raw[:, : max(1, -(-top.bit_length() // 8))].T)


def _whole(planes: np.ndarray) -> np.ndarray:
    if planes.ndim != 2:
        return planes
    raw = np.zeros((planes.shape[1], 8), np.uint8)
    raw[:, : len(planes)] = planes.T
    return raw.view(np.int64)[:, 0]


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "chunk", "bucket", "split", "blob"])


def discounts(n: list[int]) -> np.ndarray:
    """Katz's Good-Turing factors d[0..K] from the numbers n[r] of n-grams seen r times (n[1] .. n[K + 1]); d[0] is unused.

    The largest cut-off up to K is taken with which all factors lie in (0, 1); counts above it are kept as they
    are. If there is none, as in tiny corpora, half a count is taken off each instead.
    """
    for top in range(K, 0, -1):
        if not all(n[1 : top + 2]):
            continue
        common = (top + 1) * n[top + 1] / n[1]
        turing = [((r + 1) * n[r + 1] / (n[r] * r) - common) / (1 - common) if common != 1 else 0 for r in range(1, top + 1)]
        if all(0 < x < 1 for x in turing):
            return np.array([1.0, *turing] + [1.0] * (K - top))
    return np.array([1.0] + [(r - 0.5) / r for r in range(1, K + 1)])


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    c = c.astype(np.float64)
    return c * np.where(c <= K, d[np.minimum(c, K).astype(np.int64)], 1.0)


def _freed(d: np.ndarray) -> np.ndarray:
    """What the discount takes off counts 1 .. K."""
    return np.array([r * (1 - d[r]) for r in range(1, K + 1)])


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _chunks(frames: Iterator[pd.DataFrame], folder: str, buckets: int, chunk_tokens: int) -> Iterator[pd.DataFrame]:
    target, base = filesystem(folder)
    target.create_dir(base, recursive=True)
    held, size = [], 0

    def flush():
        ids = np.array([int(i) if i is not None else 0 for i, _, _ in held], np.int64)
        none = np.array([i is None for i, _, _ in held])
        out = np.array([h for _, h, _ in held])
        lens = np.array([len(t) for _, _, t in held], np.int64)
        keys, at = np.unique(np.concatenate([t for _, _, t in held]), return_inverse=True)
        count = np.bincount(at[np.repeat(~out, lens)], minlength=len(keys))
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        keys, count, bucket = keys[order], count[order], bucket[order]
        path = f"{base}/{uuid.uuid4().hex}"
        every = np.bincount(rank[at])
        often = np.empty(len(keys), np.int64)  # frequent words first, which packs better
        often[np.argsort(-every, kind="stable")] = np.arange(len(keys))
        with target.open_output_stream(path) as f:
            f.write(_pack(ids, none, out, lens, often[rank[at]], every))
        ends = np.searchsorted(bucket, np.arange(buckets + 1))
        return _rows([("ask", path, b, 0, _pack(keys[i:j].view(np.int64), count[i:j])) for b, (i, j) in enumerate(zip(ends[:-1], ends[1:])) if i < j])

    digest = xxhash.xxh64_intdigest
    for frame in frames:
        for doc_id, out, text in zip(frame.doc_id, frame.held_out, frame.text):
            words = tokens_of(text)
            held.append((doc_id, out, np.array([_START, *map(digest, words), _END], np.uint64)))
            size += len(words) + 2
            if size >= chunk_tokens:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, a place of each, and which one every place holds."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))[: len(key)]
    which = np.empty(len(key), np.int64)
    which[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(key))))
    return ordered[new], order[new], which


def _tuples(names: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct tuple of word numbers, and which one every place holds."""
    first, which = _groups(names[0])[1:]
    for x in names[1:]:
        own = _groups(x)[2]
        first, which = _groups(which * (int(own.max(initial=0)) + 1) + own)[1:]
    return first, which


def _bucket(names: list[np.ndarray], buckets: int) -> np.ndarray:
    h = names[0].astype(np.uint64)
    for x in names[1:]:
        h = (h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29))) + x.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _stats(counts: np.ndarray) -> list[int]:
    """Sum, number and largest of the counts above 0, then how many are 1 .. K + 1."""
    seen = counts[counts > 0]
    return [int(seen.sum()), len(seen), int(seen.max(initial=0)), *(int((seen == r).sum()) for r in range(1, K + 2))]


def _unigrams(buckets: int):
    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        bucket = int(frame.bucket.iloc[0])
        blobs = [_unpack(b) for b in frame.blob]
        keys, at = np.unique(np.concatenate([b[0] for b in blobs]), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate([b[1] for b in blobs])).astype(np.int64)
        word = np.empty(len(total), np.int64)  # small numbers for frequent words
        word[np.argsort(-total, kind="stable")] = np.arange(len(total)) * buckets + bucket
        shared = (np.bincount(at) > 1).astype(np.int64)
        ends = np.cumsum([0] + [len(b[0]) for b in blobs])
        rows = [("n1", c, bucket, 0, _pack(total[at[i:j]], word[at[i:j]], shared[at[i:j]])) for c, i, j in zip(frame.chunk, ends[:-1], ends[1:])]
        counted = _stats(total[keys.view(np.uint64) != np.uint64(_START)])
        counted[2] = int(total.max(initial=0))
        return _rows([*rows, ("stats", "", bucket, 0, _pack(np.array(counted)))])

    return of


#: What a context's weight is made of: numbers of continuations seen 1 .. K times, and the sum of their counts one level below and how many of these are 1 .. K.
_SUMS = 2 * K + 1


def _sums(context: np.ndarray, total: np.ndarray, below: np.ndarray, contexts: int) -> np.ndarray:
    """Those numbers, a row each, for n-grams of the given contexts, counts and counts one level below; unseen ones do not count."""
    seen = total > 0
    context, total, below = context[seen], total[seen], below[seen]
    out = np.zeros((_SUMS, contexts), np.int64)
    for r in range(1, K + 1):
        out[r - 1] = np.bincount(context[total == r], minlength=contexts)
        out[K + r] = np.bincount(context[below == r], minlength=contexts)
    out[K] = np.bincount(context, weights=below, minlength=contexts)
    return out


def _least(sums: np.ndarray) -> np.ndarray:
    """The least count of each context's seen continuations, K + 1 if none is seen 1 .. K times."""
    some = sums[:K] > 0
    return np.where(some.any(0), some.argmax(0) + 1, K + 1)


def _told(total: np.ndarray, runs: np.ndarray, split: np.ndarray) -> np.ndarray:
    """Which contexts a reply tells the sums of: those with an n-gram never seen, but for split ones, whose sums come as wholes."""
    return np.logical_or.reduceat(total == 0, runs) & ~split


class _Level:
    """The distinct n-grams of a chunk at one level."""

    count: np.ndarray  # in the training corpus
    names: list[np.ndarray]  # numbers of its words, one array for each place
    shared: np.ndarray  # whether another chunk has it
    own: np.ndarray  # training occurrences here
    index: np.ndarray  # of the n-gram that ends at each place, -1 if there is none
    left: np.ndarray  # context: an n-gram one level below
    right: np.ndarray  # token
    below: np.ndarray  # the n-gram without its first token, one level below
    least: np.ndarray  # by context (index one level below): least count of its continuations, see _least
    open: np.ndarray  # contexts before an n-gram never seen: the only ones whose weight is asked for
    sums: np.ndarray  # of these


class _Chunk:
    """A chunk with what it was told so far, level by level."""

    def __init__(self, frame: pd.DataFrame, levels: int, buckets: int, split: int):
        self.buckets, self.split = buckets, split
        self.path = frame.chunk.iloc[0]
        target, path = filesystem(self.path)
        with target.open_input_stream(path) as f:
            self.ids, self.none, self.out, self.lens, at, every = _unpack(f.read())
        self.tokens = len(every)
        self.depth = np.arange(len(at)) - np.repeat(np.cumsum(self.lens) - self.lens, self.lens)
        self.train = np.repeat(~self.out, self.lens)
        one = _Level()
        told = [_unpack(b) for b in frame[frame.kind == "n1"].sort_values("bucket").blob]
        told = [np.concatenate(x) for x in zip(*told)]
        by_name = np.argsort(told[1])  # so contexts are asked about in the order of their names
        place = np.empty(self.tokens, np.int64)
        place[by_name] = np.arange(self.tokens)
        at = place[np.argsort(-every, kind="stable")][at]
        one.count, self.word, one.shared = (x[by_name] for x in told)
        one.names = [self.word]
        one.index, one.own = at, np.bincount(at[self.train], minlength=self.tokens)
        self.levels = [None, one]
        for n in range(2, levels + 1):
            self._listen(n, frame)

    def grams(self, n: int) -> _Level:
        """The n-grams of the next level, those that others must be asked about, and in which order."""
        lower, at, g = self.levels[n - 1], self.levels[1].index, _Level()
        place = np.flatnonzero(self.depth >= n - 1)
        key, first, inverse = _groups(lower.index[place - 1] * self.tokens + at[place])
        g.left, g.right = key // self.tokens, key % self.tokens
        g.own = np.bincount(inverse[self.train[place]], minlength=len(key))
        g.below = lower.index[place[first]]
        g.index = np.full(len(at), -1)
        g.index[place] = inverse
        g.asked = np.flatnonzero(lower.shared[g.left] > 0)
        left = g.left[g.asked]
        # contexts by bucket; continuations of frequent ones are split by word
        run = np.flatnonzero(np.concatenate(([True], left[1:] != left[:-1])))[: len(left)]
        size = np.diff(np.append(run, len(left)))
        context = left[run]
        bucket = _bucket([x[context] for x in lower.names], self.buckets)
        splits = np.maximum(-(-lower.count[context] // self.split), 1)
        order = np.argsort(bucket, kind="stable")
        into = np.repeat(run[order] - np.concatenate(([0], np.cumsum(size[order])[:-1])), size[order]) + np.arange(len(left))
        where, g.splits = np.repeat(bucket[order] << 32, size[order]), np.repeat(splits[order], size[order])
        if (splits > 1).any():
            where = where + self.word[g.right[g.asked[into]]] % g.splits
            again = np.argsort(where, kind="stable")
            into, where, g.splits = into[again], where[again], g.splits[again]
        g.asked, g.where = g.asked[into], where
        left = g.left[g.asked]
        # runs of one context at one place
        g.run = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (g.where[1:] != g.where[:-1]))))[: len(left)]
        return g

    def ask(self, n: int) -> pd.DataFrame:
        g, lower = self.grams(n), self.levels[n - 1]
        rows = []
        where, at = np.unique(g.where, return_index=True)
        left, right = g.left[g.asked], g.right[g.asked]
        for w, i, j in zip(where.tolist(), at.tolist(), [*at[1:].tolist(), len(left)]):
            r = g.run[slice(*np.searchsorted(g.run, (i, j)))]
            rows.append(("ask", self.path, w >> 32, w & 0xFFFFFFFF, _pack(
                np.diff(np.append(r, j)), (g.splits[r] > 1).astype(np.int64), self.word[right[i:j]], g.own[g.asked[i:j]], lower.count[g.below[g.asked[i:j]]],
                np.diff(lower.names[0][left[r]], prepend=0), *(x[left[r]] for x in lower.names[1:]),
            )))
        many, bucket = self._many(g, lower)
        rows += [("many", self.path, int(b), -1, _pack(*(x[many[bucket == b]] for x in lower.names))) for b in np.unique(bucket)]
        alone = np.ones(len(g.left), bool)
        alone[g.asked] = False
        rows.append(("stats", "", xxhash.xxh32_intdigest(self.path) % self.buckets, -1, _pack(np.array(_stats(g.own[alone])))))
        return _rows(rows)

    def _many(self, g: _Level, lower: _Level) -> tuple[np.ndarray, np.ndarray]:
        """The contexts whose continuations are dealt to several tasks, by bucket, and their buckets."""
        many = np.unique(g.left[g.asked[g.splits > 1]])
        bucket = _bucket([x[many] for x in lower.names], self.buckets)
        order = np.argsort(bucket, kind="stable")
        return many[order], bucket[order]

    def _listen(self, n: int, frame: pd.DataFrame) -> None:
        g, lower = self.grams(n), self.levels[n - 1]
        told = [_unpack(b) for b in frame[frame.kind == f"n{n}"].sort_values(["bucket", "split"]).blob]
        g.count, g.shared = g.own.copy(), np.zeros(len(g.left), np.uint8)
        g.names = [*(x[g.left] for x in lower.names), self.word[g.right]]
        alone = np.ones(len(g.left), bool)
        alone[g.asked] = False
        sums = _sums(g.left[alone], g.own[alone], lower.count[g.below[alone]], len(lower.count))
        g.least = _least(sums)
        if told:
            g.count[g.asked] = np.concatenate([t[0] for t in told])
            g.shared[g.asked] = np.concatenate([np.unpackbits(t[1])[: len(t[0])] for t in told])
            contexts = g.left[g.asked[g.run]]
            g.least[contexts] = np.concatenate([t[2] for t in told])
            sums[:, contexts[_told(g.count[g.asked], g.run, g.splits[g.run] > 1)]] = np.stack([np.concatenate([t[k] for t in told]) for k in range(-_SUMS, 0)])
        many, _ = self._many(g, lower)
        if len(many):
            whole = [_unpack(b) for b in frame[frame.kind == f"whole{n}"].sort_values("bucket").blob]
            sums[:, many] = np.stack([np.concatenate(x) for x in zip(*whole)])
            g.least[many] = _least(sums[:, many])
        g.open = np.unique(g.left[g.count == 0])
        g.sums = sums[:, g.open]
        self.levels.append(g)


def _asks(n: int, buckets: int, split: int):
    return lambda _, frame: _Chunk(frame, n - 1, buckets, split).ask(n)


def _answers(n: int):
    """Corpus counts of a bucket's n-grams, told to each chunk, and what the weights of its contexts need."""

    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        bucket, split = int(frame.bucket.iloc[0]), int(frame.split.iloc[0])
        if split < 0:  # messages for the next step
            return frame
        blobs = [_unpack(b) for b in frame.blob]
        for b in blobs:
            b[5] = np.cumsum(b[5])
        column = lambda k: np.concatenate([b[k] for b in blobs])
        names = [column(k) for k in range(5, len(blobs[0]))]
        context, run_of = _tuples(names)
        words, _, word = _groups(column(2))
        key, first, at = _groups(np.repeat(run_of, column(0)) * len(words) + word)
        total = np.bincount(at, weights=column(3)).astype(np.int64)
        shared = (np.bincount(at) > 1).astype(np.uint8)
        sums = _sums(key // len(words), total, column(4)[first], len(context))
        least = _least(sums)
        rows = []
        i = r = 0
        for chunk, b in zip(frame.chunk, blobs):
            j, s = i + len(b[2]), r + len(b[0])
            own, counts = run_of[r:s], total[at[i:j]]
            told = _told(counts, np.cumsum(b[0]) - b[0], b[1] > 0)
            rows.append((f"n{n}", chunk, bucket, split, _pack(counts, np.packbits(shared[at[i:j]]), least[own], *sums[:, own[told]])))
            i, r = j, s
        many = np.unique(run_of[column(1) > 0])
        if len(many):
            rows.append(("part", "", bucket, split, _pack(*(x[context[many]] for x in names), *sums[:, many])))
        return _rows([*rows, ("stats", "", bucket, split, _pack(np.array(_stats(total))))])

    return of


def _wholes(n: int):
    """Adds up the parts of contexts that were dealt to several tasks, for each chunk that has some."""

    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        parts, asked = frame[frame.kind == "part"], frame[frame.kind == "many"]
        given, wanted = [_unpack(b) for b in parts.blob], [_unpack(b) for b in asked.blob]
        first, which = _tuples([np.concatenate([b[k] for b in given + wanted]) for k in range(n - 1)])
        sums = np.zeros((_SUMS, len(first)), np.int64)
        ends = np.cumsum([0] + [len(b[0]) for b in given + wanted])
        for k in range(_SUMS):
            np.add.at(sums[k], which[: ends[len(given)]], np.concatenate([b[n - 1 + k] for b in given]))
        own = [which[i:j] for i, j in zip(ends[len(given) : -1], ends[len(given) + 1 :])]
        return _rows([(f"whole{n}", c, b, 0, _pack(*sums[:, x])) for c, b, x in zip(asked.chunk, asked.bucket, own)])

    return of


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(d: list[np.ndarray], n: int, v: int, spare: float, unseen: float, buckets: int, split: int):
    """Scores of a chunk's texts; d[k] are the discounts of level k."""

    def of(_, frame: pd.DataFrame) -> pd.DataFrame:
        c = _Chunk(frame, len(d) - 1, buckets, split)
        one = c.levels[1]
        here = np.flatnonzero(c.depth > 0)
        # by distinct n-gram: probability, and what its context's counts are divided by
        below = np.where(one.count > 0, _discounted(one.count, d[1]) / max(n + spare, 1), unseen)
        divisor = np.full(len(one.count), n + spare)
        final = below[one.index[here]]
        for k in range(2, len(d)):
            g, lower = c.levels[k], c.levels[k - 1]
            # where no continuation is rare enough to be discounted, half a count is added for what was not seen
            rare = np.append(d[k][1:] < 1, False)[g.least - 1]
            extra = np.where((lower.count > 0) & ~rare, 0.5, 0.0)
            over = lower.count + extra
            # what is left one level below for those not seen: no difference of near numbers, so always above 0
            whole = divisor[g.open]
            rest = (whole - g.sums[K] + _freed(d[k - 1]) @ g.sums[K + 1 :]) / np.maximum(whole, 1)
            # a context that training never saw leaves everything to the level below
            weight = np.full(len(over), np.nan)
            weight[g.open] = np.where(lower.count[g.open] > 0, (_freed(d[k]) @ g.sums[:K] + extra[g.open]) / np.maximum(over[g.open], 1) / np.where(rest > 0, rest, 1), 1.0)
            now = np.where(g.count > 0, _discounted(g.count, d[k]) / np.maximum(over[g.left], 1), weight[g.left] * below[g.below])
            has = g.index[here] >= 0
            final[has] = now[g.index[here[has]]]
            below, divisor = now, over[g.below]
        first = np.concatenate(([0], np.cumsum(c.lens - 1)[:-1]))
        add = lambda x: np.add.reduceat(x, first)
        count = one.count[one.index[here]]
        return pd.DataFrame({
            "doc_id": pd.array([None if x else i for i, x in zip(c.ids.tolist(), c.none)], dtype="Int64"), "held_out": c.out, "n_tokens": c.lens - 1, "n_known": add((count > 0).astype(np.int64)),
            "train_tokens": n, "base_score": add(np.log10((count + 1) / (n + v + 1))), "score": add(np.log10(final)),
        })

    return of


def score_texts(docs: DataFrame, held_out, order: int = 3, chunk_tokens: int = CHUNK_TOKENS, bucket_bytes: int = BUCKET_BYTES, split: int = SPLIT) -> DataFrame:
    """Katz backoff scores of every whole text of (doc_id, text), learned from rows where `held_out` (a column) is false.

    Result: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams), score. Tokens are words,
    A-Z in lower case, and one end for each text; words are told apart by 64-bit hashes. n-grams of up to `order` tokens; the
    context before a text's first token is one start, so its second token has a context of two at most. P(w | h) is the
    discounted count over count(h) where the n-gram was seen (half a count is added to count(h) if all its continuations are too
    frequent for a discount), else the weight of h times P(w | h without its first token). P(w) is discounted likewise, and what
    it frees is the probability of the one unknown token. The weight of h makes its probabilities over all known tokens and the unknown one
    sum to 1 exactly.

    Null and empty texts are a lone end. Repeated rows count and come back each; a null doc_id stays null. If nothing is left
    to learn from, the unknown token has probability 1. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4, -(-size // bucket_bytes))
    folder = f"{shared_dir(spark)}/citespark/chunks-{uuid.uuid4().hex}"
    # chunks have new names in every attempt; only those named in the written table are used
    asked = store(rows.mapInPandas(lambda frames: _chunks(frames, folder, buckets, chunk_tokens), _ROW))

    def total(df: DataFrame) -> list[int]:
        found = np.array([_unpack(bytes(r[0]))[0] for r in df.where("kind = 'stats'").select("blob").toLocalIterator()])  # a few numbers per bucket and chunk
        return [*found[:, :2].sum(0).tolist(), int(found[:, 2].max()), *found[:, 3:].sum(0).tolist()] if len(found) else [0] * (K + 4)

    told = store(asked.groupBy("bucket").applyInPandas(_unigrams(buckets), _ROW))
    forget(asked)
    n, v, largest, *few = total(told)
    d = [np.ones(K + 1), discounts([0, *few])]
    freed = sum(x * y for x, y in zip(_freed(d[1]), few))
    spare = 0.5 if freed <= 0 else 0.0  # every token is frequent: half a count is kept back for the unknown one
    unseen = (freed + spare) / (n + spare) if n else 1.0
    tables = [told]

    def replies() -> DataFrame:
        out = tables[0].where("kind = 'n1'")
        for t in tables[1:]:
            out = out.unionByName(t.where(F.col("kind").rlike("^(n|whole)[0-9]")))
        return out

    for level in range(2, order + 1):
        splits = max(1, -(-largest // split))
        asked = replies().groupBy("chunk").applyInPandas(_asks(level, buckets, split), _ROW)
        told = store(asked.groupBy("bucket", "split").applyInPandas(_answers(level), _ROW))
        tables.append(told)
        if splits > 1:
            tables.append(store(told.where("kind in ('part', 'many')").groupBy("bucket").applyInPandas(_wholes(level), _ROW)))
        _, _, largest, *few = total(told)
        d.append(discounts([0, *few]))
    out = store(replies().groupBy("chunk").applyInPandas(_scores(d, n, v, spare, unseen, buckets, split), _SCORES))
    for t in tables:
        forget(t)
    target, base = filesystem(folder)
    if size or not out.isEmpty():
        target.delete_dir(base)
    return out
