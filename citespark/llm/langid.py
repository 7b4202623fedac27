"""Language identification: known words by log frequency, character n-grams for unseen words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import forget, packed, store, unpacked

UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_OTHER = re.compile(r"[\W\d_]")
#: Texts are scanned in pieces of about so many characters, cut where no letter is, so that memory stays bounded.
_PIECE = 1 << 20
#: n-grams of a letter run are looked up so many at once; longer runs go part by part.
_RUN = 4096


def _pieces(text: str, overlap: int = 0) -> Iterator[str]:
    """Pieces of a text; a letter run of over _PIECE is cut, its parts overlapping by so many letters."""
    at = 0
    while at < len(text):
        end = at + _PIECE
        again = 0
        if end < len(text):
            cut = _OTHER.search(text, end, end + _PIECE)
            end = cut.start() if cut else end + _PIECE
            again = 0 if cut or end >= len(text) else overlap
        yield text[at:end]
        at = end - again


def _grams(word: str, n: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


#: A language's n-grams of a length tell its words from others' if no more of them were learned than this share of the strings of its letters.
_TELLING = 0.25


def _telling(grams: dict[int, dict], k: int) -> int:
    """The least length from 2 on at which the n-grams of language k are few among all strings, else the greatest: 4 for alphabets, 2 for Chinese.

    Letters count by the perplexity of their distribution, so that a few strays do not make an alphabet look large.
    """
    counts = np.array([by_lang[k] for g, by_lang in grams.get(1, {}).items() if k in by_lang and g not in "<>"], float)
    share = counts / max(counts.sum(), 1)
    letters = np.exp(-(share * np.log(share)).sum())
    for n in sorted(grams):
        if n > 1 and sum(k in by_lang for by_lang in grams[n].values()) <= _TELLING * letters**n:
            return n
    return max(grams)


class Model:
    """Log probabilities by language of words and of n-grams of each length, longest first.

    Sparse: a key holds what it gains over the floor of unseen keys in the languages that have it.
    """

    def __init__(self, langs: list[str], words: dict, grams: dict[int, dict], totals: dict):
        self.langs = langs
        self.orders = sorted(grams, reverse=True)
        first, lang, gain = [0], [], []
        self.floors: dict[int, np.ndarray] = {}

        def table(order: int, counts: dict) -> dict[str, int]:
            total = totals[order]
            # one floor for all, that of the most text: else languages of little text would win wherever words are unknown to them
            floor = self.floors[order] = np.full(len(total), np.log(0.5 / (total.max(initial=0) + 1)))
            index = {}
            for key, by_lang in counts.items():
                index[key] = len(first) - 1
                for k in sorted(by_lang):
                    lang.append(k)
                    gain.append(np.log((by_lang[k] + 0.5) / (total[k] + 1)) - floor[k])
                first.append(len(lang))
            return index

        self.words = table(0, words)
        self.grams = {n: table(n, grams[n]) for n in self.orders}
        self.first, self.lang, self.gain = np.array(first, np.int64), np.array(lang, np.int32), np.array(gain)
        telling = [_telling(grams, k) for k in range(len(langs))]
        self.least = min(telling, default=0)
        self.tells = bytearray(len(first))  # n-grams of the length that tells a language that has them
        for n in set(telling):
            for g, by_lang in grams[n].items():
                self.tells[self.grams[n][g]] = any(telling[k] == n for k in by_lang)

    @property
    def rows(self) -> np.ndarray:
        """All log probabilities as a matrix of keys and languages, for looking at small models."""
        out = np.zeros((len(self.first) - 1, len(self.langs)))
        for order, index in [(0, self.words), *self.grams.items()]:
            out[list(index.values())] = self.floors[order]
        out[np.repeat(np.arange(len(out)), np.diff(self.first)), self.lang] += self.gain
        return out

    def _gains(self, keys, weights) -> np.ndarray:
        """Sum of the weighted gains of keys, by language."""
        keys = np.asarray(keys, np.int64)
        begin = self.first[keys]
        n = self.first[keys + 1] - begin
        at = np.repeat(begin - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(self.lang[at], weights=self.gain[at] * np.repeat(weights, n), minlength=len(self.langs))

    def backoff(self, word: str) -> tuple[np.ndarray | None, bool]:
        """Mean over the word's known n-grams of the greatest length that has any (None if none has), and whether the word is evidence.

        It is if at least half of its n-grams of some length are known ones that tell a language: nearly all
        shorter ones, and those of the padding marks alone, occur in words of any language of the script.
        """
        row, padded = None, f"<{word}>"
        for n in self.orders:
            index, count = self.grams[n], len(padded) - n + 1
            total, known, telling = 0.0, 0, 0
            for at in range(0, count, _RUN):  # the whole run, in parts that overlap by n - 1
                part = padded[at : at + _RUN + n - 1]
                found = [index[g] for i in range(len(part) - n + 1) if (g := part[i : i + n]) in index]
                if found:
                    if row is None:
                        total = total + self._gains(found, np.ones(len(found)))
                    known += len(found)
                    telling += sum(map(self.tells.__getitem__, found))
            if known:
                if row is None:
                    row = self.floors[n] + total / known
                if 2 * telling >= count:
                    return row, True
            if row is not None and n <= self.least:
                break
        return row, False

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its posterior (0 to 1) and the share of words that are known or evidence by their n-grams."""
        if not text or not self.langs:
            return UNKNOWN, 0.0, 0.0
        total, n_words, n_seen = np.zeros(len(self.langs)), 0, 0
        unseen: Counter = Counter()
        get = self.words.get
        for piece in _pieces(text, self.orders[0] - 1):
            words = _LETTERS.findall(piece.lower())
            n_words += len(words)
            ids = [get(w, -1) for w in words]
            at = np.array(ids, np.int64)
            known = at[at >= 0]
            n_seen += len(known)
            if len(known):
                total += len(known) * self.floors[0] + self._gains(known, np.ones(len(known)))
            if len(known) < len(words):
                unseen.update(w for w, i in zip(words, ids) if i < 0)
            if len(unseen) > 100_000:
                n_seen += self._add(unseen, total)
                unseen.clear()
        n_seen += self._add(unseen, total)
        if not n_words:
            return UNKNOWN, 0.0, 0.0
        best = int(total.argmax())  # ties go to the language first in code point order
        return self.langs[best], float(1 / np.exp(total - total[best]).sum()), n_seen / n_words

    def _add(self, unseen: Counter, total: np.ndarray) -> int:
        """`backoff` of many words at once, added to `total`; returns how many are evidence."""
        seen = 0
        keys: list[int] = []
        lens: list[int] = []
        times: list[float] = []
        tells = self.tells.__getitem__
        for word, n in unseen.items():
            if len(word) > _RUN:
                row, evident = self.backoff(word)
                if row is not None:
                    total += n * row
                seen += n * evident
                continue
            padded, chosen = f"<{word}>", False
            for k in self.orders:
                index, count = self.grams[k], len(padded) - k + 1
                found = [index[g] for i in range(count) if (g := padded[i : i + k]) in index]
                if found:
                    if not chosen:
                        chosen = True
                        keys += found
                        lens.append(len(found))
                        times.append(n / len(found))
                        total += n * self.floors[k]
                    if 2 * sum(map(tells, found)) >= count:
                        seen += n
                        break
                if chosen and k <= self.least:
                    break
        if keys:
            total += self._gains(keys, np.repeat(times, lens))
        return seen


def fit(labelled: DataFrame, per_lang: int = 2000, most_rows: int = 40_000, orders=(1, 2, 3, 4)) -> Model:
    """A model of (doc_id, text, lang) rows with text and lang; every lang value is learned, with all words and n-grams of its rows.

    Bounds, both documented parameters: it is fitted on about `per_lang` rows of each language and about `most_rows` in all, shared
    evenly (those whose hashed doc_id and text are below a threshold; copies count once). What reaches the driver and the
    broadcast are the words and n-grams of these rows.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = store(rows.groupBy("lang").count())
    langs = sorted(r["lang"] for r in sizes.select("lang").collect())
    each = min(per_lang, max(1, most_rows // max(len(langs), 1)))
    rates = sizes.select("lang", (F.lit(each) / F.col("count")).alias("rate"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    sample = rows.withColumn("draw", draw).join(rates, "lang").where("draw < rate").select("text", "lang").dropDuplicates(["lang", "text"])

    def words_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, texts in frame.groupby("lang").text:
                counts: Counter = Counter()
                for t in texts:
                    for piece in _pieces(t, max(orders) - 1):
                        counts.update(_LETTERS.findall(piece.lower()))
                yield pd.DataFrame({"lang": lang, "word": list(counts), "n": list(counts.values())})

    words = store(sample.mapInPandas(words_of, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))

    def grams_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: Counter = Counter()
            for lang, word, n in zip(frame.lang, frame.word, frame.n):
                for k in orders:
                    for g in _grams(word, k):
                        counts[lang, k, g] += n
            yield pd.DataFrame([(*key, n) for key, n in counts.items()], columns=["lang", "k", "gram", "n"])

    grams = words.mapInPandas(grams_of, "lang string, k int, gram string, n long").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    at = {lang: i for i, lang in enumerate(langs)}
    word_counts: dict = {}
    gram_counts: dict[int, dict] = {k: {} for k in orders}
    totals = {k: np.zeros(len(langs)) for k in (0, *orders)}
    for r in words.toLocalIterator():
        word_counts.setdefault(r["word"], {})[at[r["lang"]]] = r["n"]
        totals[0][at[r["lang"]]] += r["n"]
    for r in grams.toLocalIterator():
        gram_counts[r["k"]].setdefault(r["gram"], {})[at[r["lang"]]] = r["n"]
        totals[r["k"]][at[r["lang"]]] += r["n"]
    forget(words), forget(sizes)
    return Model(langs, word_counts, gram_counts, totals)


def held_out(modulus: int = 3, rest: int = 1):
    """True where crc32 of the doc_id as text leaves `rest`; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus)) == rest


def predict(docs: DataFrame, model: Model, text: str = "text"):
    """A struct column lang_pred, score, evidence for the texts of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the words and n-grams of a bounded sample

    @F.pandas_udf("lang_pred string, score double, evidence double")
    def of(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        return pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "evidence"])

    return of(text)


def language_id(docs: DataFrame, **bounds) -> DataFrame:
    """Language of every whole text of (doc_id, text, lang), learned from rows outside the held-out third.

    Result: doc_id, held_out, lang_pred (a learned lang, or 'und' if the text is null or has no letter),
    score (posterior, 0 to 1), evidence (share of words that are known, or at least half of whose n-grams are, of a length at which
    few of all strings are n-grams of a language). Only text enters a prediction.

    Ties go to the language first in code point order; repeated rows come back each; with nothing to learn from,
    and for an empty table, every prediction is 'und' or the result empty. Other columns are ignored.
    """
    model = fit(docs.where(~held_out()), **bounds)
    rows = docs.select("doc_id", held_out().alias("held_out"), predict(docs, model).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.evidence")


def drop_unknown(docs: DataFrame, evidence: float = 0.5, **bounds) -> DataFrame:
    """`docs` without texts in no language that their own labels teach: 'und' ones, and those with a share of words of evidence below `evidence`.

    Learned from all rows with text and lang. Null, empty and letterless texts go; repeated rows are judged alike; with nothing
    to learn from all go. An empty table gives an empty result. All columns are kept, whatever their names.
    """
    model = fit(docs, **bounds)
    rows = packed(docs, text=F.col("text")).withColumn("found", predict(docs, model))
    return unpacked(rows.where((F.col("found.lang_pred") != UNKNOWN) & (F.col("found.evidence") >= evidence)), docs.columns)
