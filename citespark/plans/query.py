"""Compiling a text query on the driver into alternatives of lexemes per term; no Spark involved."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from citespark.functions.analyze import STOPWORDS, fold_word, stem, words
from citespark.functions.text import WHITESPACE

# Operator words, symbols and field prefixes that are refused.
BOOLEAN_WORDS = ("AND", "OR", "NOT")
BOOLEAN_SYMBOLS = ("&", "&&", "|", "||", "!")
FIELD_PREFIXES = ("title:", "author:", "outlet:", "tag:", "section:", "date:", "from:", "to:", "url:", "text:", "body:")
# Case suffixes whose accents a fold damaged, and their spellings.
CASE_SUFFIXES = (("rol", "ról"), ("rol", "ről"), ("tol", "tól"), ("tol", "től"), ("bol", "ból"), ("bol", "ből"), ("nal", "nál"), ("nel", "nél"), ("ert", "ért"), ("kent", "ként"))

PREFIX_FROM = 7
_SPACE = re.compile(re.sub(r"\\x\{([0-9a-f]{4})\}", lambda m: "\\u" + m[1], WHITESPACE))


class UnsupportedQuery(ValueError):
    """The query uses operator syntax, which would otherwise be searched for as words."""


@dataclass(frozen=True)
class Side:
    kind: str
    lexemes: tuple[tuple[str, bool], ...]  # (text, matches as prefix); all must be in one vector


@dataclass(frozen=True)
class Term:
    ord: int
    raw: str
    sides: tuple[Side, ...]  # any may match

    @property
    def accented(self) -> bool:
        return fold_word(self.raw) != self.raw.lower()


@dataclass(frozen=True)
class Plan:
    terms: tuple[Term, ...] = field(default_factory=tuple)

    def rows(self) -> list[tuple[int, int, int, str, bool]]:
        """(ord, side, number of lexemes of the side, lexeme, is_prefix)"""
        return [(t.ord, s, len(side.lexemes), x, p) for t in self.terms for s, side in enumerate(t.sides) for x, p in side.lexemes]


def check_syntax(query: str) -> None:
    for token in (query or "").split():
        if (
            token in BOOLEAN_WORDS or token in BOOLEAN_SYMBOLS or (token[0] == "-" and len(token) > 1)
            or (token[-1] == "*" and len(token) > 1) or token.lower().startswith(FIELD_PREFIXES)
        ):
            raise UnsupportedQuery(f"{token!r} is operator syntax, which is not searched for")


def search_terms(query: str) -> list[str]:
    """Collapse, split at blanks and ASCII hyphens, drop empty terms, keep order. An en dash does not split here."""
    return [t for t in re.split("[ -]+", _SPACE.sub(" ", query or "").strip()) if t]


def _prefixed(lexemes: list[str]) -> tuple[tuple[str, bool], ...]:
    return tuple((x, len(x) >= PREFIX_FROM) for x in lexemes)


def surface_lexemes(term: str) -> list[str]:
    return list(dict.fromkeys(w for w in map(fold_word, words(term)) if w not in STOPWORDS))


def lemma_lexemes(term: str) -> list[str]:
    return list(dict.fromkeys(fold_word(stem(w)) for w in words(term) if fold_word(w) not in STOPWORDS))


def guarded(lemmas: list[str], surface: list[str]) -> list[str]:
    """Lemmas of two letters or fewer only count where they are surface forms."""
    return [x for x in lemmas if len(x) > 2 or x in surface]


def reaccented_lemmas(term: str) -> list[str]:
    out = set()
    for plain, accented in CASE_SUFFIXES:
        if term.endswith(plain) and len(term) > len(plain) + 1:
            for w in words(term[: len(term) - len(plain)] + accented):
                x = fold_word(stem(w))
                if 2 < len(x) < len(term):
                    out.add(x)
    return sorted(out)


def accented_sides(term: str) -> list[Side]:
    lemmas = guarded([stem(w) for w in words(term) if fold_word(w) not in STOPWORDS], words(term))
    sides = [Side("accented", _prefixed(lemmas))] if lemmas else []
    sides.append(Side("raw", _prefixed(words(term))))
    if not lemmas and surface_lexemes(term):
        sides.append(Side("surface", _prefixed(surface_lexemes(term))))
    return [s for s in sides if s.lexemes]


def term_sides(term: str) -> list[Side]:
    """Accented terms match accented text only; accent-free ones match lemma, re-accented lemma or surface."""
    if fold_word(term) != term.lower():
        return accented_sides(term)
    surface = surface_lexemes(term)
    lemmas = guarded(lemma_lexemes(term), surface)
    sides = [Side("lemma", tuple((x, False) for x in lemmas))]
    if lemmas == [term.lower()]:
        sides += [Side("reaccented", ((x, False),)) for x in reaccented_lemmas(term.lower())]
    sides.append(Side("surface", _prefixed(surface)))
    return [s for s in sides if s.lexemes]


def compile_query(query: str) -> Plan:
    check_syntax(query)
    found = [(t, term_sides(t)) for t in search_terms(query)]
    kept = [(t, s) for t, s in found if s]
    return Plan(tuple(Term(i, t, tuple(s)) for i, (t, s) in enumerate(kept)))


def lemma_phrase_safe(needle: str) -> bool:
    """Whether every lemma of the needle passes the short-lemma guard."""
    return all(len(x) > 2 for x in lemma_lexemes(needle)) and bool(lemma_lexemes(needle))


def phrase_edges_survive(needle: str) -> bool:
    """Whether first and last word are no stop words, so that the phrase's ends are pinned."""
    w = [fold_word(x) for x in words(needle)]
    return bool(w) and w[0] not in STOPWORDS and w[-1] not in STOPWORDS


def phrase_patterns(needle: str) -> dict[str, str]:
    """Regular expressions over blank-joined tokens for the branches in force: simple, folded, lemma (stop words inside are gaps)."""
    w = words(needle)
    if not w:
        return {}
    around = lambda parts: "(^| )" + " ".join(parts) + "( |$)"
    out = {"simple": around(w)}
    if [fold_word(x) for x in w] == w:
        out["folded"] = around(w)
    if lemma_phrase_safe(needle) and phrase_edges_survive(needle):
        plain = all(fold_word(x) == x for x in w)
        out["lemma" if plain else "accented_lemma"] = around(["[^ ]+" if fold_word(x) in STOPWORDS else (fold_word(stem(x)) if plain else stem(x)) for x in w])
    return out
