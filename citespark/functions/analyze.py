"""Analyzers: the lexemes of a token, as columns for the index and in Python for queries (they agree)."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from citespark.functions.text import ACCENTED, PLAIN, fold

#: Words that carry no lemma and no surface form, folded: short function words of the corpus languages and of Hungarian.
STOPWORDS = (
    "a", "az", "es", "is", "egy", "van", "the", "of", "and", "to", "in", "it", "that", "be", "are", "was", "de", "la", "le", "les", "un", "une", "et", "en",
    "el", "los", "y", "que", "der", "die", "das", "und", "zu", "den", "des", "no", "se", "arrol", "ez", "azt", "mar", "csak", "hogy", "nem", "kozott",
)
#: The light stemmer: one of these endings goes if three letters stay.
ENDINGS = "ations|ation|ments|ment|ings|ing|ions|ion|ers|er|ed|es|en|bol|rol|tol|nak|nek|ban|ben|ok|ek|s"
LIGHT = f"^(.{{3,}}?)(?:{ENDINGS})$"
_LIGHT = re.compile(LIGHT)
_FOLD = str.maketrans(ACCENTED, PLAIN)


def stem_col(token: Column) -> Column:
    return F.regexp_replace(token, LIGHT, "$1")


def stem(token: str) -> str:
    m = _LIGHT.match(token)
    return m.group(1) if m else token


def fold_word(token: str) -> str:
    return token.translate(_FOLD).lower()


def _lexemes(token: Column, folded: Column, lemma: Column) -> Column:
    return F.when(folded.isin(*STOPWORDS), F.array(token)).otherwise(F.array_distinct(F.array(folded, fold(lemma), lemma, token)))


def lexemes_col(token: Column) -> Column:
    """Distinct lexemes of a lower-case token: folded surface, folded lemma, accented lemma. Stop words have only their raw form."""
    return _lexemes(token, fold(token), stem_col(token))


def lexemes_of(tokens: Column) -> Column:
    """The lexemes of each token of an array, one after the other; each form is made once."""
    forms = F.transform(tokens, lambda t: F.struct(t.alias("t"), fold(t).alias("f"), stem_col(t).alias("s")))
    return F.flatten(F.transform(forms, lambda x: _lexemes(x["t"], x["f"], x["s"])))


def words(text: str) -> list[str]:
    return ["".join(x) for x in _runs(text.lower())]


def _runs(text: str):
    run: list[str] = []
    for c in text:
        if unicodedata.category(c)[0] in "LN":
            run.append(c)
        elif run:
            yield run
            run = []
    if run:
        yield run
