"""Text-quote selectors: making, finding, checking and repairing. The quote is the authority: a slice that differs is reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of context kept on either side of a quote.
CONTEXT = 32
#: Letters by which needles of one or two words meet blocks.
GRAM = 3


def cut(text: Column, start: Column, end: Column) -> Column:
    """Code points start (from 0) to end (exclusive)."""
    return F.substring(text, start + 1, end - start)


def make_selector(text: Column, start: Column, end: Column) -> Column:
    """start, end, exact, prefix, suffix; null for empty, reversed or out-of-range ones. Empty context is null."""
    ok = (start >= 0) & (start < end) & (end <= F.length(text))
    before = F.greatest(start - CONTEXT, F.lit(0))
    none = lambda x: F.when(x != "", x)
    return F.when(
        ok,
        F.struct(
            start.cast("int").alias("start"), end.cast("int").alias("end"), cut(text, start, end).alias("exact"),
            none(cut(text, before, start)).alias("prefix"), none(F.substring(text, end + 1, F.lit(CONTEXT))).alias("suffix"),
        ),
    )


def find_selector(text: Column, needle: Column, occurrence: int = 1) -> Column:
    """Selector of the n-th occurrence; a later one may overlap the one before."""
    at = F.instr(text, needle)
    for _ in range(occurrence - 1):
        at = F.when(at > 0, F.call_function("locate", needle, text, at + 1)).otherwise(0)
    return F.when((at > 0) & (needle != ""), make_selector(text, at - 1, at - 1 + F.length(needle)))


def verify(text: Column, start: Column, end: Column, exact: Column) -> Column:
    """ok, xpath_unresolved (no text), range_out_of_bounds or quote_mismatch, in this order of precedence."""
    return (
        F.when(text.isNull(), "xpath_unresolved")
        .when((start < 0) | (end > F.length(text)) | (start >= end), "range_out_of_bounds")
        .when(cut(text, start, end) != exact, "quote_mismatch")
        .otherwise("ok")
    )


def _one_of(letters: list[str]) -> str:
    """A pattern for one of `letters`, whatever they mean in a pattern."""
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(letters)) + "]"


def locate_quotes(blocks: DataFrame, needles: DataFrame) -> DataFrame:
    """Selectors of each needle (item_id, needle) at its first place in every block that holds it, also inside words.

    Needles meet blocks by an equi-join before the exact test. A needle of three words or more is met by its longest inner word, which
    stands between blanks wherever the needle occurs; a shorter one by its first letters (GRAM at most), at any place of a block where each
    letter is one that some short needle has there. Only keys are shuffled; the text joins the candidates. Empty needles are nowhere.
    """
    words = lambda x: F.split(x, " ")
    needles = needles.where("needle <> ''").select("item_id", "needle")
    long = needles.where(F.size(words(F.col("needle"))) > 2)
    inner = F.slice(words(F.col("needle")), F.lit(2), F.size(words(F.col("needle"))) - 2)
    word = F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    short = needles.where(F.size(words(F.col("needle"))) <= 2)
    letters = [F.collect_set(F.substring("needle", i + 1, 1)).alias(f"at{i}") for i in range(GRAM)]
    starts = short.groupBy(F.least(F.length("needle"), F.lit(GRAM)).alias("n")).agg(*letters).collect()  # GRAM rows at most, of letters
    grams = lambda r: F.regexp_extract_all("block_text", F.lit(f"(?=({''.join(_one_of(r[f'at{i}']) for i in range(r.n))}))"), F.lit(1))
    keys = F.array_distinct(F.concat(words(F.col("block_text")), *[grams(r) for r in starts]))
    keyed = long.select("item_id", "needle", word.alias("key")).unionByName(short.select("item_id", "needle", F.substring("needle", 1, GRAM).alias("key")))
    met = blocks.select("article_id", "block_index", F.explode(keys).alias("key")).join(keyed, "key")
    met = met.select(F.col("article_id").alias("a"), F.col("block_index").alias("i"), "item_id", "needle").distinct()  # ids may repeat or be null
    same = F.col("article_id").eqNullSafe(F.col("a")) & (F.col("block_index") == F.col("i"))
    found = blocks.select("article_id", "block_index", "block_text").join(met, same).where(F.instr("block_text", F.col("needle")) > 0)
    s = find_selector(F.col("block_text"), F.col("needle"))
    return found.select("article_id", "block_index", "item_id", s.alias("s"), "block_text").select("article_id", "block_index", "item_id", "s.*", "block_text")


def repair(found: Column, exact: Column, prefix: Column, suffix: Column, checked: Column) -> Column:
    """ok, repaired (the quote in its context occurs exactly once in the article text `found`) or quote_not_found."""
    around = F.concat(F.coalesce(prefix, F.lit("")), exact, F.coalesce(suffix, F.lit("")))
    times = F.floor((F.length(found) - F.length(F.replace(found, around, F.lit("")))) / F.length(around))
    return F.when(checked == "ok", "ok").when(times == 1, "repaired").otherwise("quote_not_found")


def to_json(start: Column, end: Column, exact: Column, prefix: Column, suffix: Column, xpath: Column) -> Column:
    """The W3C selector as JSON; null fields are left out."""
    return F.to_json(
        F.struct(
            F.lit("XPathSelector").alias("type"), xpath.alias("value"),
            F.struct(F.lit("TextPositionSelector").alias("type"), start.alias("start"), end.alias("end")).alias("refinedBy"),
            F.struct(exact.alias("exact"), prefix.alias("prefix"), suffix.alias("suffix")).alias("quote"),
        )
    )
