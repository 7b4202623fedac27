"""Audits: coverage and fidelity of blocks against captures, recurring lines, invariants, recall and precision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.functions.text import tokens


def token_overlap(blocks: DataFrame, captures: DataFrame, key: str, floor: float = 0.8) -> DataFrame:
    """Share of each block's distinct words that its capture's text holds; suspect below the floor with two words missing."""
    b = blocks.select(key, "block_index", F.explode(F.array_distinct(tokens("block_text"))).alias("word"))
    c = captures.select(key, F.explode(F.array_distinct(tokens("capture_text"))).alias("word")).withColumn("there", F.lit(1))
    out = b.join(c, [key, "word"], "left").groupBy(key, "block_index").agg(F.count("*").alias("n_words"), F.count("there").alias("n_found"))
    return _suspects(out, floor)


def row_overlap(pages: DataFrame, key: str, floor: float = 0.8) -> DataFrame:
    """`token_overlap` of (key, texts, capture_text) with unique keys, texts being the blocks: words meet in the row, and two sums a block are shuffled.

    A null key has no capture, as in a join. Words of blocks and capture are sorted with their block's index, the capture's as 0; a run of one word that begins with 0 is found.
    """
    word = lambda w, i: F.struct(w.alias("word"), i.cast("int").alias("at"))
    told = lambda i, words, found: F.struct(i.cast("int").alias("block_index"), words.cast("long").alias("n_words"), found.cast("long").alias("n_found"))
    words = F.transform("texts", lambda t: F.array_distinct(tokens(t)))
    mine = F.flatten(F.transform("words", lambda ws, i: F.transform(ws, lambda w: word(w, i + 1))))
    theirs = F.transform(F.array_distinct(tokens(F.when(F.col(key).isNotNull(), F.col("capture_text")).otherwise(""))), lambda w: word(w, F.lit(0)))
    starts = F.filter(F.transform("all", lambda x, i: F.when((i == 0) | (x["word"] != F.get("all", i - 1)["word"]), i)), lambda i: i.isNotNull())
    end = lambda k: F.coalesce(F.get("starts", k + 1), F.size("all"))
    run = lambda at, k: F.slice("all", at + 2, F.when(F.get("all", at)["at"] == 0, end(k) - at - 1).otherwise(0))
    found = F.transform(F.flatten(F.transform("starts", run)), lambda x: told(x["at"], F.lit(0), F.lit(1)))
    own = F.filter(F.transform("words", lambda ws, i: told(i + 1, F.size(ws), F.lit(0))), lambda x: x["n_words"] > 0)
    rows = pages.select(key, words.alias("words"), "capture_text").select(key, "words", F.array_sort(F.concat(mine, theirs)).alias("all"))
    rows = rows.select(key, "words", "all", starts.alias("starts")).select(key, F.explode(F.concat(own, found)).alias("t")).select(key, "t.*")
    return _suspects(rows.groupBy(key, "block_index").agg(F.sum("n_words").alias("n_words"), F.sum("n_found").alias("n_found")), floor)


def _suspects(counted: DataFrame, floor: float) -> DataFrame:
    ratio = F.round(F.col("n_found") / F.col("n_words"), 6)
    return counted.withColumn("overlap", ratio).withColumn("suspect", (F.col("overlap") < floor) & (F.col("n_words") - F.col("n_found") >= 2))


def recurring(blocks: DataFrame, group: str, least: int = 5) -> DataFrame:
    """Lines seen in `least` or more articles of a group: boilerplate of that outlet."""
    return blocks.groupBy(group, F.md5("block_text").alias("line")).agg(F.count_distinct("article_id").alias("articles"), F.min("block_text").alias("sample")).where(F.col("articles") >= least)


def contiguity(rows: DataFrame, key: str, index: str, first: int) -> DataFrame:
    """Keys whose indexes are not first, first + 1, ... without gap or repeat."""
    out = rows.groupBy(key).agg(F.min(index).alias("lo"), F.max(index).alias("hi"), F.count("*").alias("n"), F.count_distinct(index).alias("d"))
    return out.where((F.col("lo") != first) | (F.col("hi") - F.col("lo") + 1 != F.col("n")) | (F.col("d") != F.col("n")))


def compare(found: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """Recall and precision of one id set against another."""
    both = found.select(key).distinct().withColumn("f", F.lit(1)).join(truth.select(key).distinct().withColumn("t", F.lit(1)), key, "full")
    n = lambda c: F.count_if(c)
    out = both.agg(n(F.col("f").isNotNull()).alias("n_found"), n(F.col("t").isNotNull()).alias("n_truth"), n(F.col("f").isNotNull() & F.col("t").isNotNull()).alias("n_both"))
    share = lambda a: F.when(F.col(a) > 0, F.round(F.col("n_both") / F.col(a), 6))
    return out.select("*", share("n_truth").alias("recall"), share("n_found").alias("precision"))


def violations(rows: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """(key, rule) for every row that breaks a rule; a rule is a SQL condition that must hold (null breaks it)."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(cond), F.lit(False)), F.lit(name)) for name, cond in rules.items()]))
    return rows.select(F.col(key), F.explode(broken).alias("rule"))
