"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import packed, running_totals, store, unpacked, word_count


def source_targets(sized: DataFrame, weights=(1, 2, 3), cap: int = 3) -> DataFrame:
    """Per source of (source, size): rank, source_size and its target in words.

    Sources rank by code point, null last; weights repeat along the ranks. The targets share the
    sum of all sizes by weight; one stops at `cap` times its source's size and the excess is shared
    anew by weight until none is above. With the sources ordered by cap/weight, those before the
    first that its share does not exceed are capped: two running totals find it, no iteration.
    """
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = running_totals(
        src.select(F.lit(0).alias("all"), F.col("source").isNull().alias("none"), "source", "source_size", F.lit(1).cast("long").alias("one")),
        ["all"], ["none", "source"], {"one": "rank"},
    )
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    src = src.withColumn("cap", F.col("source_size") * cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    src = store(running_totals(src, ["all"], ["ratio", "rank"], {"cap": "cap_before", "weight": "weight_before", "one": "k"}))
    total = src.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w"))
    share = ((F.col("t") - F.col("cap_before")) / (F.col("w") - F.col("weight_before"))).alias("share")
    level = (
        src.crossJoin(F.broadcast(total))  # one row of totals
        .select("k", "cap", "weight", share)
        .where(F.col("cap") >= F.col("weight") * F.col("share"))
        .agg(F.min(F.struct("k", "share")).alias("level"))
    )
    return src.crossJoin(F.broadcast(level)).select(  # one row
        "source", "rank", "source_size",
        F.when(F.col("k") < F.col("level.k"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level.share")).alias("target"),
    )


def mix(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, seed: str = "mix", carry: dict | None = None) -> DataFrame:
    """Words that a mix takes of each document of (doc_id, text, source).

    Result: doc_id, source, size, source_size, target, taken. Inside each source documents stand in
    the order of md5(seed + doc_id); whole epochs are taken while the budget (the rounded target)
    holds them, then documents in that order up to the exact budget, the last one in part. So a
    source's taken words equal its rounded target, and no document exceeds `cap` times its size.

    `carry` names further columns (expressions over `docs`) to keep.

    Null or blank texts have size 0 and take 0. A null source is a source of its own, ranked last.
    Repeated rows count each; rows that tie in every column are interchangeable. An empty table
    gives an empty result. Other columns of `docs` are ignored.
    """
    sized = store(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *[c.alias(n) for n, c in (carry or {}).items()]))
    targets = store(source_targets(sized, weights, cap))
    budget = F.floor(F.col("target") + 0.5)
    per = targets.select(
        F.col("source").alias("__source"), "rank", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long").alias("epochs"),
        budget.cast("long").alias("budget"),
    )
    keyed = sized.join(per, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    keyed = keyed.withColumn("key", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    placed = running_totals(keyed, ["rank"], ["key", "doc_id", "size"], {"size": "before"})
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select("doc_id", "source", "size", "source_size", "target", *(carry or {}), (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), cap: int = 3, seed: str = "mix") -> DataFrame:
    """Every row of `docs` as often as `mix` takes it, a part counting as a whole; those of which it takes no word go.

    Rows that repeat doc_id and text share what was taken of them. Nulls as in `mix`. An empty table gives an empty result. All
    columns are kept, whatever their names.
    """
    digest = F.md5(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8"))
    taken = mix(docs.select("doc_id", "text", "source"), weights, cap, seed, carry={"digest": digest})
    times = F.ceil(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).cast("int")
    per = store(taken.groupBy("doc_id", "digest").agg(times.alias("times")).where("times > 0").withColumnsRenamed({"doc_id": "id", "digest": "of"}))
    rows = packed(docs, doc_id=F.col("doc_id"), digest=digest)
    joined = rows.join(per, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")))
    return unpacked(joined.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("times")))), docs.columns)
