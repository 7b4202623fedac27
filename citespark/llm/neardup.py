"""Near-duplicate removal: SimHash candidates from a grid range-join, groups decided by exact shingle similarity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.llm.common import forget, packed, store, unpacked
from citespark.llm.shingles import codes, shingle_hashes
from citespark.llm.simhash import code_groups

#: A block of a candidate group: at most about so many texts and bytes are settled at once. Larger groups go in several blocks, round by round.
GROUP_TEXTS, GROUP_BYTES = 2048, 8 << 20
#: Words of 64 bits of a text's code.
WORDS = 5
#: Codes of similar texts differ in about 15 % of their bits at similarity 0.8; beyond 30 % no two texts of MANY shingles are compared.
FAR, MANY = int(0.3 * 64 * WORDS), 32


def code_column(text, shingle: int, words: int = WORDS):
    """The SimHash code (array of longs) of a text column."""

    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for at in range(0, len(texts), 1024):
            out += list(codes(shingle_hashes(list(texts.iloc[at : at + 1024]), shingle), words).view(np.int64))
        return pd.Series(out)

    return of(text)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the Jaccard similarity of two sorted sets of hashes is at least `least`."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) < least * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both >= least * (len(a) + len(b) - both)


def redundant(texts: list[str | None], shingle: int, least: float) -> np.ndarray:
    """Which texts are similar to one before them that is not itself so."""
    gone = np.zeros(len(texts), bool)
    sets = shingle_hashes(texts, shingle)
    code = codes(sets, WORDS)
    size = np.array([len(s) for s in sets])
    kept = np.zeros(len(texts), np.int64)
    n = 0
    for i in range(len(texts)):
        before = kept[:n]
        near = (np.minimum(size[before], size[i]) >= least * np.maximum(size[before], size[i])) & ((np.bitwise_count(code[before] ^ code[i]).sum(1) <= FAR) | (size[before] < MANY))
        if any(similar(sets[i], sets[j], least) for j in before[near].tolist()):
            gone[i] = True
        else:
            kept[n] = i
            n += 1
    return gone


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, least: float = 0.8, group_texts: int = GROUP_TEXTS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """`docs` without copies: of equal texts, and of texts similar to one before them, the one of smallest doc_id stays.

    Similar: Jaccard similarity of the sets of word shingles of at least `least`. Candidates are texts connected through
    SimHash codes that `code_groups` joins (320 bits; at similarity 0.8 a pair meets with a probability of 0.99, above it with more). In a
    candidate group texts stand by doc_id, and one goes if it is similar to one before it that stays. Groups above
    `group_texts` texts or `group_bytes` are dealt into blocks by hash; what is left of each block meets in the next round, after
    candidates were searched anew among all that is left, and pairs of blocks meet where a round wears nothing down. So
    no two candidates that stay are similar, the first of a group stays, and none goes without a similar text before it.

    Null and empty texts are one text. Null doc_ids come last. Rows that repeat doc_id and text leave one (any of them, where other
    columns differ). An empty table gives an empty result. All columns are kept, whatever their names.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"), digest=F.md5(F.encode(whole, "UTF-8")), text=whole)
    coded = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("bytes"), code_column("text", shingle).alias("code"))
    texts = store(coded.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bytes").alias("bytes"), F.first("code").alias("code")))
    gone = _worn_down(rows, texts, shingle, least, group_texts, group_bytes)
    keep = store(texts.select("digest", "doc_id").join(gone, "digest", "left_anti"))
    forget(texts), forget(gone)
    stay = keep.select(F.col("digest").alias("of"), F.col("doc_id").alias("id"))
    left = rows.drop("text").join(stay, (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    # rows that repeat both doc_id and text are rare: only they are shuffled once more
    again = store(rows.groupBy("doc_id", "digest").count().where("count > 1").select(F.col("doc_id").alias("id"), F.col("digest").alias("of")))
    if not again.isEmpty():
        twice = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of"))
        left = left.join(again, twice, "left_anti").unionByName(left.join(again, twice, "left_semi").groupBy("doc_id", "digest").agg(F.first("row").alias("row")))
    return unpacked(left, docs.columns)


def _grouped(left: DataFrame) -> DataFrame:
    """`left` (digest, doc_id, bytes, code) with the root of its candidate group, groups of one left out."""
    nodes = store(left.groupBy(F.col("code")[0].alias("fp")).agg(F.first("code").alias("code"), F.count("*").alias("n")))
    groups = store(code_groups(nodes.select("fp", "code"), WORDS))
    several = nodes.where("n > 1").select(F.col("fp").alias("node"), F.col("fp").alias("root"))
    roots = groups.unionByName(several.join(groups, "node", "left_anti"))
    out = store(left.join(roots, F.col("code")[0] == F.col("node")).select("root", "digest", "doc_id", "bytes", "code"))
    forget(nodes), forget(groups)
    return out


def _worn_down(rows: DataFrame, texts: DataFrame, shingle: int, least: float, group_texts: int, group_bytes: int) -> DataFrame:
    """digest of each text of (digest, doc_id, bytes, code) that goes."""

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "digest"], na_position="last")
        return pd.DataFrame({"digest": frame.digest[redundant(list(frame.text), shingle, least)]})

    parts: list[DataFrame] = []
    left, step, pairs, before = texts, 0, False, None
    while True:
        found = _grouped(left)
        sizes = found.groupBy("root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        blocks = F.greatest(F.ceil(F.col("n") / group_texts), F.ceil(F.col("bytes") / group_bytes), F.lit(1)).cast("long")
        sizes = store(sizes.select("root", "n", F.when(F.col("n") == 1, 1).otherwise(blocks).alias("blocks")))
        placed = found.join(sizes.where("n > 1"), "root").withColumn("block", F.pmod(F.xxhash64("digest", F.lit(step)), F.col("blocks")))
        if pairs:  # every pair of blocks of a group that will not shrink
            placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("with != block or blocks = 1")
            placed = placed.withColumn("block", F.least("block", "with") * F.lit(1 << 24) + F.greatest("block", "with"))
        wanted = placed.select("root", "block", F.col("digest").alias("of"), F.col("doc_id").alias("id"))
        meet = rows.select("digest", "doc_id", "text").join(wanted, (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
        meet = meet.groupBy("root", "block", "digest", "doc_id").agg(F.first("text").alias("text"))
        now = store(meet.groupBy("root", "block").applyInPandas(settle, "digest string").distinct())
        parts.append(now)
        large = store(found.join(sizes.where("blocks > 1").select("root"), "root").drop("root").join(now, "digest", "left_anti"))
        count = large.count()
        forget(found), forget(sizes)
        if not count or pairs:
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            return store(out)
        left, step, pairs, before = large, step + 1, before is not None and count > 0.9 * before, count
