"""Approximate nearest neighbours by cosine: hierarchical k-means tree, best-bin-first search, calibrated widening."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citespark.llm.common import store

#: Rows of one leaf that one task compares with queries at a time; larger leaves are split by a hash of vec_id.
LEAF_ROWS = 4096


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    scale = np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


class Tree:
    """Nested k-means on the unit sphere. Node 0 is the root; children of an inner node have a centre each."""

    def __init__(self, sample: np.ndarray, branch: int, leaf_size: int, rounds: int = 12, seed: int = 7):
        self.children: list[list[int]] = [[]]
        self.centres: list[np.ndarray | None] = [None]
        random = np.random.default_rng(seed)
        todo = [(0, sample)]
        while todo:
            node, x = todo.pop()
            if len(x) <= leaf_size:
                continue
            c = x[random.choice(len(x), min(branch, len(x)), replace=False)]
            for _ in range(rounds):
                near = (x @ c.T).argmax(1)
                c = np.array([x[near == k].mean(0) if (near == k).any() else x[random.integers(len(x))] for k in range(len(c))])
                c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300)
            near = (x @ c.T).argmax(1)
            used = np.unique(near)
            if len(used) < 2:  # copies of one vector: nothing to split
                continue
            self.centres[node] = c[used]
            for k in used:
                self.children[node].append(len(self.children))
                self.children.append([])
                self.centres.append(None)
                todo.append((self.children[node][-1], x[near == k]))

    @property
    def leaves(self) -> list[int]:
        return [n for n, c in enumerate(self.children) if not c]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector. Equal vectors get equal leaves: sums run in a fixed order, row by row."""
        node = np.zeros(len(x), np.int64)
        for n, kids in enumerate(self.children):  # parents come before children
            here = np.flatnonzero(node == n) if kids else ()
            if len(here):
                score = np.stack([(x[here] * c).sum(axis=1) for c in self.centres[n]], axis=1)
                node[here] = np.array(kids)[score.argmax(1)]
        return node

    def best_first(self, q: np.ndarray):
        """Leaves in best-bin-first order: a priority queue of branches by the cosine of their centres."""
        queue = [(-2.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                yield node
                continue
            for kid, s in zip(kids, (self.centres[node] * q).sum(axis=1).tolist()):
                heapq.heappush(queue, (-s, kid))


def calibrate(tree: Tree, sample: np.ndarray, k: int, recall: float, probes: int = 256) -> int:
    """Fewest leaf visits whose recall at k reaches `recall` for sample vectors against the whole sample, by brute force."""
    probes = min(probes, len(sample))
    queries = sample[:probes]
    leaf = tree.assign(sample)
    score = queries @ sample.T
    score[np.arange(probes), np.arange(probes)] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(tree.leaves)
    kth = np.sort(score, axis=1)[:, -k]
    visits = []
    for i in range(probes):
        order = {n: r for r, n in enumerate(tree.best_first(queries[i]), 1)}
        # copies tie: of those as near as the k-th any will do
        wanted = np.flatnonzero(score[i] >= kth[i] - 1e-12)
        visits.append(np.sort([order[leaf[j]] for j in wanted])[:k])
    every = np.concatenate(visits)
    for n in range(1, len(tree.leaves) + 1):
        if (every <= n).mean() >= recall:
            return n
    return len(tree.leaves)


def valid_vectors(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part: no nulls, finite, not zero, of the most frequent length (ties: the longer)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite).where(F.exists("embedding", lambda x: x != 0))
    size = ok.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return ok.where(F.size("embedding") == (size["n"] if size else -1)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))


def _top(own: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """The k rows of largest cosine for each query: a matrix product selects, exact sums decide and rank."""
    unit_q, unit_x = _unit(q), _unit(x)
    norm_x = np.sqrt((x * x).sum(axis=1))
    out = []
    for at in range(0, len(q), 256):
        rough = unit_q[at : at + 256] @ unit_x.T
        rough[own[at : at + 256, None] == ids[None, :]] = -np.inf
        least = np.partition(rough, max(rough.shape[1] - k, 0), axis=1)[:, max(rough.shape[1] - k, 0)]
        for i in range(len(rough)):
            some = np.flatnonzero((rough[i] >= least[i] - 1e-9) & (rough[i] > -np.inf))
            v = q[at + i]
            score = (x[some] * v).sum(axis=1) / (np.sqrt((v * v).sum()) * norm_x[some])
            for j in np.lexsort((ids[some], -score))[:k]:
                out.append((own[at + i], ids[some[j]], score[j]))
    return out


def nearest(rows: DataFrame, every: int = 50, k: int = 5, recall: float = 0.98, sample: int = 20_000, branch: int = 8, leaf_size: int = 100, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The k nearest of each query by cosine: query_id, rank, vec_id, score.

    Queries are the rows of (vec_id, embedding) whose vec_id is divisible by `every`; candidates are all rows but those of
    the query's own vec_id. The tree is fitted on `sample` rows (those of smallest hashed vec_id; a documented bound) and every row is put in
    a leaf of it. Leaf visits widen until recall on the sample reaches `recall`, and beyond while fewer than k
    candidates are met. Leaves of more than `leaf_rows` rows are split over tasks.

    Null, zero and non-finite vectors take no part, nor do rows of null vec_id or of another length than the most
    frequent. Ties go to the smaller vec_id. Repeated rows are candidates each; a repeated query is searched once, by the
    smallest of its vectors. Fewer than k candidates give fewer rows; an empty table gives an empty result. Other columns are ignored.
    """
    spark = rows.sparkSession
    rows = valid_vectors(rows.select("vec_id", "embedding"))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    tree = Tree(_unit(np.stack(picked.embedding)) if len(picked) else np.zeros((0, 1)), branch, leaf_size)
    shared = spark.sparkContext.broadcast(tree)  # grows with `sample` only

    @F.pandas_udf("long")
    def leaf_of(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value.assign(_unit(np.stack(v))) if len(v) else np.zeros(0, np.int64))

    index = store(rows.withColumn("leaf", leaf_of("embedding")))
    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # one row per leaf of the tree
    visits = calibrate(tree, _unit(np.stack(picked.embedding)), k, recall) if len(picked) else 1

    @F.pandas_udf("array<long>")
    def plan(v: pd.Series) -> pd.Series:
        out = []
        for q in _unit(np.stack(v)) if len(v) else ():
            leaves, met = [], 0
            for n, leaf in enumerate(shared.value.best_first(q)):
                if n >= visits and met > k:
                    break
                if sizes.get(leaf):
                    leaves.append(leaf)
                    met += sizes[leaf]
            out.append(leaves)
        return pd.Series(out)

    large = F.broadcast(spark.createDataFrame([(leaf, -(-n // leaf_rows)) for leaf, n in sizes.items() if n > leaf_rows], "leaf long, blocks long"))  # one row per leaf at most
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    placed = index.join(large, "leaf", "left").withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks)).drop("blocks")
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = queries.select("vec_id", "embedding", F.explode(plan("embedding")).alias("leaf"))
    asked = asked.join(large, "leaf", "left").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).drop("blocks")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            found = _top(left.vec_id.to_numpy(), np.stack(left.embedding), right.vec_id.to_numpy(), np.stack(right.embedding), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    some = asked.groupBy("leaf", "block").cogroup(placed.groupBy("leaf", "block")).applyInPandas(search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return some.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
