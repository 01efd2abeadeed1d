"""Approximate nearest neighbours by a forest of hash prefixes (LSH forest).

Each tree hashes a vector to a long string of bits, the sides of random hyperplanes, and
keeps the strings as a sorted array: a prefix is a range of it. A query descends in each
tree to the longest prefix that it shares; then all trees ascend together, one bit at a
time, until the ranges of their common length hold enough entries. The vectors found are
ranked by their exact inner products.

Rows are cut into blocks, each with its own forest, and queries too: one task joins a
block of rows with a block of queries, so memory is bounded and no task sees all rows.
A block of queries is the larger one, so that the trees of a block of rows, which each
task makes for itself, serve many.
Equal vectors are one entry with the smallest ids that any query can need.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from samplewright.llm.shared import written

_U = np.uint64


@dataclass(frozen=True)
class Forest:
    """trees and bits of each string; entries: what each tree's range must hold on average.

    Each query's ascent ends at the longest common length at which its ranges in all
    trees hold trees * entries entries, repeats counted; there is no upper cap. One tree
    at least then holds `entries` different rows, so keep it over k. Rows and queries:
    those of a block.
    """

    trees: int = 96
    bits: int = 32
    entries: int = 48
    rows: int = 8192
    queries: int = 16384


class PrefixTrees:
    """The sorted strings of a block's vectors, for each tree."""

    def __init__(self, vectors: np.ndarray, forest: Forest) -> None:
        self.forest, self.n = forest, len(vectors)
        # one more component makes all vectors as long as the longest; inner products then order like angles
        lengths = (vectors**2).sum(axis=1)
        self.longest = float(lengths.max(initial=0.0))
        lifted = np.column_stack([vectors, np.sqrt(np.maximum(self.longest - lengths, 0))])
        self.planes = np.random.default_rng(5).standard_normal((forest.trees, lifted.shape[1], forest.bits))
        strings = self._strings(lifted)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def _strings(self, lifted: np.ndarray) -> np.ndarray:
        weights = _U(1) << np.arange(self.forest.bits, dtype=_U)[::-1]
        return np.array([((lifted @ plane) > 0) @ weights for plane in self.planes], _U).reshape(self.forest.trees, len(lifted))

    def _ranges(self, strings: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tree and query the range of strings that share the query's first `level` bits."""
        cut = _U(self.forest.bits) - level.astype(_U)
        low = (strings >> cut) << cut
        high = low + (_U(1) << cut)
        first, last = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(self.forest.trees):
            first[t] = np.searchsorted(self.sorted[t], low[t])
            last[t] = np.searchsorted(self.sorted[t], high[t])
        return first, last

    def candidates(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges in which the trees' common ascent ends for each query."""
        strings = self._strings(np.column_stack([queries, np.zeros(len(queries))]))
        enough = min(self.forest.entries, self.n) * self.forest.trees
        # the longest common length with enough entries: they grow as it shrinks
        reach, beyond = np.zeros(len(queries), np.int64), np.full(len(queries), self.forest.bits + 1)
        while (beyond - reach > 1).any():
            level = (reach + beyond) // 2
            first, last = self._ranges(strings, level)
            full = (last - first).sum(axis=0) >= enough
            reach, beyond = np.where(full, level, reach), np.where(full, beyond, level)
        return self._ranges(strings, reach)


def search_block(ids: np.ndarray, vectors: np.ndarray, queries: np.ndarray, k: int, forest: Forest) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query places and scores of its k best entries, best first, ties to the smaller id."""
    trees = PrefixTrees(vectors, forest)
    first, last = trees.candidates(queries)
    out = []
    for q, query in enumerate(queries):
        hit = np.zeros(len(ids), bool)
        for t in range(forest.trees):
            hit[trees.order[t, first[t, q] : last[t, q]]] = True
        found = np.flatnonzero(hit)
        scores = vectors[found] @ query
        if found.size > k:
            least = np.partition(scores, found.size - k)[found.size - k]
            near = scores >= least
            found, scores = found[near], scores[near]
        best = np.lexsort((ids[found], -scores))[:k]
        out.append((found[best], scores[best]))
    return out


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20, forest: Forest = Forest(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), key and score of the k nearest rows found for each row of `queries`.

    score: inner product in double precision; the largest is nearest; ties go to the
    smaller key. A query's own key is no candidate. Both tables have key and vector;
    rows whose key is null or whose vector is unusable take no part, and vectors meet
    only those of their own length. Repeated rows count once. With fewer candidates than
    k a query gets them all. An empty table gives no rows.
    """
    same = lambda df: df.select(F.col(key).cast("long").alias("id"), F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("v")).where(F.col("id").isNotNull() & usable(F.col("v")))
    # of equal vectors only the k + 1 smallest ids can be wanted; each task drops the others before the shuffle
    smallest = Window.partitionBy("v").orderBy("id")
    few = same(rows).distinct().withColumn("_n", F.row_number().over(smallest)).where(F.col("_n") <= k + 1)
    entries = written(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0]), "vectors")
    asked = same(queries).distinct()
    heads = written(asked.groupBy("v").agg(F.min("id").alias("head")), "queries")
    row_blocks = max(1, -(-entries.count() // forest.rows))
    query_blocks = max(1, -(-heads.count() // forest.queries))

    def dealt(df: DataFrame, own: str, by: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(by), F.lit(own_blocks)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)))).withColumn("dims", F.size("v"))

    left = dealt(entries.select("id", "ids", "v"), "_row_block", "id", row_blocks, "_query_block", query_blocks)
    right = dealt(heads, "_query_block", "head", query_blocks, "_row_block", row_blocks)
    block = ["dims", "_row_block", "_query_block"]

    def joined(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame({"head": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object), "score": pd.Series(dtype="float64")})
        mine = mine.sort_values("id", ignore_index=True)
        ids, vectors = mine["id"].to_numpy(), np.stack(mine["v"].to_numpy())
        found = search_block(ids, vectors, np.stack(theirs["v"].to_numpy()), k + 1, forest)
        places = np.concatenate([p for p, _ in found])
        return pd.DataFrame({"head": np.repeat(theirs["head"].to_numpy(), [len(p) for p, _ in found]), "id": ids[places], "ids": mine["ids"].to_numpy()[places], "score": np.concatenate([s for _, s in found])})

    found = left.groupBy(*block).cogroup(right.groupBy(*block)).applyInPandas(joined, "head long, id long, ids array<long>, score double")
    best = Window.partitionBy("head").orderBy(F.col("score").desc(), "id")
    # entries before which k + 1 ids stand already can't be wanted
    before = F.coalesce(F.sum(F.size("ids")).over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).withColumn("_before", before).where(F.col("_before") <= k)
    top = written(top.groupBy("head").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "ids"))).alias("top")), "found")
    members = asked.join(heads, "v").select(F.col("id").alias("query_id"), "head")
    each = members.join(top, "head").select("query_id", F.explode("top").alias("t")).select("query_id", (-F.col("t.less")).alias("score"), F.explode("t.ids").alias(key)).where(F.col(key) != F.col("query_id"))
    ranked = each.groupBy("query_id").agg(F.sort_array(F.collect_set(F.struct((-F.col("score")).alias("less"), F.col(key).alias("near")))).alias("all"))
    return ranked.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("place", "t")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("t.near").alias(key), (-F.col("t.less")).alias("score"))
