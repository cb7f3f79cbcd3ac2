"""Grouping from the bottom up by average linkage over sparse unit vectors, without an n x n matrix.

A cluster is the sum of its members' vectors and their number, so that the average
similarity of two clusters is one product of sums over the entries they share. Average
linkage never makes a merged cluster nearer to a third than both parts were, so all pairs
that are each other's nearest may merge at once and give the tree that merging one pair
after another gives.

Each round finds the pairs above a similarity that falls level by level. Entries are
ranked from rare to frequent, and a cluster looks for partners only under its rare ones,
up to where the rest is too short to reach the level; so frequent entries come into play
when there are few clusters left. Rounds are written tables. The last ``few`` clusters are
merged on the driver in the same way, from their few * few / 2 similarities.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import stage

LEVELS = (0.95, 0.9, 0.8, 0.6, 0.45, 0.3, 0.2, 0.1, 0.05, 0.0)
ANY = -2.0
FEW = 2048
MERGES = "a bigint, b bigint, sim double, step bigint"


def similar_pairs(vectors: DataFrame, sizes: DataFrame, level: float) -> DataFrame:
    """Pairs (a, b, sim) of clusters with a < b that share an entry and whose average similarity is ``level`` at least."""
    centroids = vectors.join(sizes, "c").select("c", "gram", (F.col("s") / F.col("n")).alias("w"))
    one = centroids.select(F.col("c").alias("a"), "gram", F.col("w").alias("wa"))
    two = centroids.select(F.col("c").alias("b"), "gram", F.col("w").alias("wb"))
    if level > 0:
        spread = vectors.groupBy("gram").agg(F.count("*").alias("clusters"))
        rest = Window.partitionBy("c").orderBy(F.desc("clusters"), F.desc("gram")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = centroids.join(spread, "gram").withColumn("rest", F.sqrt(F.sum(F.col("w") * F.col("w")).over(rest)))
        # a little below the level, as roots are rounded
        prefix = ranked.where(F.col("rest") >= level - 1e-9)
        left, right = prefix.select(F.col("c").alias("a"), "gram"), prefix.select(F.col("c").alias("b"), "gram")
        meet = left.join(right, "gram").where("a < b").select("a", "b").distinct()
        met = meet.join(one, "a").join(two, ["b", "gram"])
    else:
        met = one.join(two, "gram").where("a < b")
    products = met.groupBy("a", "b").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 12).alias("sim"))
    return products.where(F.col("sim") >= level)


def reciprocal(pairs: DataFrame) -> DataFrame:
    """The pairs that are each other's nearest; of equally near ones that of the smaller numbers."""
    place = F.struct((-F.col("sim")).alias("far"), "a", "b")
    nearest = pairs.select(F.explode(F.array("a", "b")).alias("c"), place.alias("place")).groupBy("c").agg(F.min("place").alias("place"))
    both = nearest.groupBy("place").agg(F.count("*").alias("n")).where("n = 2")
    return both.select("place.a", "place.b", (-F.col("place.far")).alias("sim"))


def _merged(rows: DataFrame, into: DataFrame, value: str, *keys: str) -> DataFrame:
    named = rows.join(into, "c", "left").withColumn("c", F.coalesce("into", "c"))
    return named.groupBy("c", *keys).agg(F.sum(value).alias(value))


def _last_merges(nodes: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, sim: np.ndarray, step: int) -> list[tuple[int, int, float, int]]:
    """Merges of few clusters by their similarities, all pairs that are each other's nearest at once; 0 where no pair is given."""
    n = len(nodes)
    sizes = sizes.astype(float)
    total = np.zeros((n, n))
    i, j = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    total[i, j] = total[j, i] = sim * sizes[i] * sizes[j]
    out: list[tuple[int, int, float, int]] = []
    while n > 1:
        near = np.round(total / np.outer(sizes, sizes), 12)
        np.fill_diagonal(near, -np.inf)
        # the first of equally near ones
        best = near.argmax(axis=1)
        low = np.flatnonzero((best[best] == np.arange(n)) & (np.arange(n) < best))
        high = best[low]
        out += [(int(x), int(y), float(s), step) for x, y, s in zip(nodes[low], nodes[high], near[low, high])]
        total[low] += total[high]
        total[:, low] += total[:, high]
        sizes[low] += sizes[high]
        stay = np.ones(n, bool)
        stay[high] = False
        total, sizes, nodes = total[np.ix_(stay, stay)], sizes[stay], nodes[stay]
        n, step = len(nodes), step + 1
    return out


def merge_tree(vectors: DataFrame, sizes: DataFrame, few: int = FEW) -> DataFrame:
    """All merges (a, b, sim, step) of clusters b into a < b, one less than there are clusters.

    ``vectors`` has (c, gram, s), the sums of the members' unit vectors, ``sizes`` (c, n).
    """
    spark: SparkSession = vectors.sparkSession
    vectors, sizes = stage(vectors, "cluster-vectors"), stage(sizes, "cluster-sizes")
    rounds: list[DataFrame] = []
    level = 0
    while sizes.count() > few and level < len(LEVELS):
        found = stage(reciprocal(similar_pairs(vectors, sizes, LEVELS[level])), "cluster-merges")
        if found.isEmpty():
            level += 1
            continue
        rounds.append(found.withColumn("step", F.lit(len(rounds)).cast("bigint")))
        into = found.select(F.col("b").alias("c"), F.col("a").alias("into"))
        vectors, sizes = stage(_merged(vectors, into, "s", "gram"), "cluster-vectors"), stage(_merged(sizes, into, "n"), "cluster-sizes")
    step = len(rounds)
    if level == len(LEVELS):
        # nothing that is left shares an entry
        least = sizes.agg(F.min("c")).scalar()
        rounds.append(sizes.where(F.col("c") != least).select(least.alias("a"), F.col("c").alias("b"), F.lit(0.0).alias("sim"), F.lit(step).cast("bigint").alias("step")))
    else:
        # few rows, and few * few / 2 pairs
        own = sizes.select("c", "n").toArrow().sort_by("c")
        pairs = similar_pairs(vectors, sizes, ANY).toArrow()
        last = _last_merges(*(own.column(c).to_numpy().copy() for c in ("c", "n")), *(pairs.column(c).to_numpy() for c in ("a", "b", "sim")), step)
        rounds.append(spark.createDataFrame(last, MERGES))
    return reduce(DataFrame.unionByName, rounds)


def cut_tree(nodes: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """Nodes (c) with ``cluster_id``, the smallest number of their cluster, when the ``k`` - 1 farthest merges are undone."""
    far = merges.orderBy("sim", F.desc("step"), F.desc("b")).limit(k - 1).select("b")  # k is small
    up = stage(merges.join(F.broadcast(far), "b", "left_anti").select(F.col("b").alias("c"), F.col("a").alias("up")), "cluster-tree")
    while True:
        # each round doubles how far a node sees
        above = up.select(F.col("c").alias("up"), F.col("up").alias("top"))
        wider = stage(up.join(above, "up", "left").select("c", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "cluster-tree")
        up = wider.select("c", "up")
        if wider.where("moved").isEmpty():
            break
    return nodes.select("c").join(up, "c", "left").select("c", F.coalesce("up", "c").alias("cluster_id"))
