"""Average linkage in rounds of tables against merging one pair after another."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termtide.operators import cluster, linkage


def brute(vectors, sizes, k):
    """Clusters as sets of numbers: the nearest pair merges until ``k`` are left."""
    groups = {c: [c] for c in sizes}
    unit = {c: vectors.get(c, {}) for c in sizes}
    dot = lambda a, b: sum(w * unit[b].get(g, 0.0) for g, w in unit[a].items())
    sims = {(a, b): dot(a, b) for a, b in itertools.combinations(sorted(sizes), 2)}

    def near(a, b):
        return sum(sizes[x] * sizes[y] * sims[min(x, y), max(x, y)] for x in groups[a] for y in groups[b]) / (sum(sizes[x] for x in groups[a]) * sum(sizes[y] for y in groups[b]))

    while len(groups) > k:
        a, b = max(itertools.combinations(sorted(groups), 2), key=lambda p: (round(near(*p), 12), -p[0], -p[1]))
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups.values()}


def table(spark, seed, n, entries):
    rng = random.Random(seed)
    vectors, sizes = {}, {}
    for c in range(n):
        grams = rng.sample(range(entries), rng.randint(1, 5)) if c % 9 else []
        raw = {f"g{g}": rng.random() + 0.05 for g in grams}
        norm = sum(w * w for w in raw.values()) ** 0.5
        vectors[c], sizes[c] = {g: w / norm for g, w in raw.items()}, rng.choice([1, 1, 2, 7])
    rows = [(c, g, w * sizes[c]) for c, own in vectors.items() for g, w in own.items()]
    return vectors, sizes, spark.createDataFrame(rows, "c long, gram string, s double"), spark.createDataFrame(list(sizes.items()), "c long, n long")


def groups_of(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.cluster_id, set()).add(r.c)
    assert all(c == min(own) for c, own in found.items())
    return {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("few", [200, 6])
def test_rounds_give_the_tree_of_single_merges(spark, few):
    vectors, sizes, rows, counts = table(spark, 4, 28, 14)
    merges = linkage.merge_tree(rows, counts, few).cache()
    assert merges.count() == 27
    for k in (1, 2, 5, 12, 27):
        assert groups_of(linkage.cut_tree(counts, merges, k)) == brute(vectors, sizes, k)
    merges.unpersist()


def test_pairs_above_a_level_are_all_found(spark):
    vectors, sizes, rows, counts = table(spark, 7, 60, 10)
    for level in (0.6, 0.2, 0.0):
        got = {(r.a, r.b): r.sim for r in linkage.similar_pairs(rows, counts, level).collect()}
        want = {}
        for a, b in itertools.combinations(range(60), 2):
            shared = [g for g in vectors[a] if g in vectors[b]]
            sim = sum(vectors[a][g] * vectors[b][g] for g in shared)
            if shared and sim >= level:
                want[a, b] = sim
        assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want)


def test_clusters_that_share_nothing(spark):
    rows = spark.createDataFrame([(c, f"g{c}", 1.0) for c in range(8)], "c long, gram string, s double")
    counts = spark.createDataFrame([(c, 1) for c in range(8)], "c long, n long")
    for few in (100, 3):
        assert sorted(map(len, groups_of(linkage.cut_tree(counts, linkage.merge_tree(rows, counts, few), 3)))) == [1, 1, 6]


def test_texts_are_grouped_alike_at_any_size(spark):
    words = ["red shoes", "red shoe", "shoes red", "blue car", "blue cars", "car blue", "green tea", "green teas", "tea", "Red  Shoes", "blue car", None, ""]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, keyword string")

    def found(few):
        out = cluster.group_texts(df, "keyword", max_clusters=4, few=few)
        assert out.columns == ["id", "keyword", "cluster_id"]
        own = {}
        for r in out.collect():
            own.setdefault(r.cluster_id, set()).add(r.id)
        return {frozenset(g) for g in own.values()}

    groups = found(100)
    assert len(groups) == 4 and sum(map(len, groups)) == 13
    assert {0, 1, 9} <= next(g for g in groups if 0 in g) and {3, 4, 10} <= next(g for g in groups if 3 in g) and {6, 7} <= next(g for g in groups if 6 in g)
    assert found(4) == groups
    assert cluster.group_texts(df.limit(2), "keyword") is None


def test_weights_count_repeated_texts(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "ac")], "id long, t string")
    alone = {(r.id, r.gram): r.weight for r in cluster.tfidf_chars(df, "id", "t").collect()}
    merged = df.groupBy("t").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    for r in cluster.tfidf_chars(merged, "id", "t", "n").collect():
        assert np.isclose(alone[r.id, r.gram], r.weight)
