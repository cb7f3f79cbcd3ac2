"""Grouping keywords: character n-gram weights, cluster count, clusters from below (texts) or above (vectors), names."""

from __future__ import annotations

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import as_column, clean
from .containment import with_longest_entity
from ..session import stage
from .linkage import FEW, cut_tree, merge_tree
from .spread import lookup_join, with_index

GRAM_SIZES = (2, 3, 4)
SEED = 42


def char_grams(c: Column | str, sizes: tuple[int, ...] = GRAM_SIZES) -> Column:
    """Character n-grams of every word, each word padded with a space on both sides."""
    words = F.filter(F.split(clean(F.lower(as_column(c))), " "), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams(n: int) -> Column:
        def of_word(w: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(1), F.length(w)), lambda i: i <= F.length(w) - n + 1)
            return F.transform(starts, lambda i: w.substr(i, F.lit(n)))

        return F.flatten(F.transform(padded, of_word))

    return F.concat(*[grams(n) for n in sizes])


def tfidf_chars(df: DataFrame, key: str, column: str, times: str | None = None) -> DataFrame:
    """Sparse rows (key, gram, weight): counts times smoothed idf, unit length per key.

    ``key`` identifies a text. Every text counts into the idf, also one without grams,
    as often as its ``times`` says.
    """
    often = F.col(times) if times else F.lit(1)
    # used for the document counts, the weights and the norms: written once
    counts = stage(
        df.select(key, often.cast("long").alias("_times"), F.explode(char_grams(column)).alias("gram"))
        .groupBy(key, "_times", "gram").agg(F.count("*").cast("double").alias("tf")),
        "gram-counts",
    )
    in_docs = counts.groupBy("gram").agg(F.sum("_times").alias("df"))
    total = df.agg(F.sum(often)).scalar()
    idf = F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + 1.0
    weighted = lookup_join(counts, in_docs, on=["gram"], how="inner").select(
        key, "gram", (F.col("tf") * idf).alias("w")
    )
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, key).select(key, "gram", (F.col("w") / F.col("norm")).alias("weight"))


def group_texts(df: DataFrame, column: str, max_clusters: int = 12, few: int = FEW) -> DataFrame | None:
    """Add ``cluster_id``: average linkage, from the bottom up, over n-gram tf-idf vectors; None for fewer than 3 rows.

    Texts with the same words are one node, as heavy as they are many. Of equally near pairs
    the one whose texts sort first merges first, so that equal tables give equal clusters.
    """
    n, k = df.agg(F.count("*").alias("n")).select("n", cluster_count(F.col("n"), max_clusters)).first()
    if n < 3:
        return None
    form = clean(F.lower(as_column(column)))
    texts = df.groupBy(form.alias("_form")).agg(F.count("*").alias("n"))
    nodes = stage(with_index(texts, "_form", name="c"), "cluster-nodes")
    weights = tfidf_chars(nodes, "c", "_form", "n").join(nodes.select("c", "n"), "c")
    vectors = weights.select("c", "gram", (F.col("weight") * F.col("n")).alias("s"))
    labels = cut_tree(nodes, merge_tree(vectors, nodes.select("c", "n"), few), k)
    named = nodes.select("c", "_form").join(labels, "c").select("_form", "cluster_id")
    return lookup_join(df.withColumn("_form", form), named, on=["_form"], how="inner").drop("_form")


def dense_vectors(df: DataFrame, column: str, into: str = "vector") -> DataFrame:
    """Unit-length vectors from an array column of supplied embeddings."""
    raw = df.withColumn("_raw", array_to_vector(F.col(column).cast("array<double>")))
    return Normalizer(inputCol="_raw", outputCol=into).transform(raw).drop("_raw")


def cluster_count(n: Column, max_clusters: int = 12) -> Column:
    """How many clusters n rows are put into."""
    return F.greatest(F.lit(2), F.least(F.lit(max_clusters), F.floor(n / 3))).cast("bigint")


def assign_clusters(df: DataFrame, vector: str = "vector", max_clusters: int = 12) -> DataFrame | None:
    """Add ``cluster_id`` by top-down grouping of dense vectors; None when there are fewer than 3 rows."""
    n, k = df.agg(F.count("*").alias("n")).select("n", cluster_count(F.col("n"), max_clusters)).first()
    if n < 3:
        return None
    grouping = BisectingKMeans(k=k, seed=SEED, featuresCol=vector, predictionCol="cluster_id")
    return grouping.fit(df).transform(df)


def name_clusters(
    df: DataFrame, cluster: str, entities: DataFrame | None, order: str, column: str = "keyword", volume: str = "search_volume"
) -> DataFrame:
    """One row per cluster: named after its largest member, or the longest entity in it.

    Among equal volumes, and where no member has one, the first by ``order`` stands.
    """
    place = F.struct((-F.coalesce(F.col(volume).cast("double"), F.lit(0.0))).alias("v"), F.col(order).alias("o"))
    largest = df.groupBy(cluster).agg(F.min_by(column, place).alias("keyword"), F.count("*").alias("members"))
    named = with_longest_entity(largest, entities)
    return named.select(cluster, "members", F.coalesce("entity", "keyword").alias("cluster_label"))


def semantic_labels(
    df: DataFrame, entities: DataFrame | None, order: str, embedding: str | None = None, max_clusters: int = 12
) -> DataFrame:
    """Replace ``cluster_label`` by semantic cluster names; fewer than 3 rows stay as they are."""
    if embedding:
        clustered = assign_clusters(dense_vectors(df, embedding), max_clusters=max_clusters)
    else:
        clustered = group_texts(df, "keyword", max_clusters)
    if clustered is None:
        return df
    names = name_clusters(clustered, "cluster_id", entities, order).select("cluster_id", "cluster_label")
    # at most max_clusters rows
    return clustered.drop("cluster_label", "vector").join(F.broadcast(names), "cluster_id").drop("cluster_id")
