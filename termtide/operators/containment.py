"""Which known entities a keyword contains, without comparing all with all.

An entity of length n is contained in a keyword when one of the keyword's
substrings of length n equals it. So the search is two equi-joins whose right
sides have one row per key: from each position's first three characters to the
lengths that entities with that beginning have, then from the substrings of those
lengths to the entities themselves. A keyword yields at most one substring per
position and length, however many entities begin alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import ENTITY_TYPES
from ..functions.text import text_key
from ..session import stage
from .spread import lookup_join

PREFIX = 3


def entity_set(candidates: DataFrame) -> DataFrame:
    """Distinct lower-cased known entities of at least three characters."""
    named = candidates.where(F.col("term_type").isin(*ENTITY_TYPES))
    terms = named.select(text_key("term").alias("entity"))
    return terms.where(F.length("entity") >= PREFIX).distinct()


def entity_containment(keywords: DataFrame, entities: DataFrame, column: str = "keyword") -> DataFrame:
    """Distinct pairs (lower-cased keyword, contained entity)."""
    return _hits(keywords, entities, column).distinct()


def _hits(keywords: DataFrame, entities: DataFrame, column: str) -> DataFrame:
    """A pair for every place in a keyword where an entity stands."""
    texts = keywords.select(F.lower(column).alias("keyword")).where(F.length("keyword") >= PREFIX).distinct()
    # Written once: mined entities are used twice here, and a written table has a
    # size the planner knows, so a small set is broadcast and the many positions
    # below are not shuffled; a large set is shuffled.
    known = stage(entities.where(F.length("entity") >= PREFIX).select("entity").distinct(), "entities")
    beginnings = known.groupBy(F.substring("entity", 1, PREFIX).alias("_begin")).agg(
        F.collect_set(F.length("entity")).alias("_lengths")
    )
    at = F.explode(F.sequence(F.lit(1), F.length("keyword") - (PREFIX - 1)))
    positions = texts.select("keyword", at.alias("_at"))
    starts = positions.withColumn("_begin", F.col("keyword").substr(F.col("_at"), F.lit(PREFIX)))
    with_lengths = lookup_join(starts, beginnings, on=["_begin"], how="inner")
    fitting = F.filter("_lengths", lambda n: n <= F.length("keyword") - F.col("_at") + 1)
    spans = with_lengths.select("keyword", "_at", F.explode(fitting).alias("_n"))
    substrings = spans.select("keyword", F.col("keyword").substr(F.col("_at"), F.col("_n")).alias("entity"))
    return lookup_join(substrings, known, on=["entity"], how="inner").select("keyword", "entity")


def longest_entity(keywords: DataFrame, entities: DataFrame, column: str = "keyword") -> DataFrame:
    """The longest contained entity per lower-cased keyword; equal lengths by code point order."""
    best = F.min(F.struct((-F.length("entity")).alias("n"), F.col("entity")))
    # a repeated pair changes no minimum, so places need not be made distinct first
    return _hits(keywords, entities, column).groupBy("keyword").agg(best["entity"].alias("entity"))


def with_longest_entity(df: DataFrame, entities: DataFrame | None, column: str = "keyword", into: str = "entity") -> DataFrame:
    """Add the longest contained entity, NULL when there is none.

    Every distinct keyword is searched once, then looked up by all its rows.
    """
    if entities is None:
        return df.withColumn(into, F.lit(None).cast("string"))
    hits = longest_entity(df, entities, column).select(F.col("keyword").alias("_kw"), F.col("entity").alias(into))
    rows = df.withColumn("_kw", F.lower(column))
    return lookup_join(rows, hits, on=["_kw"]).drop("_kw")
