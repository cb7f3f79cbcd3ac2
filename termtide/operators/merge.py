"""Discovered keywords and volume metrics to one row per keyword and market.

Groups and joins go by one struct ``(normal form, location, language)``. Structs
with nulls inside compare equal, so null markets form groups and match, and the
partitioning of the group-by serves the join without another shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from ..functions.text import joined_unique, normalize_keyword, null_if_nan, strip, text_key
from ..schemas import DOUBLE, MONTHS
from .spread import lookup_join

KEY = ("keyword_normalized", "location_code", "language_code")
METRIC_EXTRAS = {"trend_3m": DOUBLE, "trend_12m": DOUBLE, "monthly_searches": MONTHS, "competition_index": DOUBLE}
PREFERRED = ("search_volume", "cpc", "competition")


def market_key(keyword: Column | str) -> Column:
    return F.struct(normalize_keyword(keyword).alias(KEY[0]), F.col(KEY[1]), F.col(KEY[2]))


def keyword_id(normalized: Column | str, location: Column | str, language: Column | str) -> Column:
    """First 16 hex digits of sha1 over 'normal form|location|language', nulls as ''."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in (normalized, location, language)]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def first_entry(c: str, order: str) -> Column:
    """Aggregate: struct of the smallest order with a non-null value, and that value."""
    return F.min(F.when(F.col(c).isNotNull(), F.struct(order, c)))


def join_unique(c: Column | str) -> Column:
    """Aggregate: distinct trimmed non-empty values, sorted and joined by '|'."""
    col = F.col(c) if isinstance(c, str) else c
    return F.array_join(F.sort_array(F.collect_set(F.nullif(strip(col), F.lit("")))), "|")


def _merged(discovered: DataFrame, order: str) -> DataFrame:
    """Grouped twice: first by everything textual, then by key.

    The first grouping only keeps numbers, so it hashes and combines map-side, and
    it spreads a hot keyword by its provenance. The second one gets each value of
    a set once and is where the normal form is worked out.
    """
    has_urls = "source_url" in discovered.columns
    texts = ["keyword", "competition_level", "source_term", "source_endpoint", "categories"]
    texts += ["source_url"] if has_urls else []
    distinct = discovered.groupBy("location_code", "language_code", *texts).agg(
        F.min(order).alias("_ord"),
        *[F.max(null_if_nan(c)).alias(c) for c in (*PREFERRED, "keyword_difficulty")],
    )
    keyed = distinct.withColumn("_k", market_key("keyword")).where(F.col("_k")[KEY[0]] != "")
    return keyed.groupBy("_k").agg(
        first_entry("keyword", "_ord")["keyword"].alias("keyword"),
        *[F.max(c).alias(c) for c in PREFERRED],
        first_entry("competition_level", "_ord")["competition_level"].alias("competition_level"),
        F.max("keyword_difficulty").alias("keyword_difficulty"),
        join_unique("source_term").alias("source_terms"),
        join_unique("source_endpoint").alias("source_endpoints"),
        join_unique("categories").alias("categories"),
        (_unique_urls() if has_urls else F.lit("")).alias("source_urls"),
    )


def _unique_urls() -> Column:
    """Aggregate: like ``join_unique``, over rows that may carry several urls each."""
    lists = F.collect_set(F.nullif(strip("source_url"), F.lit("")))
    return joined_unique(F.flatten(F.transform(lists, lambda u: F.split(u, r"\|"))))


def _spread_key(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "_k"]
    return df.select(*[F.col("_k")[name].alias(name) for name in KEY], *rest)


def merge_discovered(discovered: DataFrame, order: str) -> DataFrame:
    """One row per (normal form, location, language); ``order`` decides what is first."""
    return _spread_key(_merged(discovered, order))


def _first_metrics(metrics: DataFrame, order: str) -> DataFrame:
    kept = [c for c in (*PREFERRED, *METRIC_EXTRAS) if c in metrics.columns]
    keyed = metrics.withColumn("_k", market_key("keyword"))
    # equal times are the rule in one response: the values settle them, whatever the order of rows
    first = keyed.groupBy("_k").agg(F.min(F.struct(F.col(order).alias("_at"), *kept)).alias("_first"))
    return first.select("_k", F.struct(*[F.col(f"_first.{c}").alias(c) for c in kept]).alias("_m"))


def dedupe_metrics(metrics: DataFrame, order: str) -> DataFrame:
    """The first metrics row per key."""
    first = _first_metrics(metrics, order)
    return _spread_key(first.select("_k", "_m.*"))


def _attached(merged: DataFrame, metrics: DataFrame | None) -> DataFrame:
    kept = [c for c in merged.columns if c not in PREFERRED]
    if metrics is None:
        extras = [F.lit(None).cast(t).alias(c) for c, t in METRIC_EXTRAS.items()]
        return merged.select(*kept, *PREFERRED, *extras)
    present = set(metrics.schema["_m"].dataType.fieldNames())
    joined = merged.join(metrics, "_k", "left")

    def metric(name: str, dtype: DataType) -> Column:
        return (F.col(f"_m.{name}") if name in present else F.lit(None)).cast(dtype)

    preferred = [F.coalesce(null_if_nan(metric(c, DOUBLE)), F.col(c).cast("double")).alias(c) for c in PREFERRED]
    extras = [metric(c, t).alias(c) for c, t in METRIC_EXTRAS.items()]
    return joined.select(*kept, *preferred, *extras)


def attach_metrics(merged: DataFrame, metrics: DataFrame | None, order: str = "collected_at") -> DataFrame:
    """Left join by the three keys, nulls match; the metrics table wins where it has a value."""
    keyed = merged.withColumn("_k", F.struct(*KEY)).drop(*KEY)
    return _spread_key(_attached(keyed, None if metrics is None else _first_metrics(metrics, order)))


def merge_keywords(
    discovered: DataFrame, metrics: DataFrame | None, order: str, metrics_order: str = "collected_at"
) -> DataFrame:
    """The keyword master: merged discoveries, authoritative metrics, identity."""
    first = None if metrics is None else _first_metrics(metrics, metrics_order)
    master = _spread_key(_attached(_merged(discovered, order), first))
    return master.withColumn("keyword_id", keyword_id(*KEY))


def resolve_sources(discovered: DataFrame, candidates: DataFrame) -> DataFrame:
    """Fill ``source_url`` from the candidate rows that a discovery's source term names.

    The urls of a term are combined before the join, so discoveries keep their
    number; ``merge_discovered`` takes the '|'-joined urls apart again.
    """
    located = candidates.where(strip("source_url") != "")
    urls = located.groupBy(text_key("term").alias("_term")).agg(join_unique("source_url").alias("source_url"))
    rows = discovered.drop("source_url").withColumn("_term", text_key("source_term"))
    found = lookup_join(rows, urls, on=["_term"])
    return found.withColumn("source_url", F.coalesce("source_url", F.lit(""))).drop("_term")
