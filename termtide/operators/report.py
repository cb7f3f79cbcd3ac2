"""The datasets behind the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import REPORT_TOP
from ..functions.text import to_number
from ..schemas import EXPORT_COLUMNS
from ..sources.tables import markets_df
from .score import rank_key, rank_order

OPTIONAL_COLUMNS = ("serp_intent", "trend_direction")
MONTHS_SHOWN = 12
LABEL_LENGTH = 40


def _number(c: str):
    return to_number(F.col(c).cast("string"))


def summary_totals(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count("*").alias("keywords"),
        F.count_if(_number("search_volume") > 0).alias("with_volume"),
        F.count_if("passes_filters").alias("passing"),
    )


def _top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("keywords"))
    return counted.orderBy(F.desc("keywords"), column).limit(n)


def top_languages(scored: DataFrame, n: int = 5) -> DataFrame:
    return _top_counts(scored, "language_code", n)


def top_clusters(scored: DataFrame, n: int = 8) -> DataFrame:
    return _top_counts(scored, "cluster_label", n)


def top_opportunities(scored: DataFrame, n: int = REPORT_TOP) -> DataFrame:
    """First rows of the ranked master with the report's columns that are present."""
    shown = [c for c in (*EXPORT_COLUMNS, *OPTIONAL_COLUMNS) if c in scored.columns]
    return scored.orderBy(*rank_order()).limit(n).select(*shown)


def volume_vs_competition(scored: DataFrame) -> DataFrame:
    """Scatter data of keywords that have volume."""
    rows = scored.withColumn("search_volume", _number("search_volume")).where("search_volume > 0")
    growth = F.greatest(F.coalesce(_number("trend_3m"), F.lit(0.0)), F.lit(0.0))
    return rows.select(
        "keyword", "location_code", "language_code", "cluster_label", "search_volume",
        F.coalesce(_number("competition"), F.lit(0.0)).alias("competition"),
        (growth + F.lit(0.1)).alias("trend_size"), "source_terms", "opportunity_score", "recommended_action",
    )


def trend_matrix(scored: DataFrame, n: int = REPORT_TOP) -> DataFrame:
    """Monthly volumes of the best keywords, oldest first, rows padded to one width."""
    top = scored.orderBy(F.col("opportunity_score").desc_nulls_last(), *rank_order()).limit(n)
    newest = F.slice("monthly_searches", 1, MONTHS_SHOWN)
    volumes = F.transform(F.reverse(newest), lambda m: F.coalesce(m["search_volume"], F.lit(0)))
    rows = top.select(
        F.substring("keyword", 1, LABEL_LENGTH).alias("label"), "keyword_normalized", "location_code", "language_code",
        volumes.alias("_v"),
    ).where(F.exists("_v", lambda v: v != 0))
    # at most n rows here, so the window without partitions is small
    width = F.max(F.size("_v")).over(Window.partitionBy())
    missing = F.array_repeat(F.lit(0).cast("bigint"), width - F.size("_v"))
    return rows.select(
        "label", "keyword_normalized", "location_code", "language_code", F.concat("_v", missing).alias("volumes")
    )


def _exact_mean(c: str):
    """Aggregate: mean over decimal sums, the same whatever the order of the rows."""
    total = F.sum(F.col(c).cast("decimal(26,12)")).cast("double")
    return total / F.nullif(F.count(c), F.lit(0))


def cluster_summary(scored: DataFrame) -> DataFrame:
    """Per cluster: keywords, volume, mean competition and opportunity, best keyword."""
    rows = scored.withColumns({c: _number(c) for c in ("search_volume", "competition")})
    return rows.groupBy("cluster_label").agg(
        F.count("keyword").alias("keywords"),
        F.coalesce(F.sum("search_volume"), F.lit(0.0)).alias("total_volume"),
        _exact_mean("competition").alias("avg_competition"),
        _exact_mean("opportunity_score").alias("avg_opportunity"),
        F.min_by("keyword", F.when(F.col("keyword").isNotNull(), rank_key())).alias("best_keyword"),
    ).orderBy(F.desc("total_volume"), "cluster_label")


def top_markets(scored: DataFrame, n: int | None = None) -> DataFrame:
    """Keywords per market with the market's name where it is a known one."""
    counted = scored.groupBy("location_code", "language_code").agg(F.count("*").alias("keywords"))
    known = markets_df(scored.sparkSession).select("name", "location_code", "language_code")
    # the dimension is configuration, a handful of rows
    named = counted.join(F.broadcast(known), ["location_code", "language_code"], "left")
    ordered = named.orderBy(F.desc("keywords"), "location_code", "language_code")
    return ordered if n is None else ordered.limit(n)


def action_report(scored: DataFrame) -> DataFrame:
    """Per recommended action: keywords, volume, and the best-ranked keyword."""
    rows = scored.withColumn("search_volume", _number("search_volume"))
    return rows.groupBy("recommended_action").agg(
        F.count("*").alias("keywords"),
        F.coalesce(F.sum("search_volume"), F.lit(0.0)).alias("total_volume"),
        F.max("opportunity_score").alias("best_opportunity"),
        F.min_by("keyword", rank_key()).alias("best_keyword"),
    )
