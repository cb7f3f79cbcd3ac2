"""Shortlists for further checks and merging the findings back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..schemas import SERP_INTENT, TREND_TABLE
from .score import rank_order
from .spread import lookup_join


def shortlist(master: DataFrame, n: int) -> DataFrame:
    """Keywords of the first ``n`` ranked rows that have one; the master must be scored."""
    if "passes_filters" not in master.columns:
        raise ValueError("a shortlist needs a scored master: there is no rank without passes_filters")
    return master.where(F.col("keyword").isNotNull()).orderBy(*rank_order()).limit(n).select("keyword")


def _attach(master: DataFrame, findings: DataFrame, columns: Sequence[str], checked: str, on: Sequence[str]) -> DataFrame:
    values = [c for c in columns if c not in on]
    kept = master.drop(*values)
    # the latest finding per keyword; equal times are settled by the values
    latest = findings.groupBy(*on).agg(F.max(F.struct(checked, *[c for c in values if c != checked])).alias("_f"))
    return lookup_join(kept, latest, on=on).select(
        *kept.columns, *[F.col(f"_f.{c}").alias(c) for c in values]
    )


def attach_serp(master: DataFrame, serp: DataFrame, on: Sequence[str] = ("keyword",)) -> DataFrame:
    """Left join of result-page findings; earlier ones are replaced, rows never multiply."""
    return _attach(master, serp, SERP_INTENT.fieldNames(), "serp_checked_at", on)


def attach_trends(master: DataFrame, trends: DataFrame, on: Sequence[str] = ("keyword",)) -> DataFrame:
    """Left join of interest findings; earlier ones are replaced, rows never multiply."""
    return _attach(master, trends, TREND_TABLE.fieldNames(), "trend_checked_at", on)


def label_counts(df: DataFrame, column: str, with_nulls: bool = True) -> DataFrame:
    rows = df if with_nulls else df.where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias("n"))
