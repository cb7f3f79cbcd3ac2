"""Expressions over monthly volumes and interest series held as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column


def sort_monthly(c: Column | str) -> Column:
    """Months newest first; a missing year or month counts as 0, null becomes []."""
    col = F.coalesce(as_column(c), F.array().cast("array<struct<year:int,month:int,search_volume:bigint>>"))

    def stamp(m: Column) -> Column:
        return F.coalesce(m["year"], F.lit(0)) * 100 + F.coalesce(m["month"], F.lit(0))

    keyed = F.transform(
        F.filter(col, lambda m: m.isNotNull()), lambda m, i: F.struct((-stamp(m)).alias("k"), i.alias("i"), m.alias("m"))
    )
    return F.transform(F.sort_array(keyed), lambda x: x["m"])


def latest_month(sorted_months: Column | str) -> Column:
    return F.get(as_column(sorted_months), F.lit(0))["search_volume"]


def pct_trend(sorted_months: Column | str, months: int) -> Column:
    """Relative change of the newest month against the one ``months`` before it."""
    col = as_column(sorted_months)
    latest = F.coalesce(F.get(col, F.lit(0))["search_volume"], F.lit(0)).cast("double")
    past = F.coalesce(F.get(col, F.lit(months))["search_volume"], F.lit(0)).cast("double")
    change = F.bround((latest - past) / F.nullif(past, F.lit(0.0)), 4)
    return F.when((F.size(col) > months) & (past != 0), change)


def _mean(values: Column, size: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.nullif(size.cast("double"), F.lit(0.0))


def interest_summary(c: Column | str) -> dict[str, Column]:
    """Latest, mean, direction and slope of an interest series; all null when empty."""
    values = as_column(c)
    n = F.size(values)
    quarter = F.greatest(F.lit(1), F.floor(n / 4).cast("int"))
    filled = F.coalesce(n > 0, F.lit(False))
    early = _mean(F.slice(values, F.lit(1), quarter), quarter)
    late = _mean(F.slice(values, F.greatest(n - quarter + 1, F.lit(1)), quarter), quarter)
    slope = F.when(filled, F.bround(late - early, 3))
    return {
        "trend_interest_latest": F.when(filled, F.bround(F.get(values, n - 1), 2)),
        "trend_interest_avg": F.when(filled, F.bround(_mean(values, n), 2)),
        "trend_direction": F.when(slope > 3, "rising").when(slope < -3, "falling").when(filled, "flat"),
        "trend_slope": slope,
    }
