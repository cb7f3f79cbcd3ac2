"""Joins and numbering that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Join many rows to a lookup that has at most one row per key.

    Nothing is copied and nothing is hinted, so the size that the planner compares
    with its broadcast threshold is the lookup's own. A lookup over the threshold is
    shuffled; the partition of a hot key is then split by the size it turned out to
    have (adaptive skew join), which repeats one lookup partition per piece and no more.
    """
    return rows.join(lookup, list(on), how)


def with_index(df: DataFrame, *order: Column | str, name: str = "idx") -> DataFrame:
    """Number rows 0, 1, 2, .. in a given total order without one task seeing all.

    A range-sorted copy is written with its partition-wise ids; the only window
    without partitions runs over one row per written partition.
    """
    local = stage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    part, within = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = local.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # one row per partition of the sorted copy: bounded by the task count
    placed = local.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, within + F.col("_offset")).drop("_id", "_part", "_offset")
