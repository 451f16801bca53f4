"""Merged interval coverage. Overlaps are merged, never summed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged_length(intervals: DataFrame, keys, start: str = "start", end: str = "end") -> DataFrame:
    """(keys, covered): positions covered by the union of 1-based inclusive intervals.

    The furthest end per distinct start is taken first, map-side: an entity's rows then number
    at most its own length however many hits it has, so the running maximum that follows never
    scans an unbounded group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    far = (intervals.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
           .groupBy(*keys, F.col(start).alias("_s")).agg(F.max(end).alias("_e")))
    before = Window.partitionBy(*keys).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    new_from = F.greatest(F.col("_s"), F.coalesce(F.max("_e").over(before), F.lit(0)) + 1)
    return (far.withColumn("_new", F.greatest(F.lit(0), F.col("_e") - new_from + 1))
            .groupBy(*keys).agg(F.sum("_new").cast("bigint").alias("covered")))


def covered_fraction(covered, length) -> Column:
    """Four-decimal fraction; 0 when nothing is covered or the length is unknown."""
    c = covered if isinstance(covered, Column) else F.col(covered)
    n = length if isinstance(length, Column) else F.col(length)
    return F.coalesce(F.round(c / F.nullif(n, F.lit(0)), 4), F.lit(0.0))


def coverage(intervals: DataFrame, lengths: DataFrame, key: str, length: str = "length",
             start: str = "start", end: str = "end") -> DataFrame:
    """Every entity of ``lengths`` with its covered fraction."""
    return (lengths.select(key, length).join(merged_length(intervals, key, start, end), key, "left")
            .select(key, length, F.coalesce("covered", F.lit(0)).alias("covered"),
                    covered_fraction("covered", length).alias("covered_fraction")))
