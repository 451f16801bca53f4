"""Exact order statistics of groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbral.session import cut

#: Different values of a group that are ordered in one place.
GATHER = 50_000


def medians(rows: DataFrame, key: str, value: str, name: str = "median", gather: int = GATHER) -> DataFrame:
    """(key, name): the exact median of the values other than NULL of each group, the mean of the middle two where their number is even.

    Equal values are counted first, so what follows is as long as the different values of a group. A group of
    at most ``gather`` of them is ordered in one place. Larger ones are dealt by a range sort of (group, value);
    the parts' counts tell which part holds the middle, and only that part of a group is ordered. No task holds a group.
    """
    v = rows.select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")).filter("k IS NOT NULL AND v IS NOT NULL")
    counts = cut(v.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")))
    large = cut(counts.groupBy("k").agg(F.count(F.lit(1)).alias("_d")).filter(F.col("_d") > gather).select("k"))
    placed = counts.withColumn("_part", F.lit(0))
    if large.limit(1).count():
        dealt = cut(counts.join(large, "k", "left_semi").repartitionByRange("k", "v").withColumn("_part", F.spark_partition_id()))
        placed = placed.join(large, "k", "left_anti").unionByName(dealt)
    per = Window.partitionBy("k")
    running = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = (placed.groupBy("k", "_part").agg(F.sum("n").alias("_held"))
             .select("k", "_part", "_held", F.coalesce(F.sum("_held").over(running(per.orderBy("_part"))), F.lit(0)).alias("_skip"), F.sum("_held").over(per).alias("_n"))
             .withColumns({"_lo": F.floor((F.col("_n") - 1) / 2), "_hi": F.floor(F.col("_n") / 2)}))
    middle = parts.filter((F.col("_lo") < F.col("_skip") + F.col("_held")) & (F.col("_hi") >= F.col("_skip"))).select("k", "_part", "_skip", "_lo", "_hi")
    inside = running(Window.partitionBy("k", "_part").orderBy("v"))
    at = placed.join(middle, ["k", "_part"]).withColumn("_skip", F.col("_skip") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
    found = at.filter((F.col("_lo") < F.col("_skip") + F.col("n")) & (F.col("_hi") >= F.col("_skip")))
    return found.groupBy(F.col("k").alias(key)).agg(F.avg("v").alias(name))
