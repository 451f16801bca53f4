"""Curves, samples and distribution tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.functions.stats import log_choose
from umbral.operators.graph import number_globally


def curve_sizes(total: Column, steps: int = 10) -> Column:
    """Up to ten equal sample sizes ending on the full set, as an array."""
    each = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.floor(total * i / steps).cast("bigint"))
    return F.array_distinct(F.filter(each, lambda s: s > 0))


def rarefaction_expected(axis: DataFrame, found: DataFrame, lineage: str = "lineage", family: str = "family_id") -> DataFrame:
    """Expected families in s of N lineages: the sum over families of 1 - C(N-f, s) / C(N, s).

    ``axis`` lists every lineage, ``found`` the (lineage, family) incidences. Families collapse
    to a histogram of their lineage counts, so each curve point reads one row per distinct count.
    """
    n = axis.agg(F.count_distinct(lineage)).scalar()
    hist = (found.select(lineage, family).distinct().groupBy(family).agg(F.count(F.lit(1)).alias("f"))
            .groupBy("f").agg(F.count(F.lit(1)).alias("m")).withColumn("n_total", n))
    sized = hist.withColumn("n_lineages", F.explode(curve_sizes(F.col("n_total"))))
    N, s, f = (F.col(c).cast("double") for c in ("n_total", "n_lineages", "f"))
    unseen = F.when(N - f < s, 0.0).otherwise(F.exp(log_choose(N - f, s) - log_choose(N, s)))
    return sized.groupBy("n_lineages").agg(F.round(F.sum(F.col("m") * (1.0 - unseen)), 4).alias("mean_families"))


def rarefaction_sampled(axis: DataFrame, found: DataFrame, replicates: int = 20, seed: int = 0, order=None,
                        lineage: str = "lineage", family: str = "family_id") -> DataFrame:
    """Mean, min and max families over seeded samples without replacement.

    Each replicate is one hash-ordered ranking of the lineages; a sample of size s is its first
    s, so a family is seen from its best-ranked lineage on. The ranking is taken by a range sort
    (no one-task window) and a curve point counts families map-side.
    ``order(lineage, replicate)`` gives the shuffle key; the default is a seeded hash.
    """
    key = order or (lambda l, r: F.xxhash64(F.lit(seed), r, l))
    reps = F.explode(F.sequence(F.lit(1), F.lit(replicates)))
    n = axis.agg(F.count_distinct(lineage).alias("n_total"))
    ax = axis.select(lineage).distinct().withColumn("replicate", reps)
    ax = ax.withColumn("_o", key(F.col(lineage), F.col("replicate")))
    num = number_globally(ax, [F.asc("replicate"), F.asc("_o"), F.asc(lineage)], "_g")
    ranks = num.withColumn("n_total", n.scalar()).withColumn("rank", F.col("_g") - (F.col("replicate") - 1) * F.col("n_total") + 1)
    seen = (found.select(lineage, family).distinct().join(ranks.select(lineage, "replicate", "rank", "n_total"), lineage)
            .groupBy("replicate", family).agg(F.min("rank").alias("first"), F.max("n_total").alias("n_total")))
    reached = seen.select("replicate", F.explode(F.filter(curve_sizes(F.col("n_total")), lambda s: s >= F.col("first"))).alias("n_lineages"))
    counts = reached.groupBy("replicate", "n_lineages").agg(F.count(F.lit(1)).alias("k"))
    # A sample that holds no family still counts, with zero.
    grid = n.select(F.explode(curve_sizes(F.col("n_total"))).alias("n_lineages")).withColumn("replicate", reps)
    full = grid.join(counts, ["replicate", "n_lineages"], "left").withColumn("k", F.coalesce("k", F.lit(0)))
    return full.groupBy("n_lineages").agg(F.round(F.avg("k"), 2).alias("mean_families"), F.min("k").alias("min_families"),
                                          F.max("k").alias("max_families"), F.lit(replicates).alias("n_replicates"))


def saturation(curve: DataFrame) -> DataFrame:
    """Final slope over initial slope of a curve of at most ten points; NULL when undefined."""
    pts = curve.agg(F.sort_array(F.collect_list(F.struct("n_lineages", "mean_families"))).alias("p"))
    at = lambda i: F.try_element_at("p", F.lit(i))
    slope = lambda a, b: F.when(b["n_lineages"] == a["n_lineages"], 0.0).otherwise(
        (b["mean_families"] - a["mean_families"]) / F.nullif(b["n_lineages"] - a["n_lineages"], F.lit(0)))
    first, last = slope(at(1), at(2)), slope(at(-2), at(-1))
    return pts.select(F.when((F.size("p") >= 3) & (first > 0), F.round(last / F.nullif(first, F.lit(0.0)), 4)).alias("saturation"))


def stratified_sample(df: DataFrame, strata: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    """``n`` rows taken round-robin over the strata: every stratum gives one before any gives two.

    A stratum never contributes more than ``n`` rows, so ranking inside a stratum is a rank
    filter that keeps ``n`` rows per map task.
    """
    w = Window.partitionBy(*strata).orderBy(*order)
    ranked = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
    return ranked.orderBy("_r", *strata).limit(n).withColumnRenamed("_r", "turn")


def size_histogram(families: DataFrame, group: str = "family_resolution", size: str = "family_size") -> DataFrame:
    return families.groupBy(group, size).agg(F.count(F.lit(1)).alias("n_families"))


def fraction_histogram(families: DataFrame, value: str = "percentage_dark_in_family", size: str = "family_size",
                       min_size: int = 2, bins: int = 20, top: float = 100.0) -> DataFrame:
    """Equal-width bins over 0..top; the last bin includes its upper edge."""
    b = F.least(F.lit(bins - 1), F.floor(F.col(value) / (top / bins)))
    return families.filter(F.col(size) >= min_size).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_families"))


def value_counts(rows: DataFrame, value: str, count: str = "n_nodes") -> DataFrame:
    """How many rows carry each value: the degree table, and twice over the community sizes."""
    return rows.groupBy(value).agg(F.count(F.lit(1)).alias(count))


def community_sizes(nodes: DataFrame, community: str = "community_id") -> DataFrame:
    return value_counts(value_counts(nodes, community, "size"), "size", "n_communities")


def class_counts(families: DataFrame) -> DataFrame:
    return families.groupBy("family_class", F.when(F.col("dark_only") == 1, "dark-only").otherwise("mixed").alias("darkness")).agg(
        F.count(F.lit(1)).alias("n_families"))


def log_length_histogram(items: DataFrame, group: str, length: str, bottom: float = 20.0, bins: int = 40) -> DataFrame:
    """(group, bin, n): log-spaced bins from ``bottom`` to the largest length; values below are left out."""
    top = items.agg(F.max(length)).scalar()
    x = F.log(F.col(length) / bottom) / F.log(top / bottom) * bins
    b = F.least(F.lit(bins - 1), F.floor(F.round(x, 9))).cast("int")
    return items.filter(F.col(length) >= bottom).groupBy(group, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def upper_median(items: DataFrame, group: str, length: str) -> DataFrame:
    """The value at position floor(n/2) of the sorted values, from their histogram."""
    h = items.groupBy(group, length).agg(F.count(F.lit(1)).alias("_k"))
    c = F.sum("_k").over(Window.partitionBy(group).orderBy(length).rowsBetween(Window.unboundedPreceding, 0))
    n = F.sum("_k").over(Window.partitionBy(group))
    return h.withColumns({"_c": c, "_n": n}).filter(F.col("_c") > F.floor(F.col("_n") / 2)).groupBy(group).agg(
        F.min(length).alias("median"), F.max("_n").alias("n"))


def crosstab(rows: DataFrame, row: str, col: str, cols: Sequence[str], missing: str = "NOT_IN_PS") -> DataFrame:
    """Counts of row class x column class with a margin; an absent row class is its own row."""
    r = rows.withColumn(row, F.coalesce(row, F.lit(missing)))
    return r.groupBy(row).agg(*[F.count_if(F.col(col) == c).alias(c) for c in cols], F.count(F.lit(1)).alias("total"))


def occurrence_pick(items: DataFrame, members: DataFrame, max_rows: int, family: str = "family_id", entity: str = "seq_id",
                    record: str = "plasmid_id", item: str = "orf_id", position: str = "position") -> DataFrame:
    """One focal item per (family, record) in member order, the first ``max_rows`` records by id.

    ``n_total`` keeps the number before the cut. The per-record pick is a min_by and the cut a
    rank filter.
    """
    m = items.join(members.select(family, entity, position), entity)
    one = m.groupBy(family, record).agg(F.min_by(item, F.struct(position, item)).alias(item))
    total = one.groupBy(family).agg(F.count(F.lit(1)).alias("n_total"))
    w = Window.partitionBy(family).orderBy(record)
    return one.withColumn("row", F.row_number().over(w)).filter(F.col("row") <= max_rows).join(total, family)


def relative_layout(focal: DataFrame, start: str = "start", end: str = "end", strand: str = "strand",
                    size: str = "length") -> DataFrame:
    """x0, x1, forward of each neighbour relative to a focal item that is turned to point right.

    Input columns: f_start, f_end, f_strand, side (-1, 0, 1) and the neighbour's own coordinates.
    """
    L = F.col(size)
    span = lambda a, b: F.pmod(F.col(b) - F.col(a), L)
    d = F.col(start) - F.col("f_start")
    d = F.when((F.col("side") < 0) & (d > 0), d - L).when((F.col("side") > 0) & (d < 0), d + L).otherwise(d)
    a, b, fl = d, d + span(start, end), span("f_start", "f_end")
    flip = F.col("f_strand") == -1
    return focal.withColumns({"x0": F.when(flip, fl - b).otherwise(a), "x1": F.when(flip, fl - a).otherwise(b),
                              "forward": ((F.col(strand) == 1) != flip).cast("int")})
