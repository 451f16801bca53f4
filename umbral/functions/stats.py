"""Log-gamma, hypergeometric tails and step-up correction as Spark expressions.

Spark has no log-gamma function. Stirling's series after a shift to arguments of at least
ten is accurate to the last digits of a double, needs no table and stays inside the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HALF_LOG_2PI = 0.5 * math.log(2 * math.pi)


def lgamma(x: Column) -> Column:
    """log(Gamma(x)) for x >= 1."""
    low = x < 10.0
    z = F.when(low, x + 10.0).otherwise(x)
    shift = F.when(low, F.log(x) + F.log((x + 1) * (x + 2) * (x + 3)) + F.log((x + 4) * (x + 5) * (x + 6))
                   + F.log((x + 7) * (x + 8) * (x + 9))).otherwise(F.lit(0.0))
    inv, inv2 = 1.0 / z, 1.0 / (z * z)
    series = inv * (F.lit(1 / 12) - inv2 * (F.lit(1 / 360) - inv2 * (F.lit(1 / 1260) - inv2 * (
        F.lit(1 / 1680) - inv2 * F.lit(1 / 1188)))))
    return (z - 0.5) * F.log(z) - z + _HALF_LOG_2PI + series - shift


def log_factorial_ratio(over: list[Column], under: list[Column]) -> Column:
    """log of the product of the factorials of ``over`` divided by that of ``under``.

    The series is one lambda body applied to an array, so the plan stays small however many
    factorials a formula has.
    """
    total = lambda xs: F.aggregate(F.array(*xs), F.lit(0.0), lambda acc, x: acc + lgamma(x + 1.0))
    return total(over) - total(under)


def log_choose(n: Column, k: Column) -> Column:
    return log_factorial_ratio([n], [k, n - k])


def _running_sum(steps: Column, ratio) -> Column:
    """1 + r1 + r1*r2 + ... where r_i = ratio(step i): a tail relative to its first term."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def fold(acc, i):
        term = acc["term"] * ratio(i)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    return F.aggregate(steps, start, fold)["total"]


#: Terms of a tail that are summed at the least, and the log of the share of the first term below which the rest cannot change a double.
_LEAST_TERMS, _REST = 64, -60.0


def _terms(count: Column, ratio_at) -> Column:
    """How many of a tail's ``count`` ratios are needed; ``ratio_at(s)`` is the s-th of them, at most one and falling.

    The ratios from m/2 to m are at most the one at m/2, so term m is at most its power of m/2. The smallest
    doubling m for which that bound vanishes is a few standard deviations wide, while ``count`` grows with the table.
    """
    sizes = F.array(*[F.lit(float(_LEAST_TERMS << j)) for j in range(48)])
    return F.least(count, F.element_at(F.filter(sizes, lambda m: (m >= count) | (F.log(ratio_at(m / 2)) * (m / 2) <= _REST)), 1))


def _steps(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(F.array().cast("array<int>"))


def hypergeom_sf(k: Column, N: Column, K: Column, n: Column) -> Column:
    """P(X >= k) for n draws from N of which K are marked.

    The first term of a tail is taken in log space and the rest follow from the ratio of
    neighbouring probabilities, always walking away from the mode so that every ratio is at
    most one, and as far as a term can still change the sum. Below the mode the lower tail is summed and subtracted from one.
    """
    k, N, K, n = (c.cast("double") for c in (k, N, K, n))
    lo, hi = F.greatest(F.lit(0.0), n + K - N), F.least(K, n)
    above = k > F.floor((n + 1) * (K + 1) / (N + 2))
    top = F.when(above, k).otherwise(k - 1)
    first = F.exp(log_factorial_ratio([K, N - K, n, N - n], [N, top, K - top, n - top, N - K - n + top]))
    rise, fall = lambda i: (K - i) * (n - i) / ((i + 1.0) * (N - K - n + i + 1.0)), lambda j: _lower_ratio(lo + k - j, N, K, n)
    up = _running_sum(_steps(k, k + _terms(hi - k, lambda s: rise(k + s)) - 1), rise)
    down = _running_sum(_steps(lo + 1, lo + _terms(k - 1 - lo, lambda s: fall(lo + 1 + s))), fall)
    tail = F.when(above, first * up).otherwise(1.0 - first * down)
    return (F.when(k <= lo, 1.0).when(k > hi, 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), tail))))


def _lower_ratio(i: Column, N: Column, K: Column, n: Column) -> Column:
    """P(X = i - 1) / P(X = i)."""
    return i * (N - K - n + i) / ((K - i + 1.0) * (n - i + 1.0))


def binomial_sf(x: Column, n: Column, r: Column) -> Column:
    """P(X >= x) for n trials of probability r, with x above the mean (a similarity p-value)."""
    x, n = x.cast("double"), n.cast("double")
    first = F.exp(log_factorial_ratio([n], [x, n - x]) + x * F.log(r) + (n - x) * F.log1p(-r))
    tail = _running_sum(_steps(x, n - 1), lambda i: (n - i) / (i + 1.0) * r / (1.0 - r))
    return F.when(x <= 0, 1.0).otherwise(F.least(F.lit(1.0), first * tail))


def step_up(tests: DataFrame, p: str = "p_value", weight: str = "n_tests") -> DataFrame:
    """``tests`` with a Benjamini-Hochberg ``q_value``; each row stands for ``weight`` tests.

    Tests that tie share the rank of the last of them, so collapsing them first is exact. The
    p-values are cut into about a thousand ranges, each scanned on its own; only the per-range
    totals meet in one task.
    """
    v = F.col(p)
    t = tests.withColumn("_b", F.when(v >= 1e-3, F.floor((1.0 - v) * 900)).otherwise(
        F.lit(900) + F.floor((-F.log10(F.greatest(v, F.lit(1e-300))) - 3.0) * 0.4)).cast("int"))
    # A smaller p has a larger bin number: ranks grow from the largest bin downwards.
    tot = t.groupBy("_b").agg(F.sum(weight).alias("_n"))
    up_to = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_b", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"),
                     F.sum("_n").over(Window.partitionBy()).alias("_m"))
    inside = Window.partitionBy("_b").orderBy(p)
    ranked = (t.join(F.broadcast(tot), "_b")
              .withColumn("_rank", F.col("_before") + F.sum(weight).over(
                  inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("_raw", F.col(p) * F.col("_m") / F.col("_rank")))
    floor_ = ranked.groupBy("_b").agg(F.min("_raw").alias("_f"))
    larger = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    floor_ = floor_.select("_b", F.min("_f").over(larger).alias("_floor"))
    down = Window.partitionBy("_b").orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranked.join(F.broadcast(floor_), "_b")
            .withColumn("q_value", F.least(F.lit(1.0), F.min("_raw").over(down), F.col("_floor")))
            .drop("_b", "_before", "_m", "_rank", "_raw", "_floor"))
