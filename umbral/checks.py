"""Contracts that raise. Each is one aggregate; only counts and a few examples reach Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ContractError(ValueError):
    """An input breaks a rule the result depends on."""


def _examples(df: DataFrame, cols, n=3):
    return [tuple(r) for r in df.select(*cols).limit(n).collect()]


def require_unique(df: DataFrame, *key: str, what: str = "row") -> DataFrame:
    """Raise when ``key`` repeats; returns ``df`` for chaining."""
    dup = df.groupBy(*key).count().filter("count > 1")
    found = _examples(dup, key)
    if found:
        raise ContractError(f"duplicate {what} for {key}, e.g. {found}")
    return df


def require_nonempty(df: DataFrame, what: str) -> DataFrame:
    if df.limit(1).count() == 0:
        raise ContractError(f"{what}: no rows, every later table would be well-formed and empty")
    return df


def require_columns(df: DataFrame, cols, what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ContractError(f"{what} lacks the columns {missing}")
    return df


def require_all_in(left: DataFrame, right: DataFrame, key: str, what: str) -> DataFrame:
    """Raise when a key of ``left`` is missing from ``right``; absent keys are never guessed."""
    lost = left.select(key).distinct().join(right.select(key), key, "left_anti")
    found = _examples(lost, [key])
    if found:
        raise ContractError(f"{what}: {lost.count()} {key} value(s) missing, e.g. "
                            f"{[r[0] for r in found]}")
    return left


def set_agreement(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row with the distinct-key counts: in both, only left, only right."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("n_both"),
        F.count_if(F.col("_r").isNull()).alias("n_left_only"),
        F.count_if(F.col("_l").isNull()).alias("n_right_only"))


def require_same_set(left: DataFrame, right: DataFrame, key: str, what: str) -> None:
    row = set_agreement(left, right, key).first()
    if row.n_left_only or row.n_right_only:
        raise ContractError(f"{what}: the sets differ ({row.n_left_only} only left, "
                            f"{row.n_right_only} only right)")


def drift(df: DataFrame, declared: float, tolerance: float = 0.02) -> DataFrame:
    """Declared against actual row count: one row with the relative drift and a verdict."""
    n = F.count(F.lit(1))
    return df.agg(F.lit(declared).cast("double").alias("declared"), n.alias("actual"),
                  F.round(F.abs(F.lit(declared) - n) / n, 6).alias("drift"),
                  (F.abs(F.lit(declared) - n) / n > tolerance).cast("int").alias("exceeds"))


def require_no_drift(df: DataFrame, declared: float, tolerance: float = 0.02) -> None:
    row = drift(df, declared, tolerance).first()
    if not row.actual:
        raise ContractError("cannot check a declared size against an empty set")
    if row.exceeds:
        raise ContractError(f"declared {declared} but the set holds {row.actual} "
                            f"({row.drift:.1%} drift); declare {row.actual}")
