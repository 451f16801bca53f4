"""The catalogue of registered queries: each is a Spark callable and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from umbral.session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``tables`` reads the driver's parquet lazily."""
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


class Tables:
    """``t.lineitem`` is the parquet table of that name under the data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self._made = spark, sf_dir, {}

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()`` written as a table the first time this query asks for ``name``, and read by all later uses."""
        if name not in self._made:
            self._made[name] = cut(build())
        return self._made[name]

    def kept(self, name: str) -> DataFrame | None:
        """What :meth:`once` has written under ``name`` so far, if anything."""
        return self._made.get(name)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
