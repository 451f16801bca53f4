"""Folds, and the bounded sample of labelled rows that a classifier is fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame


def in_fold(mod: int, rest: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``rest`` modulo ``mod``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int,
                    max_chars: int) -> tuple[DataFrame, dict[int, int]]:
    """(rows (doc_id, y, text) to fit on, labelled rows per class outside the held-out fold).

    At most ``per_class`` documents of each class, chosen by a hash of doc_id among the labelled
    ids outside the fold; of these, texts up to ``max_chars`` characters. A doc_id labelled twice
    counts with its larger label, one with several texts with the smallest text.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out)
             .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in sorted(counts):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        return None, {}
    # at most 2 * per_class rows: bounded by the parameter
    texts = (doc_frame(docs).filter(F.length("text") <= max_chars).join(F.broadcast(chosen), "doc_id")
             .groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    return texts, counts
