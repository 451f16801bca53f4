"""Exact identity: one entity per distinct sequence, and joins on that identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.functions.fixed import TRANSFER_CLASSES

ID_HEX_CHARS = 32


def sequence_id(seq) -> Column:
    """First 32 hex digits of the SHA-256 of the sequence, trailing '*' dropped."""
    c = seq if isinstance(seq, Column) else F.col(seq)
    return F.substring(F.sha2(F.regexp_replace(c, r"\*+$", ""), 256), 1, ID_HEX_CHARS)


def entity_map(items: DataFrame, seq: str = "seq", keep=("orf_id", "plasmid_id")) -> DataFrame:
    """The lossless one-to-many map, one row per item: (seq_id, *keep). A projection, no shuffle."""
    return items.select(sequence_id(seq).alias("seq_id"), *keep)


def dereplicate(items: DataFrame, seq: str = "seq", item: str = "orf_id") -> DataFrame:
    """One row per entity: the sequence, its copy count and its smallest item id.

    Every aggregate is partial, so a sequence held by a third of all items shuffles one row
    per map task. The item list itself stays exploded in :func:`entity_map`.
    """
    return (items.withColumn("seq_id", sequence_id(seq)).groupBy("seq_id")
            .agg(F.min(seq).alias("seq"), F.count(F.lit(1)).alias("n_items"),
                 F.min(item).alias("first_item")))


def identity_join(foreign: DataFrame, ours: DataFrame, seq: str = "seq") -> DataFrame:
    """Foreign rows whose sequence is one of ours (``ours`` holds seq_id)."""
    return foreign.withColumn("seq_id", sequence_id(seq)).join(
        ours.select("seq_id").distinct(), "seq_id", "left_semi")


def best_class_reduce(rows: DataFrame, key: str, cls: str, order, fields, flag: str | None = None,
                      ranks=TRANSFER_CLASSES) -> DataFrame:
    """Per key the most informative class over its rows, ties to the smallest ``order``.

    ``fields`` come from the winning row; ``n_rows`` counts all rows; ``flag`` is OR-ed.
    """
    rank = F.coalesce(*[F.when(F.col(cls) == c, F.lit(i)) for i, c in enumerate(ranks)], F.lit(len(ranks)))
    win = F.min_by(F.struct(cls, *fields), F.struct(rank, *[F.col(o) for o in order]))
    aggs = [win.alias("_w"), F.count(F.lit(1)).alias("n_rows")]
    if flag:
        aggs.append(F.max(flag).alias(flag))
    return rows.groupBy(key).agg(*aggs).select(
        key, *[F.col(f"_w.{c}").alias(c) for c in (cls, *fields)], "n_rows", *([flag] if flag else []))
