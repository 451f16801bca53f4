"""Helpers shared by the corpus operators: Arrow word splitting, bounded slices, shared intermediates."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbral.session import ensure_checkpoint_dir, ship_package  # noqa: F401

#: Text bytes that a Python worker works on at a time; a longer single text makes a slice of its own.
SLICE_BYTES = 6 << 20
#: The same where a slice's intermediates are many times its text.
SMALL_SLICE_BYTES = 2 << 20


_MULT, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def doc_frame(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id and text (null: empty) of ``docs``, with the further ``columns`` named."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *columns)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in slices of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        group = np.cumsum(size) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        at = 0
        for end in [*edges.tolist(), batch.num_rows]:
            if end > at:
                yield batch.slice(at, end - at)
            at = end


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task, and what it holds counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # a C library without it
        pass


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words): the runs of characters other than space and \\t to \\r, for each text in turn."""
    parts = pc.ascii_split_whitespace(text)
    flat = parts.flatten()
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.binary_length(flat), dtype=np.int64) > 0
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return offsets, flat


def unique_words(words: pa.Array) -> tuple[np.ndarray, list[str]]:
    """(index of each word among the distinct ones, the distinct words)."""
    coded = words.dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary.to_pylist()


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``offsets``; an empty stretch sums to 0."""
    total = np.concatenate([np.zeros(1, dtype=np.float64 if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def list_array(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def repeated_words(code: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Per text, the words inside ``width``-word windows that occur twice or more in that text."""
    n = len(code)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(np.arange(n) + width <= offsets[1:][text]) if n else np.zeros(0, np.int64)
    if not len(start):
        return np.zeros(len(offsets) - 1, np.int64)
    mixed = (code.astype(np.uint64) + np.uint64(1)) * _MULT
    mixed ^= mixed >> np.uint64(32)
    h = text[start].astype(np.uint64) * _SALT
    for k in range(width):
        h = (h ^ mixed[start + k]) * _MULT
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    edge = np.zeros(n + 1, np.int64)
    edge[start[twice]] += 1
    np.add.at(edge, start[twice] + width, -1)
    return segment_sum((np.cumsum(edge[:-1]) > 0).astype(np.int64), offsets)


def hashed_share(df: DataFrame, n: int, total: int, *key: str) -> DataFrame:
    """About ``n`` of the ``total`` rows of ``df``, the same ones on every run: those whose key hashes low."""
    share = min(1.0, n / max(total, 1))
    return df.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30)))


def materialise(df: DataFrame) -> tuple[DataFrame, str]:
    """(``df`` written once under the session's checkpoint folder and read back, its path).

    Like a checkpoint it survives lost executors and cuts the lineage; later readers prune columns.
    Spark drops a finished query's shuffle files when the driver collects its garbage, which it may
    not do for long; it is asked to, so that the files of one step are gone while the next one runs.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path), path
