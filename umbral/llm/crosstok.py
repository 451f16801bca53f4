"""Alignment of two tokenizations of a text by divide and conquer at shared cuts.

A token sequence cuts the bytes of its text; where both sequences cut at the same byte, what lies before
aligns with what lies before. An interval is divided at a cut both share near its middle, found by
bisection: from the middle byte the next end of A, from there the next end of B, and so on in turns until
both name one byte; to the right first, then to the left. Both halves are divided alike. An interval
without an inner shared cut is a leaf, a group of the alignment. The intervals of all texts of a slice are
divided together, level by level, so one bisection is one sorted search over arrays.

How often two ids end together is a statistic of all texts: the first pass writes every document's linked
id pairs once, with how often each occurs there; the second counts them over the table and gives every
document its sums by one join.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, materialise, ship_package, slices
from umbral.llm.wordcache import WordEncoder, _joined


@dataclass(frozen=True)
class CrossSpec:
    """``byte_path``: byte-level vocabulary of the tokenizers library; ``piece_path``: sentencepiece model.

    ``slice_bytes`` is the text a worker aligns at a time; the table of pair counts is broadcast when it
    has at most ``broadcast_pairs`` rows and otherwise left to a shuffled join.
    """
    byte_path: str
    piece_path: str
    slice_bytes: int = 2 << 20
    broadcast_pairs: int = 1 << 21


# ---- the two tokenizers -------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable ones stand for themselves, the rest follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class SpacedBytes(WordEncoder):
    """Ids of space + text. Words cut at single spaces are encoded once each, other texts whole; no string is special."""

    def __init__(self, path: str, cache_words: int = 300_000):
        super().__init__(path, "leading", cache_words)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        letter = byte_alphabet()
        vocab = {i: t for t, i in self.tokenizer.get_vocab().items()}
        added = self.tokenizer.get_added_tokens_decoder()
        self.bytes = [added[i].content.encode() if i in added else bytes(letter[c] for c in vocab.get(i, "")) for i in range(max(vocab) + 1)]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = pc.split_pattern(text, " ")
        offsets = np.asarray(parts.offsets, np.int64)
        offsets = offsets - offsets[0]
        coded = parts.flatten().dictionary_encode()
        code, words = np.asarray(coded.indices, np.int64), coded.dictionary
        risky = np.asarray(pc.or_(pc.not_equal(pc.utf8_trim_whitespace(words), words), pc.equal(words, "")), bool)
        spoilt = np.add.reduceat(risky[code].astype(np.int64), offsets[:-1]) > 0
        if not spoilt.any():
            return self._gather(code, offsets, [" " + w for w in words.to_pylist()])
        good, bad = np.flatnonzero(~spoilt), np.flatnonzero(spoilt)
        rows = [None] * len(spoilt)
        if len(good):
            o, ids = self.encode(text.take(pa.array(good)))
            for k, i in enumerate(good.tolist()):
                rows[i] = ids[o[k]:o[k + 1]]
        for i, ids in zip(bad.tolist(), self.whole([" " + t for t in text.take(pa.array(bad)).to_pylist()])):
            rows[i] = ids
        return _joined(rows)


class Pieces:
    """Ids of a sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.bytes = [bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i)
                      else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return _joined([np.array(x, np.uint32) for x in self.model.encode(text.to_pylist(), num_threads=1)])


# ---- divide and conquer -------------------------------------------------------------------

def shared_cuts(a: np.ndarray, b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The ends that ``a`` and ``b`` share, ascending, ``edges`` among them.

    ``a`` and ``b`` are strictly ascending byte offsets; every interval between two consecutive
    ``edges`` is divided by itself, and all but the first of them are ends of both.
    """
    low, high = edges[:-1], edges[1:]
    found = [high]
    while len(low):
        # one token on a side leaves nothing to divide
        first_a, first_b = np.searchsorted(a, low, "right"), np.searchsorted(b, low, "right")
        inner = (a[first_a] < high) & (b[first_b] < high)
        low, high = low[inner], high[inner]
        if not len(low):
            break
        middle = (low + high) >> 1
        cut = _next_shared(a, b, middle, high)
        missed = np.flatnonzero(cut == high)
        if len(missed):
            cut[missed] = _last_shared(a, b, middle[missed], low[missed])
        split = cut > low
        low, high, cut = low[split], high[split], cut[split]
        found.append(cut)
        low, high = np.stack([low, cut], 1).ravel(), np.stack([cut, high], 1).ravel()
    return np.sort(np.concatenate(found))


def _next_shared(a, b, start, high):
    """The first end of both at or after ``start``; ``high`` is one."""
    cut, open_ = high.copy(), np.arange(len(start))
    at = start
    while len(open_):
        x = a[np.searchsorted(a, at)]
        y = b[np.searchsorted(b, x)]
        same = x == y
        cut[open_[same]] = x[same]
        open_, at = open_[~same], y[~same]
    return cut


def _last_shared(a, b, start, low):
    """The last end of both before ``start`` and after ``low``; ``low`` where there is none."""
    cut, open_ = low.copy(), np.arange(len(start))
    at, floor = start - 1, low
    while len(open_):
        i = np.searchsorted(a, at, "right") - 1
        x = np.where(i >= 0, a[np.maximum(i, 0)], floor)
        j = np.searchsorted(b, x, "right") - 1
        y = np.where(j >= 0, b[np.maximum(j, 0)], floor)
        same = (x == y) & (y > floor)
        cut[open_[same]] = x[same]
        more = ~same & (y > floor)
        open_, at, floor = open_[more], y[more], floor[more]
    return cut


# ---- one slice ----------------------------------------------------------------------------

def _byte_table(tokens: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    return pa.array(tokens, pa.large_binary()), np.fromiter(map(len, tokens), np.int64, len(tokens))


def _flat(table: pa.Array, index: np.ndarray) -> np.ndarray:
    """The entries of ``table`` named by ``index``, one after the other, as bytes."""
    taken = table.take(pa.array(index))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset:taken.offset + len(taken) + 1]
    return np.frombuffer(taken.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]


class Aligner:
    def __init__(self, spec: CrossSpec):
        self.a, self.b = SpacedBytes(spec.byte_path), Pieces(spec.piece_path)
        self.a_bytes, self.a_size = _byte_table(self.a.bytes)
        self.b_bytes, self.b_size = _byte_table(self.b.bytes)
        # an id as digits and what follows it: inside a group, or at the end of its side
        names = [b"%d%c" % (i, c) for n, last in ((len(self.a.bytes), b"|"), (len(self.b.bytes), b";")) for i in range(n) for c in (b",", last)]
        self.names, self.name_size = _byte_table(names)

    def align(self, text: pa.Array) -> dict[str, np.ndarray | list]:
        """Per text: n_a, n_b, n_groups, groups_sha256 and (pairs, times), its linked id pairs."""
        n = len(text)
        out = {"n_a": np.zeros(n, np.int64), "n_b": np.zeros(n, np.int64), "n_groups": np.zeros(n, np.int64), "groups_sha256": [""] * n,
               "offsets": np.zeros(n + 1, np.int64), "pairs": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)}
        rows = np.flatnonzero(np.asarray(pc.binary_length(text)) > 0)
        if not len(rows):
            return out
        text = text.take(pa.array(rows))
        (oa, ia), (ob, ib) = self.a.encode(text), self.b.encode(text)
        good = self._whole(text, oa, ia, ob, ib)
        if not good.all():
            ia, ib = ia[np.repeat(good, np.diff(oa))], ib[np.repeat(good, np.diff(ob))]
            oa, ob = (np.concatenate([[0], np.cumsum(np.diff(o)[good])]) for o in (oa, ob))
            rows = rows[good]
            if not len(rows):
                return out
        ends_a, ends_b = np.cumsum(self.a_size[ia]), np.cumsum(self.b_size[ib])
        cuts = shared_cuts(ends_a, ends_b, np.concatenate([[0], ends_a[oa[1:] - 1]]))
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        doc = np.searchsorted(oa, last_a, "right") - 1
        out["n_a"][rows], out["n_b"][rows] = np.diff(oa), np.diff(ob)
        out["n_groups"][rows] = np.bincount(doc, minlength=len(rows))
        for i, digest in zip(rows.tolist(), self._digests(ia, ib, last_a, last_b, oa, ob)):
            out["groups_sha256"][i] = digest
        kinds, kind = np.unique(ia[last_a].astype(np.int64) << 32 | ib[last_b].astype(np.int64), return_inverse=True)
        key, times = np.unique(doc * len(kinds) + kind, return_counts=True)
        held = np.zeros(n, np.int64)
        held[rows] = np.bincount(key // len(kinds), minlength=len(rows))
        out["offsets"], out["pairs"], out["times"] = np.concatenate([[0], np.cumsum(held)]), kinds[key % len(kinds)], times
        return out

    def _whole(self, text, oa, ia, ob, ib) -> np.ndarray:
        """Whether the bytes of both sides' tokens are space + text."""
        want = _flat(pc.binary_join_element_wise("", text, " ").cast(pa.large_binary()), np.arange(len(text)))
        size = np.asarray(pc.binary_length(text), np.int64) + 1
        start = np.cumsum(size) - size
        good = np.ones(len(text), bool)
        for table, length, offsets, ids in ((self.a_bytes, self.a_size, oa, ia), (self.b_bytes, self.b_size, ob, ib)):
            have = _flat(table, ids)
            if len(have) == len(want) and np.array_equal(have, want):
                continue
            ends = np.concatenate([[0], np.cumsum(length[ids])])[offsets]
            for i in range(len(text)):
                good[i] &= np.array_equal(have[ends[i]:ends[i + 1]], want[start[i]:start[i] + size[i]])
        return good

    def _digests(self, ia, ib, last_a, last_b, oa, ob) -> Iterator[str]:
        """Digest of each text's groups written out: the ids of A, then those of B, group by group."""
        end_a, end_b = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
        end_a[last_a], end_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
        name = np.empty(len(ia) + len(ib), np.int64)
        name[np.arange(len(ia)) + np.concatenate([[0], last_b + 1])[group_a]] = 2 * ia.astype(np.int64) + end_a
        name[np.arange(len(ib)) + (last_a + 1)[group_b]] = 2 * (len(self.a.bytes) + ib.astype(np.int64)) + end_b
        flat = _flat(self.names, name)
        ends = np.concatenate([[0], np.cumsum(self.name_size[name])])[oa + ob]
        for i in range(len(oa) - 1):
            yield hashlib.sha256(flat[ends[i]:ends[i + 1] - 1]).hexdigest()


_ALIGNERS: dict[CrossSpec, Aligner] = {}

_ALIGNED = "doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, spec: CrossSpec) -> DataFrame:
    """One row per document: its counts, the digest of its groups and its linked id pairs (a << 32 | b) with how often each occurs."""
    ship_package(docs.sparkSession)
    rows = doc_frame(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _ALIGNERS.get(spec) or _ALIGNERS.setdefault(spec, Aligner(spec))
        for part in slices(batches, limit=spec.slice_bytes):
            x = aligner.align(part.column("text"))
            lists = [pa.ListArray.from_arrays(pa.array(x["offsets"], pa.int32()), pa.array(x[c])) for c in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(x["n_a"]), pa.array(x["n_b"]), pa.array(x["n_groups"]),
                                              pa.array(x["groups_sha256"], pa.string()), *lists],
                                             names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    return rows.mapInArrow(run, _ALIGNED.format(id=rows.schema["doc_id"].dataType.simpleString()))


def link_counts(linked: DataFrame) -> DataFrame:
    """(pair, count, best): how many links hold the pair, and whether no pair of its B id has more."""
    one = linked.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts, _ = materialise(one.groupBy("pair").agg(F.sum("times").alias("count")))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b")
    top = counts.groupBy(b).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(top, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def cross_tokens(docs: DataFrame, spec: CrossSpec) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document.

    Null and empty texts, and texts that a side's tokens do not spell, have zeros and an empty digest;
    they count nowhere. Ties for the most frequent pair of a B id are all best. Rows that repeat count
    each and stay rows of their own, a null doc_id stays null; an empty table gives no rows. Only doc_id
    and text are read, so further columns may have any name. Memory grows with the longest single text.
    """
    linked, _ = materialise(aligned(docs, spec).withColumn("row", F.monotonically_increasing_id()))
    counts, _ = materialise(link_counts(linked))
    if counts.count() <= spec.broadcast_pairs:
        counts = F.broadcast(counts)
    each = (linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
            .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times")).join(counts, "pair"))
    sums = each.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return linked.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
