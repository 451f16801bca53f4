"""N-gram Jaccard join: documents whose shingle sets overlap enough, found through a count-vector R-tree.

Every set is also a point: its shingles are hashed into groups, and the counts per group are the
coordinates. Two sets share at most the sum over the groups of the smaller count, and a box of points
shares with another box at most that sum over the boxes' upper corners; what is below the overlap that
the threshold asks for is pruned, from pairs of boxes down to pairs of points, and only pairs that
survive are verified on the sets themselves.

To be searched on many machines, points are first dealt to cells: a cell is a shingle, and a set
is in the cells of its n - ceil(t n) + 1 first shingles in one order for all, so two sets that are
similar enough meet in some cell. The order puts shingles that many documents share last, by counts
over the whole corpus; it decides how full cells are, never whether a pair is found. Equal sets are one
point. Sets of a cell are linked to one head per band of sizes first; afterwards the R-tree of a cell
only looks for links between components that are still apart, which are the only ones that can
change the result. A full cell is split into pairs of blocks.

Defined cases: a null text is an empty one; a text without words has an empty set and is linked with
nothing; with fewer words than a shingle has, the whole sequence is the only shingle; rows of one
doc_id are one document and share a component; rows without an id are linked with nothing and have no
component; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbral.llm.common import SMALL_SLICE_BYTES, delete_path, doc_frame, give_back, list_array, materialise, slices, split_words
from umbral.operators.graph import connected_components

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Which bits the first 0 to 8 bytes of eight are; bytes of a word that is hashed on its own.
_MASKS, _LONG = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64), 64


@dataclass(frozen=True)
class JaccardSpec:
    width: int = 5                # words of a shingle
    percent: int = 80             # 100 * intersection >= percent * union
    groups: int = 256             # coordinates of a point
    leaf: int = 16                # points, or boxes, that make a box
    block: int = 512              # points of a cell that one task compares with as many others
    common: int = 1 << 19         # shingles ordered by their counts, at most; all others come first
    early: int = 16               # first shared cells of a set by which a pair knows that an earlier cell has it
    star_rounds: int = 4          # at most; none follows a round that finds no link


def word_hashes(words: pa.Array) -> np.ndarray:
    """A number for each word, equal for equal words: eight bytes of all words at a time; long words one by one."""
    wide = np.int64 if pa.types.is_large_string(words.type) else np.int32
    if not len(words):
        return np.zeros(0, np.uint64)
    _, starts, data = words.buffers()
    edge = np.frombuffer(starts, wide)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    at, left = edge[:-1], np.diff(edge)
    out = left.astype(np.uint64) * _B
    long = np.flatnonzero(left > _LONG)
    row = np.flatnonzero(left <= _LONG) if len(long) else np.arange(len(out))
    while len(row):
        some = left[row]
        h = eight[at[row]] & _MASKS[np.minimum(some, 8)]
        h ^= out[row]
        for shift, by in ((32, _A), (29, _B)):
            h ^= h >> np.uint64(shift)
            h *= by
        h ^= h >> np.uint64(32)
        out[row] = h
        row = row[some > 8]
        at, left = at + 8, left - 8
    for i in long.tolist():
        out[i] = xxhash.xxh3_64_intdigest(raw[edge[i]:edge[i + 1]])
    return out


def shingle_sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the distinct shingles of every text, ascending as unsigned numbers."""
    offsets, words = split_words(text)
    w = word_hashes(pc.ascii_lower(words))
    n = np.diff(offsets)
    many = max(len(w) - width + 1, 0)
    h = np.full(many, width, np.uint64)
    for k in range(width):
        h ^= w[k:k + many]
        h *= _A
        h ^= h >> np.uint64(32)
    inside = np.ones(many, bool)        # shingles that do not run into the next text
    for k in range(1, width):
        last = offsets[1:] - k
        inside[last[(n >= k) & (last < many)]] = False
    h = h[inside]
    short = np.flatnonzero((n > 0) & (n < width))
    edge = np.concatenate([[0], np.cumsum(np.where(n < width, n > 0, n - width + 1))]).astype(np.int64)
    if len(short):
        s = n[short].astype(np.uint64) + np.uint64(1 << 20)
        for k in range(width - 1):
            has = n[short] > k
            s[has] = (s[has] ^ w[offsets[short[has]] + k]) * _A
            s ^= s >> np.uint64(32)
        h = np.insert(h, edge[short] - np.arange(len(short)), s)
    sort_each(edge, h)
    keep = np.ones(len(h), bool)
    keep[1:] = h[1:] != h[:-1]
    keep[edge[:-1][np.diff(edge) > 0]] = True
    return np.concatenate([[0], np.cumsum(keep)])[edge].astype(np.int64), h[keep]


def sort_each(offsets: np.ndarray, values: np.ndarray) -> None:
    """Sort, in place, what stands between consecutive ``offsets``."""
    edge = offsets.tolist()
    for start, end in zip(edge, edge[1:]):
        values[start:end].sort()


def class_of(offsets: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A number for each set, equal for equal sets."""
    mixed = (h ^ (h >> np.uint64(31))) * _B
    both = []
    for x in (mixed, (mixed ^ (mixed >> np.uint64(29))) * _A):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x)])
        both.append(total[offsets[1:]] - total[offsets[:-1]])
    out = (both[0] ^ (both[1] >> np.uint64(7)) ^ (both[1] << np.uint64(57))) * _A + np.diff(offsets).astype(np.uint64) * _B
    return (out ^ (out >> np.uint64(32))).view(np.int64)


def count_vectors(offsets: np.ndarray, h: np.ndarray, groups: int) -> np.ndarray:
    """The point of every set: its shingles per group."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cell = row * groups + ((h * _B) >> np.uint64(40)).astype(np.int64) % groups
    return np.bincount(cell, minlength=(len(offsets) - 1) * groups).reshape(-1, groups)


def pack_vectors(vec: np.ndarray) -> pa.Array:
    """Points as bytes, in the narrowest width that holds their counts."""
    top = vec.max(axis=1, initial=0)
    return pa.array([v.astype("<u1" if t < 256 else "<u2" if t < 65536 else "<u4").tobytes() for v, t in zip(vec, top.tolist())], pa.binary())


def unpack_vectors(column, groups: int) -> np.ndarray:
    cells = column.to_pylist()
    if all(len(c) == groups for c in cells):
        return np.frombuffer(b"".join(cells), np.uint8).reshape(-1, groups)
    return np.stack([np.frombuffer(c, f"<u{len(c) // groups}").astype(np.uint32) for c in cells])


def frequent_shingles(frame: DataFrame, spec: JaccardSpec) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, levels) of at most ``common`` shingles that many different sets hold, level rising with their number.

    A slice of some documents reports shingles that two of its sets share; reports are summed over the corpus.
    """
    def run(batches):
        for batch in slices(batches, limit=8 * SMALL_SLICE_BYTES):
            parts, seen = [], set()
            for part in slices(iter([batch]), limit=SMALL_SLICE_BYTES):
                offsets, h = shingle_sets(part.column("text"), spec.width)
                new = np.zeros(len(offsets) - 1, bool)
                for i, c in enumerate(class_of(offsets, h).tolist()):
                    if c not in seen:
                        seen.add(c)
                        new[i] = True
                parts.append(h[np.repeat(new, np.diff(offsets))])
            h = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            count = np.diff(np.append(start, len(h)))
            more = count > 1
            yield pa.record_batch([pa.array(h[start[more]].view(np.int64)), pa.array(count[more])], names=["h", "n"])
        give_back()

    found = frame.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    found = found.withColumn("level", F.floor(F.log2("n")).cast("int"))
    found, path = materialise(found)
    sizes = {r["level"]: r["c"] for r in found.groupBy("level").agg(F.count(F.lit(1)).alias("c")).collect()}
    least, total = max(sizes, default=0) + 1, 0
    for level in sorted(sizes, reverse=True):
        if total + sizes[level] > spec.common:
            break
        least, total = level, total + sizes[level]
    table = found.filter(F.col("level") >= least).select("h", "level").toArrow()
    delete_path(frame.sparkSession, path)
    h = np.asarray(table.column("h").combine_chunks(), np.int64).view(np.uint64) if len(table) else np.zeros(0, np.uint64)
    level = np.asarray(table.column("level").combine_chunks(), np.uint8) if len(table) else np.zeros(0, np.uint8)
    order = np.argsort(h)
    return h[order], level[order]


def points(frame: DataFrame, spec: JaccardSpec) -> DataFrame:
    """(doc_id, n, cls, vec, cells): size, class, point and cells of the set of every row."""
    shared = frame.sparkSession.sparkContext.broadcast(frequent_shingles(frame, spec))

    def run(batches):
        known, level = shared.value
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            offsets, h = shingle_sets(batch.column("text"), spec.width)
            n = np.diff(offsets)
            rank = np.zeros(len(h), np.uint64)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                rank = np.where(known[at] == h, level[at], 0).astype(np.uint64)
            # one order for all: rare first, then by a mixed hash, which the key keeps
            key = h * _B
            key ^= key >> np.uint64(33)
            key >>= np.uint64(8)
            key |= rank << np.uint64(56)
            sort_each(offsets, key)
            keep = n - -(-spec.percent * n // 100) + 1
            keep = np.where(n > 0, keep, 0)
            first = np.repeat(offsets[1:] - n - (np.cumsum(keep) - keep), keep) + np.arange(keep.sum())
            cell = ((key[first] & np.uint64((1 << 56) - 1)) >> np.uint64(8)).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(class_of(offsets, h)), pack_vectors(count_vectors(offsets, h, spec.groups)),
                                   list_array(np.concatenate([[0], np.cumsum(keep)]), cell, pa.int64())], names=["doc_id", "n", "cls", "vec", "cells"])
        give_back()

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, n long, cls long, vec binary, cells array<long>")


class Boxes:
    """A packed R-tree over points in order of size: level 0 holds the points, each further level boxes of ``leaf`` below."""

    def __init__(self, vec: np.ndarray, n: np.ndarray, comp: np.ndarray, rest: np.ndarray, leaf: int):
        spread = int(np.argmax(vec.astype(np.float64).var(axis=0))) if len(vec) > leaf else 0
        slab = np.argsort(n, kind="stable")
        place = np.empty(len(n), np.int64)
        place[slab] = np.arange(len(n)) // (leaf * leaf)
        self.order = np.lexsort((vec[:, spread], place))
        v, s, c = vec[self.order], n[self.order], comp[self.order]
        self.levels = [(v, s, s, rest[self.order], c, np.ones(len(c), bool))]
        while len(self.levels[-1][1]) > leaf:
            upper, low, high, rest, comp, one = self.levels[-1]
            at = np.arange(0, len(low), leaf)
            same = np.minimum.reduceat(comp, at) == np.maximum.reduceat(comp, at)
            self.levels.append((np.maximum.reduceat(upper, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(rest, at), comp[at],
                                same & np.logical_and.reduceat(one, at)))
        self.leaf = leaf


def _may_link(a, b, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of boxes (i of a, j of b) may hold a pair of points that are similar enough and in different components.

    ``rest`` is what a set has from the cell's shingle on: where that is the first one two sets share,
    they share no more than that. A pair that a later cell drops for it is kept by its first one.
    """
    (upper_a, low_a, high_a, rest_a, comp_a, one_a), (upper_b, low_b, high_b, rest_b, comp_b, one_b) = a, b
    ok = (100 * high_a[i] >= percent * low_b[j]) & (100 * high_b[j] >= percent * low_a[i]) & ~(one_a[i] & one_b[j] & (comp_a[i] == comp_b[j]))
    ok &= (100 + percent) * np.minimum(rest_a[i], rest_b[j]) >= percent * (low_a[i] + low_b[j])
    out = np.flatnonzero(ok)
    keep = []
    for at in range(0, len(out), 1 << 14):
        x, y = i[out[at:at + (1 << 14)]], j[out[at:at + (1 << 14)]]
        shared = np.minimum(upper_a[x], upper_b[y]).sum(axis=1, dtype=np.int64)
        keep.append((100 + percent) * shared >= percent * (low_a[x] + low_b[y]))
    ok[out] = np.concatenate(keep) if keep else False
    return ok


def tree_pairs(vec: np.ndarray, n: np.ndarray, comp: np.ndarray, rest: np.ndarray, side: np.ndarray, spec: JaccardSpec) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one cell that no box rules out; with two sides only pairs across them."""
    tree = Boxes(vec, n, comp, rest, spec.leaf)
    top = tree.levels[-1]
    i, j = np.triu_indices(len(top[1]))
    for depth in range(len(tree.levels) - 1, -1, -1):
        level = tree.levels[depth]
        if depth < len(tree.levels) - 1:
            size, k = len(level[1]), spec.leaf
            i, j = np.repeat(i, k * k), np.repeat(j, k * k)
            step = np.arange(len(i)) % (k * k)
            i, j = i * k + step // k, j * k + step % k
            fit = (i < size) & (j < size) & (i <= j)
            i, j = i[fit], j[fit]
        if depth == 0:
            fit = i < j
            i, j = i[fit], j[fit]
        ok = _may_link(level, level, i, j, spec.percent)
        i, j = i[ok], j[ok]
    i, j = tree.order[i], tree.order[j]
    if len(side) and side.max() != side.min():
        fit = side[i] != side[j]
        i, j = i[fit], j[fit]
    return i, j


def small_cells(edge: np.ndarray, vec: np.ndarray, n: np.ndarray, comp: np.ndarray, rest: np.ndarray, spec: JaccardSpec) -> tuple[np.ndarray, np.ndarray]:
    """As ``tree_pairs`` for many cells of at most one leaf each, given by their edges."""
    size = np.diff(edge)
    left = np.repeat(edge[1:], size) - 1 - np.arange(edge[-1])      # later rows of the cell
    i = np.repeat(np.arange(edge[-1]), left)
    j = i + 1 + (np.arange(len(i)) - np.repeat(np.cumsum(left) - left, left))
    level = (vec, n, n, rest, comp, np.ones(len(n), bool))
    ok = _may_link(level, level, i, j, spec.percent)
    return i[ok], j[ok]


def bounded(pairs: DataFrame, info: DataFrame, spec: JaccardSpec) -> DataFrame:
    """Those (a, b) of ``pairs`` that the bound on their points leaves; info: (cls, n, vec)."""
    side = lambda c: info.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("vec").alias(f"v{c}"))

    def run(batches):
        for batch in batches:
            va, vb = unpack_vectors(batch.column("va"), spec.groups), unpack_vectors(batch.column("vb"), spec.groups)
            na, nb = np.asarray(batch.column("na"), np.int64), np.asarray(batch.column("nb"), np.int64)
            at, apart = np.arange(len(na)), np.zeros(len(na), bool)
            ok = _may_link((va, na, na, na, at, apart), (vb, nb, nb, nb, at, apart), at, at, spec.percent)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def not_earlier(early: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a pair of rows of one cell has no common cell before it among the first cells of both.

    ``early`` has the first cells of each row's set in the common order (padded, by numbers that no two rows
    share), ``at`` how many of them precede the row's own cell. The pair is handed over by the first of its
    common cells in these lists, and by every cell after it only where the lists do not show that one.
    """
    out = np.ones(len(i), bool)
    width = np.arange(early.shape[1])
    for s in range(0, len(i), 1 << 13):
        a, b = i[s:s + (1 << 13)], j[s:s + (1 << 13)]
        same = early[a][:, :, None] == early[b][:, None, :]
        same &= (width[None, :] < at[a][:, None])[:, :, None] & (width[None, :] < at[b][:, None])[:, None, :]
        out[s:s + len(a)] = ~same.any(axis=(1, 2))
    return out


def cell_candidates(rows: DataFrame, spec: JaccardSpec) -> DataFrame:
    """(a, b): pairs of classes of different components that share a cell and survive its R-tree.

    ``rows``: (cell, _n rows in it, cls, its place pos there, n, vec, comp, early: the first shared cells of cls). A cell of more than ``block`` rows becomes
    pairs of blocks; the parts are streamed in sorted order, so a task holds one part at a time.
    """
    blocks = F.ceil(F.col("_n") / spec.block).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    with_ = F.explode(F.sequence(F.lit(0), blocks - 1))
    parts = (rows.withColumn("_own", own).withColumn("_other", with_)
             .select("cell", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "cls", "n", (F.col("n") - F.col("pos")).alias("rest"), "vec", "comp", "early"))
    parts = parts.repartition("cell", "_i", "_j").sortWithinPartitions("cell", "_i", "_j")

    def flush(t: pa.Table):
        key = np.stack([np.asarray(t.column(c).combine_chunks(), np.int64) for c in ("cell", "_i", "_j")])
        edge = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [len(t)]])
        cls, n, comp, own, rest = (np.asarray(t.column(c).combine_chunks(), np.int64) for c in ("cls", "n", "comp", "_own", "rest"))
        vec = unpack_vectors(t.column("vec"), spec.groups)
        size = np.diff(edge)
        few = np.flatnonzero((size > 1) & (size <= spec.leaf))
        out = []
        if len(few):
            rows_ = np.concatenate([np.arange(edge[g], edge[g + 1]) for g in few])
            i, j = small_cells(np.concatenate([[0], np.cumsum(size[few])]), vec[rows_], n[rows_], comp[rows_], rest[rows_], spec)
            across = (key[1, rows_[i]] == key[2, rows_[i]]) | (own[rows_[i]] != own[rows_[j]])
            out.append((rows_[i][across], rows_[j][across]))
        for g in np.flatnonzero(size > spec.leaf):
            s = slice(edge[g], edge[g + 1])
            sides = own[s] if key[1, edge[g]] != key[2, edge[g]] else np.zeros(size[g], np.int64)
            i, j = tree_pairs(vec[s], n[s], comp[s], rest[s], sides, spec)
            out.append((i + edge[g], j + edge[g]))
        i = np.concatenate([o[0] for o in out]) if out else np.zeros(0, np.int64)
        j = np.concatenate([o[1] for o in out]) if out else np.zeros(0, np.int64)
        if len(i):
            lists = t.column("early").combine_chunks()
            held = np.diff(np.asarray(lists.offsets, np.int64))
            row, place = np.repeat(np.arange(len(t)), held), np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
            early, at = np.zeros((len(t), spec.early), np.int64), held.copy()
            early[row, place] = np.asarray(lists.flatten(), np.int64)
            own_cell = np.flatnonzero(early[row, place] == key[0][row])
            at[row[own_cell]] = place[own_cell]
            first = not_earlier(early, at, i, j)
            i, j = i[first], j[first]
        pair = np.unique(np.stack([np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])]), axis=1)
        return pa.record_batch([pa.array(pair[0]), pa.array(pair[1])], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            last = tuple(held.column(c)[len(held) - 1].as_py() for c in ("cell", "_i", "_j"))
            same = np.ones(len(held), bool)
            for c, v in zip(("cell", "_i", "_j"), last):
                same &= np.asarray(held.column(c).combine_chunks(), np.int64) == v
            whole = len(held) - int(same.sum())
            if whole:
                yield flush(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and len(held):
            yield flush(held)

    return parts.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def among(frame: DataFrame, ids: DataFrame, key: str, words: int = 1 << 17) -> DataFrame:
    """The rows of ``frame`` whose ``key`` is in ``ids``, and a few others: nothing of ``frame`` is shuffled.

    Each key sets one bit among 64 * ``words``, and this table of at most ``words`` numbers goes to every task.
    """
    hashed = F.xxhash64(key)
    word, bit = F.pmod(hashed, F.lit(words)), F.pmod(F.shiftright(hashed, 32), F.lit(64)).cast("int")
    bits = ids.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits"))
    return frame.withColumn("_word", word).join(F.broadcast(bits), "_word").filter(F.getbit("_bits", bit) == 1).select(*frame.columns)


def similar(pairs: DataFrame, frame: DataFrame, info: DataFrame, spec: JaccardSpec) -> DataFrame:
    """Those (a, b) of ``pairs`` whose sets are similar enough: the exact check, written as a table.

    The texts of the representatives of the classes that the pairs name are brought together, as they are
    shorter than their sets; which class a text has is seen from the text, so other texts do no harm.
    """
    spark = frame.sparkSession
    pairs, pairs_path = materialise(pairs)
    named = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    ids = info.join(named, "cls", "left_semi").select(F.col("rep").alias("doc_id"))

    def class_and_text(batches):
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            yield pa.record_batch([pa.array(class_of(*shingle_sets(batch.column("text"), spec.width))), batch.column("text")], names=["cls", "text"])
        give_back()

    def linked(batches):
        for batch in slices(batches, column="ta", limit=SMALL_SLICE_BYTES):
            cls = np.concatenate([np.asarray(batch.column(c), np.int64) for c in ("a", "b")])
            _, one, at = np.unique(cls, return_index=True, return_inverse=True)     # a class's set is made once
            offsets, h = shingle_sets(pa.concat_arrays([batch.column("ta"), batch.column("tb")]).take(pa.array(one)), spec.width)
            n, i, j = np.diff(offsets), at[:len(batch)], at[len(batch):]
            shared = np.fromiter((len(np.intersect1d(h[offsets[x]:offsets[x + 1]], h[offsets[y]:offsets[y + 1]], assume_unique=True)) for x, y in zip(i.tolist(), j.tolist())), np.int64, len(i))
            yield batch.select(["a", "b"]).filter(pa.array((100 + spec.percent) * shared >= spec.percent * (n[i] + n[j])))
        give_back()

    texts, texts_path = materialise(among(frame.filter(F.col("doc_id").isNotNull()), ids, "doc_id").select("text").mapInArrow(class_and_text, "cls long, text string"))
    texts = texts.groupBy("cls").agg(F.first("text").alias("text"))
    side = lambda c: texts.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}"))
    found, _ = materialise(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(linked, "a long, b long"))
    delete_path(spark, pairs_path)
    delete_path(spark, texts_path)
    return found


def near_duplicates(docs: DataFrame, spec: JaccardSpec = JaccardSpec()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest doc_id that links lead to."""
    spark = docs.sparkSession
    frame = doc_frame(docs)
    rows, _ = materialise(points(frame, spec))
    linked = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    info, info_path = materialise(linked.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("vec").alias("vec")))
    # a cell's rows carry the class alone; its size joins the few rows whose cell is shared
    cells = linked.groupBy("cls").agg(F.first("cells").alias("cells")).select(F.posexplode("cells").alias("pos", "cell"), "cls")
    in_cell = Window.partitionBy("cell")
    met = cells.withColumn("_n", F.count(F.lit(1)).over(in_cell)).filter("_n > 1").join(info.select("cls", "n"), "cls")
    met, met_path = materialise(met)
    meeting = met.select("cls").distinct()
    # rows of one doc_id are one document
    edges = (linked.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z"), F.collect_set("cls").alias("all")).filter("a <> z")
             .select("a", F.explode("all").alias("b")).filter("a <> b"))
    band = F.floor(F.log("n") / F.log(F.lit(100 / spec.percent))).cast("int")
    comp = meeting.select("cls", F.col("cls").alias("comp"))
    for star in range(spec.star_rounds):
        # every class of a cell against one head of its band of sizes, unless they are known to be linked
        known = met.join(comp, "cls").withColumn("_band", band)
        order = F.xxhash64("cls", F.pmod("cell", F.lit(4)), F.lit(star))      # a few heads for cells with the same members
        head = (known.groupBy("cell", "_band").agg(F.min_by(F.struct("cls", "comp"), order).alias("_head"), F.count(F.lit(1)).alias("_k")).filter("_k > 1")
                .select("cell", "_band", F.col("_head.cls").alias("head"), F.col("_head.comp").alias("_hc")))
        pairs = known.join(head, ["cell", "_band"]).filter("comp <> _hc").select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b")).distinct()
        found = similar(bounded(pairs, info, spec), frame, info, spec)
        if found.isEmpty():
            break
        edges, _ = materialise(edges.unionByName(found))
        comp, _ = materialise(connected_components(meeting, edges, "cls", component="comp"))
    apart = met.join(comp, "cls").withColumn("_low", F.min("comp").over(in_cell)).withColumn("_high", F.max("comp").over(in_cell)).filter("_low <> _high")
    apart, apart_path = materialise(apart.select("cell", "_n", "cls", "pos", "n", "comp"))
    early = apart.groupBy("cls").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "cell"))), 1, spec.early)["cell"].alias("early"))
    apart = apart.join(info.select("cls", "vec"), "cls").join(early, "cls")
    edges, _ = materialise(edges.unionByName(similar(cell_candidates(apart, spec), frame, info, spec)))
    comp, _ = materialise(connected_components(info.select("cls"), edges, "cls", component="comp"))
    lowest = linked.select("doc_id", "cls").join(comp, "cls").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    named, _ = materialise(comp.join(lowest, "comp").select("cls", "component_id"))
    delete_path(spark, met_path)
    delete_path(spark, info_path)
    delete_path(spark, apart_path)
    alone = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("cls")).alias("cls")).join(named, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id")))


def one_of_each(docs: DataFrame, spec: JaccardSpec = JaccardSpec()) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, one row per doc_id (the smallest text).

    Rows without an id stay, as nothing links them.
    """
    found = near_duplicates(docs, spec)
    keep = found.filter(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), F.struct(*[F.col(c) for c in docs.columns if c not in ("doc_id", "text")]))
    at = "_first" + "_" * max(map(len, docs.columns))       # a name that no column has
    named = docs.filter(F.col("doc_id").isNotNull()).join(keep, "doc_id", "left_semi").withColumn(at, F.row_number().over(first)).filter(F.col(at) == 1)
    return named.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
