"""Spelling variants: words one edit apart, found by range searches in k-d trees over letter counts.

One edit moves a word's vector of letter counts by at most two in L1: a replaced letter takes one count
down and one up, an inserted or deleted letter moves one count. So the near words of a word lie, among
the words of its own length and of the next, within L1 distance two of its point. Words of one length
are the points of a k-d tree; a query walks it and leaves out every box further than two away; what a
leaf hands over is verified letter by letter.

Points are held as unary codes: for every letter and v = 1, 2, 3 one bit says whether the letter's count
reaches v. A split of the tree is one such bit ("count of e at least 2"), a box is the pair of AND and OR
of its codes, and distances are counted bits. Counts above three and accented letters that share a bit
only make the distance smaller, so no near word is lost; verification is on the letters.

Spreading the work: the top of each length's tree is fitted on a sample on the driver and deals points to
cells of about ``cell`` words, so the number of cells grows with the table. A word is a point in one cell
and a query in every cell it may reach. Cells and their queries are cut into blocks by a hash of the word
where they are larger than planned, each block of queries meets each block of points once, and a task
holds two blocks. Any tree gives the same result: the sample decides only who works where.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import materialise, ship_package

#: Fixed values of the task: letters of a word, lower-cased letters, the edit's modulus.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DROP_MOD = 97


@dataclass(frozen=True)
class SpellSpec:
    """Words of at least ``min_chars`` code points and ``min_count`` occurrences take part.

    A word's form must occur ``factor`` times as often. ``cell``: words a cell and a block should hold;
    ``leaf``: words of a leaf; ``per_cell``: sampled words a cell of the top tree is fitted on;
    ``max_sample``: words the driver fits on at most (beyond it cells grow and are cut into blocks);
    ``block_chars``: letters a block may hold, which bounds blocks of very long words.
    """
    min_chars: int = 5
    min_count: int = 3
    factor: int = 2
    cell: int = 1 << 16
    leaf: int = 96
    per_cell: int = 64
    max_sample: int = 1 << 19
    block_chars: int = 1 << 24


# ---- the words ----------------------------------------------------------------------------

def lower_ascii(word: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def word_counts(docs: DataFrame, spec: SpellSpec = SpellSpec()) -> DataFrame:
    """(word, n): the words of all texts, one letter left out wherever the run's checksum says so."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # a run shorter than a word is never one, and a deletion only shortens it
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{spec.min_chars},}}"), F.lit(0))
    run = lower_ascii(F.col("run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("h") % DROP_MOD == 0, cut).otherwise(F.col("run"))
    return (docs.select(key.alias("key"), F.explode(runs).alias("run"))
            .select("key", run.alias("run"))
            .select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
            .select(word.alias("word")).filter(F.char_length("word") >= spec.min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= spec.min_count))


# ---- codes and trees ----------------------------------------------------------------------

_LEVELS, _PLAIN = 3, 26
_WIDTH = 128
_SHARED = _WIDTH - _LEVELS * _PLAIN      # bits left for the other letters, one level each


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, letters) of words as code points."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]), flat


def codes(words: list[str]) -> np.ndarray:
    """Unary codes of the letter counts, n x 2 unsigned 64-bit words."""
    offsets, flat = letters(words)
    row = np.repeat(np.arange(len(words)), np.diff(offsets))
    plain = (flat >= 97) & (flat < 97 + _PLAIN)
    out = np.zeros((len(words), _WIDTH), bool)
    counts = np.bincount(row[plain] * _PLAIN + (flat[plain] - 97).astype(np.int64), minlength=len(words) * _PLAIN).reshape(-1, _PLAIN)
    for v in range(_LEVELS):
        out[:, v * _PLAIN:(v + 1) * _PLAIN] = counts > v
    out[row[~plain], _LEVELS * _PLAIN + (flat[~plain] % _SHARED).astype(np.int64)] = True
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


def _bits(code: np.ndarray) -> np.ndarray:
    return np.unpackbits(code.view(np.uint8).reshape(len(code), -1), axis=1, bitorder="little")


class Tree:
    """A k-d tree over unary codes. Node 0 is the root; ``left`` < 0 marks a leaf, whose number is ``leaf``."""

    def __init__(self, code: np.ndarray, leaf_size: int, tight: bool):
        """``tight``: boxes enclose the given points; otherwise only the splits bound them, for points yet to come."""
        bits = _bits(code)
        self.bit, self.left, self.right, self.leaf = [], [], [], []
        self.lo, self.hi, self.members = [], [], []
        full = np.full(2, np.iinfo(np.uint64).max, np.uint64)
        self._grow(bits, code, np.arange(len(code)), leaf_size, tight, np.zeros(2, np.uint64), full)
        self.bit, self.left, self.right, self.leaf = (np.array(x, np.int64) for x in (self.bit, self.left, self.right, self.leaf))
        self.lo, self.hi = np.array(self.lo, np.uint64), np.array(self.hi, np.uint64)

    def _grow(self, bits, code, rows, leaf_size, tight, lo, hi):
        todo = [(rows, lo, hi, None)]
        while todo:
            rows, lo, hi, parent = todo.pop()
            node = len(self.bit)
            if parent is not None:
                (self.left if parent[1] == 0 else self.right)[parent[0]] = node
            if tight and len(rows):
                lo, hi = np.bitwise_and.reduce(code[rows]), np.bitwise_or.reduce(code[rows])
            self.lo.append(lo)
            self.hi.append(hi)
            for x in (self.left, self.right, self.leaf):
                x.append(-1)
            self.bit.append(-1)
            split = None
            if len(rows) > leaf_size:
                share = bits[rows].sum(axis=0, dtype=np.int64)
                b = int(np.argmax(np.minimum(share, len(rows) - share)))
                split = b if 0 < share[b] < len(rows) else None
            if split is None:
                self.leaf[node] = len(self.members)
                self.members.append(rows)
                continue
            self.bit[node] = split
            mask = np.zeros(2, np.uint64)
            mask[split // 64] = np.uint64(1) << np.uint64(split % 64)
            on = bits[rows, split] > 0
            todo.append((rows[on], lo | mask, hi, (node, 1)))
            todo.append((rows[~on], lo, hi & ~mask, (node, 0)))

    def place(self, code: np.ndarray) -> np.ndarray:
        """The leaf each point falls into."""
        bits, node = _bits(code), np.zeros(len(code), np.int64)
        while True:
            inner = np.flatnonzero(self.left[node] >= 0)
            if not len(inner):
                return self.leaf[node]
            at = node[inner]
            node[inner] = np.where(bits[inner, self.bit[at]] > 0, self.right[at], self.left[at])

    def reach(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf): for every query each leaf whose box is within ``radius``."""
        query, node = np.arange(len(code)), np.zeros(len(code), np.int64)
        found_q, found_l = [], []
        while len(query):
            near = np.zeros(len(query), np.int64)
            for w in range(2):
                c = code[query, w]
                near += np.bitwise_count(self.lo[node, w] & ~c)
                near += np.bitwise_count(c & ~self.hi[node, w])
            query, node = query[near <= radius], node[near <= radius]
            end = self.left[node] < 0
            found_q.append(query[end])
            found_l.append(self.leaf[node[end]])
            query, node = query[~end], node[~end]
            query, node = np.concatenate([query, query]), np.concatenate([self.left[node], self.right[node]])
        return np.concatenate(found_q), np.concatenate(found_l)


# ---- dealing words to cells ---------------------------------------------------------------

def top_trees(words: DataFrame, spec: SpellSpec) -> dict[int, Tree]:
    """For every length with more words than a cell holds: a tree whose leaves are cells."""
    # at most one row a cell of the table, and no more than the sample allows
    sizes = (words.groupBy(F.char_length("word").alias("size")).agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > spec.cell).orderBy(F.desc("n"), "size").limit(spec.max_sample // spec.per_cell).collect())
    total = sum(r["n"] for r in sizes)
    if not total:
        return {}
    want = min(spec.max_sample, spec.per_cell * (total // spec.cell + 1))
    share = int(min(1.0, want / total) * (1 << 30)) + 1
    rows = (words.withColumn("size", F.char_length("word")).filter(F.col("size").isin([r["size"] for r in sizes]))
            .filter(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share).select("word").collect())
    by_size: dict[int, list[str]] = {}
    for r in rows:
        by_size.setdefault(len(r["word"]), []).append(r["word"])
    out = {}
    for r in sizes:
        sample = sorted(by_size.get(r["size"], []))
        if len(sample) > 1:
            out[r["size"]] = Tree(codes(sample), max(1, int(len(sample) * spec.cell / r["n"])), tight=False)
    return out


_ROUTED = "size int, leaf int, query boolean, word string, n long"


def route(words: DataFrame, trees: dict[int, Tree], next_sizes: bool = True) -> DataFrame:
    """Every word once as a point of its cell, and as a query of each cell of its own and the next length within reach."""
    arrow = pa.schema([("size", pa.int32()), ("leaf", pa.int32()), ("query", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, n = batch.column(0), np.asarray(batch.column(1), np.int64)
            if not batch.num_rows:
                continue
            words = text.to_pylist()
            size, code = np.fromiter(map(len, words), np.int64, len(words)), codes(words)
            parts = []
            for s in np.unique(size).tolist():
                mine = np.flatnonzero(size == s)
                own = trees.get(s)
                parts.append((s, mine, own.place(code[mine]) if own else np.zeros(len(mine), np.int64), False))
                for target, radius in ((s, 2), (s + 1, 1)):
                    tree = trees.get(target)
                    q, leaf = tree.reach(code[mine], radius) if tree else (np.arange(len(mine)), np.zeros(len(mine), np.int64))
                    parts.append((target, mine[q], leaf, True))
            for s, rows, leaf, query in parts:
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), s), pa.int32()), pa.array(leaf, pa.int32()), pa.array(np.full(len(rows), query)),
                                                      text.take(pa.array(rows)), pa.array(n[rows])], schema=arrow)

    return words.select("word", "n").mapInArrow(run, _ROUTED)


# ---- inside two blocks --------------------------------------------------------------------

def _matrix(words: list[str], size: int) -> np.ndarray:
    return letters(words)[1].astype(np.uint16).reshape(len(words), size)


def verify(query: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Whether each query row becomes its point row by one replaced letter, or one inserted where the point is longer."""
    if query.shape[1] == point.shape[1]:
        return (query != point).sum(axis=1) == 1
    n = query.shape[1]
    head = np.logical_and.accumulate(query == point[:, :n], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((query == point[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= n


def near_pairs(query_words: list[str], point_words: list[str], leaf_size: int, room: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(query, point): all pairs one edit apart; points have one length, queries that length or one less."""
    size = len(point_words[0])
    qcode, pcode = codes(query_words), codes(point_words)
    tree = Tree(pcode, leaf_size, tight=True)
    points = _matrix(point_words, size)
    qsize = np.fromiter(map(len, query_words), np.int64, len(query_words))
    out_q, out_p = [], []
    for s, radius in ((size, 2), (size - 1, 1)):
        mine = np.flatnonzero(qsize == s)
        if not len(mine):
            continue
        table = _matrix([query_words[i] for i in mine.tolist()], s)
        code = qcode[mine]
        # a slice of queries at a time, so that what a walk holds stays bounded
        for at in range(0, len(mine), 8192):
            q, leaf = tree.reach(code[at:at + 8192], radius)
            order = np.argsort(leaf, kind="stable")
            q, edges = q[order] + at, np.searchsorted(leaf[order], np.arange(len(tree.members) + 1))
            held_q, held_p, held = [], [], 0
            for k, members in enumerate(tree.members):
                visitors = q[edges[k]:edges[k + 1]]
                step = max(1, room // len(members))
                for i in range(0, len(visitors), step):
                    part = visitors[i:i + step]
                    apart = np.bitwise_count(code[part, None, 0] ^ pcode[None, members, 0])
                    apart += np.bitwise_count(code[part, None, 1] ^ pcode[None, members, 1])
                    a, b = np.nonzero(apart <= radius)
                    held_q.append(part[a])
                    held_p.append(members[b])
                    held += len(a)
                    if held * size > room:
                        _keep(table, points, mine, held_q, held_p, out_q, out_p)
                        held_q, held_p, held = [], [], 0
            if held:
                _keep(table, points, mine, held_q, held_p, out_q, out_p)
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_q), np.concatenate(out_p)) if out_q else (none, none)


def _keep(table, points, mine, held_q, held_p, out_q, out_p):
    a, b = np.concatenate(held_q), np.concatenate(held_p)
    step = max(1, (1 << 24) // points.shape[1])
    for i in range(0, len(a), step):
        good = verify(table[a[i:i + step]], points[b[i:i + step]])
        out_q.append(mine[a[i:i + step][good]])
        out_p.append(b[i:i + step][good])


_NEAR = "word string, n_near long, best_n long, best string"


def _best(word: pa.Array, n: np.ndarray, own: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    """Per word of ``own``: how many near words, and of these the one of largest n, ties to the smallest word."""
    text = np.array(word.to_pylist(), dtype=object)
    rank = np.empty(len(text), np.int64)
    rank[sorted(range(len(text)), key=text.__getitem__)] = np.arange(len(text))
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(own)))
    take = pa.array(own[first])
    return pa.RecordBatch.from_arrays([word.take(take), pa.array(count, pa.int64()), pa.array(n[other[first]], pa.int64()), word.take(pa.array(other[first]))],
                                      names=["word", "n_near", "best_n", "best"])


def near_words(words: DataFrame, spec: SpellSpec = SpellSpec()) -> DataFrame:
    """(word, n_near, best_n, best) for every word with at least one near word."""
    routed, _ = materialise(route(words, top_trees(words, spec)))
    cell = ["size", "leaf"]
    # letters a block may hold bound its words where they are very long
    limit = F.greatest(F.lit(1), F.least(F.lit(spec.cell), F.floor(F.lit(spec.block_chars) / F.col("size"))))
    blocks = lambda what: F.greatest(F.lit(1), F.ceil(F.count_if(what) / F.first("limit"))).cast("int")
    sizes = (routed.withColumn("limit", limit).groupBy(*cell)
             .agg(blocks(~F.col("query")).alias("n_points"), blocks(F.col("query")).alias("n_queries"), F.count_if(~F.col("query")).alias("held"))
             .filter(F.col("held") > 0).drop("held"))
    own = F.pmod(F.xxhash64("word"), F.when(F.col("query"), F.col("n_queries")).otherwise(F.col("n_points"))).cast("int")
    against = F.explode(F.sequence(F.lit(0), F.when(F.col("query"), F.col("n_points")).otherwise(F.col("n_queries")) - 1))
    dealt = (routed.join(sizes, cell).withColumn("own", own).withColumn("against", against)
             .withColumn("block", F.struct(*cell, F.when(F.col("query"), F.col("own")).otherwise(F.col("against")).alias("q"),
                                           F.when(F.col("query"), F.col("against")).otherwise(F.col("own")).alias("p")))
             .select("block", "query", "word", "n"))
    leaf_size = spec.leaf

    def search(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        word, n = group.column("word").combine_chunks(), np.asarray(group.column("n"), np.int64)
        query = np.asarray(group.column("query").combine_chunks(), bool)
        q, p = np.flatnonzero(query), np.flatnonzero(~query)
        if not len(q) or not len(p):
            return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()), "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
        text = word.to_pylist()
        a, b = near_pairs([text[i] for i in q.tolist()], [text[i] for i in p.tolist()], leaf_size)
        a, b = q[a], p[b]
        # a pair of one length is found from both sides, one with an insertion only from the shorter word
        size = np.fromiter(map(len, text), np.int64, len(text))
        longer = size[b] > size[a]
        return pa.Table.from_batches([_best(word, n, np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]]))])

    found = dealt.groupBy("block").applyInArrow(search, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best")))


# ---- forms and roots ----------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: forms followed to the last, by pointer doubling.

    A form occurs at least twice as often as its word, so a chain is no longer than the logarithm of the
    largest count and the rounds no more than that length's logarithm.
    """
    step, _ = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step, _ = materialise(step.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if step.filter("moved").limit(1).count() == 0:
            return step.select("word", "root")
        step = step.select("word", "root")


def spelling_groups(docs: DataFrame, spec: SpellSpec = SpellSpec()) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    Null and empty texts have no words; rows that repeat count each; a null doc_id is the empty string
    in the checksum; ties between near words go to the smaller word; an empty table gives no rows. Only
    doc_id and text are read, so further columns may have any name.
    """
    ship_package(docs.sparkSession)
    words, _ = materialise(word_counts(docs, spec))
    near = near_words(words, spec)
    often = F.col("best_n") >= spec.factor * F.col("n")
    formed, _ = materialise(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("best")).alias("form"), F.when(often, F.col("best_n")).alias("form_n")))
    root = roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
