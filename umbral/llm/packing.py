"""Best-fit packing of documents into token sequences, after Martello-Toth dominance reduction.

Documents are encoded, ended by an end id, and cut only where they are longer than a sequence. What
decides a packing is how many pieces there are of each length, so the search runs over that histogram
(one row per length, at most ``capacity`` rows whatever the input) and answers in runs: so many
pieces of a length, by their rank among the pieces of that length, stand at an offset of so many
consecutive sequences.

Reduction: going down the lengths, a piece is fixed alone or with one or two others for good where
that set provably dominates every other set the piece could be in: nothing else fits; a partner fills
the sequence exactly; only one more piece fits and the partner is the largest; or no pair that fits
beats the partner. The rest is packed best-fit decreasing: each piece goes where it leaves the least.

Ranks are counted in salted groups whose sizes follow the histogram, so a length that a third of all
pieces have is split over many tasks.

Defined cases: a null or empty text is one piece that holds the end id; repeated rows are packed each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, materialise, slices
from umbral.llm.wordcache import encoder


@dataclass(frozen=True)
class PackSpec:
    tokenizer: str             # path of the tokenizer's file
    capacity: int = 4096
    end_id: int = 1
    mode: str = "dropped"      # how words meet in the tokenizer, see wordcache
    least_group: int = 256     # pieces of a length that are ranked together, at least


@dataclass(frozen=True)
class Run:
    """``count`` pieces of ``length`` from rank ``first``; each sequence from ``base`` takes ``per`` of them at ``offset``."""
    length: int
    first: int
    count: int
    per: int
    base: int
    offset: int


def pieces(docs: DataFrame, spec: PackSpec, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every row: its ids and the end id, cut at the capacity."""
    frame = doc_frame(docs)

    def run(batches):
        enc = encoder(spec.tokenizer, spec.mode)
        for batch in slices(batches):
            offsets, ids = enc.encode(batch.column("text"))
            row, piece, start, length, crc, cells = [], [], [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = np.append(ids[a:b], spec.end_id).astype("<u4")
                for k, at in enumerate(range(0, len(own), spec.capacity)):
                    part = own[at:at + spec.capacity]
                    row.append(i), piece.append(k), start.append(at), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        cells.append(part.astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch(columns + ([pa.array(cells, pa.list_(pa.int32()))] if with_ids else []), names=names + ["ids"] * with_ids)

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


class Histogram:
    """Lengths that are left, with how many there are of each and the next rank to hand out."""

    def __init__(self, counts: dict[int, int]):
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.sizes = sorted(self.left)
        self.rank = dict.fromkeys(self.left, 0)

    def take(self, size: int, count: int) -> int:
        first = self.rank[size]
        self.rank[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]
            del self.sizes[bisect_left(self.sizes, size)]
        return first

    def smallest(self, without: int, n: int) -> list[int]:
        """The ``n`` smallest pieces left besides one of length ``without``."""
        out = []
        for s in self.sizes:
            out += [s] * min(n - len(out), self.left[s] - (s == without))
            if len(out) >= n:
                break
        return out

    def largest(self, room: int, without: dict[int, int]) -> int | None:
        """The longest piece of at most ``room``, besides those in ``without``."""
        i = bisect_right(self.sizes, room) - 1
        while i >= 0 and self.left[self.sizes[i]] <= without.get(self.sizes[i], 0):
            i -= 1
        return self.sizes[i] if i >= 0 else None


def _best_partners(h: Histogram, size: int, room: int) -> tuple[int, ...] | None:
    """The one or two pieces that dominate all else that could stand with a piece of ``size``; () for none, None if unknown."""
    small = h.smallest(size, 3)
    if not small or small[0] > room:
        return ()
    one = h.largest(room, {size: 1})
    if one == room or len(small) < 2 or small[0] + small[1] > room:
        return (one,)
    if len(small) == 3 and sum(small) <= room:
        return None                     # three more may fit: too many sets to rule out
    best_sum = best_low = 0
    for a in h.sizes:                   # a: the larger of a pair that fits
        if a > room:
            break
        b = h.largest(min(a, room - a), {size: 1} | {a: 1 + (a == size)})
        if b is not None and h.left[a] - (a == size) > 0:
            best_sum, best_low = max(best_sum, a + b), max(best_low, b)
    if one >= best_sum:
        return (one,)
    two = h.largest(room - one, {size: 1 + (one == size), one: 1 + (one == size)})
    return (one, two) if two is not None and two >= best_low else None


def reduce_instance(h: Histogram, capacity: int, base: int, runs: list[Run]) -> int:
    """Fix dominating sets for good, as many at a time as the counts allow; the next free sequence."""
    for size in sorted(h.sizes, reverse=True):
        while size in h.left:
            partners = _best_partners(h, size, capacity - size)
            if partners is None:
                break
            group = (size, *partners)
            n = min(h.left[s] // group.count(s) for s in group)
            if partners:
                # at once as long as every member is left; then the partners are chosen anew
                n = max(n, 1)
            at = 0
            for s in group:
                runs.append(Run(s, h.take(s, n), n, 1, base, at))
                at += s
            base += n
    return base


def best_fit(h: Histogram, capacity: int, base: int, runs: list[Run]) -> int:
    """Pack what is left best-fit decreasing, all pieces of a length at once; the next free sequence.

    Sequences with equal room are kept as stretches. The piece goes to the least room it fits; what
    it leaves there is less still, so a sequence takes as many of the length as fit before the next.
    """
    open_rooms: list[int] = []
    stretches: dict[int, list[tuple[int, int]]] = {}

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            if room not in stretches:
                insort(open_rooms, room)
                stretches[room] = []
            stretches[room].append((first, n))

    for size in sorted(h.sizes, reverse=True):
        while h.left.get(size):
            c = h.left[size]
            i = bisect_left(open_rooms, size)
            if i < len(open_rooms):
                room = open_rooms[i]
                first, n = stretches[room].pop()
                if not stretches[room]:
                    del stretches[room], open_rooms[i]
            else:
                room, first, n = capacity, base, -(-c // (capacity // size))
                base += n
            per = room // size
            full = min(n, c // per)
            if full:
                runs.append(Run(size, h.take(size, full * per), full * per, per, first, capacity - room))
                put(room - per * size, first, full)
            rest = min(h.left.get(size, 0), per - 1) if full < n else 0
            if rest:
                runs.append(Run(size, h.take(size, rest), rest, rest, first + full, capacity - room))
                put(room - rest * size, first + full, 1)
            put(room, first + full + (rest > 0), n - full - (rest > 0))
    return base


def pack_lengths(counts: dict[int, int], capacity: int) -> list[Run]:
    """Runs that place every piece of the histogram, none above the capacity."""
    h, runs = Histogram(counts), []
    base = reduce_instance(h, capacity, 0, runs)
    best_fit(h, capacity, base, runs)
    return runs


def ranked(rows: DataFrame, counts: dict[int, int], spec: PackSpec) -> DataFrame:
    """``rows`` with _rank, 0 .. n - 1 within their length, counted in salted groups of bounded size."""
    spark = rows.sparkSession
    group = max(spec.least_group, -(-sum(counts.values()) // 200_000))
    salts = spark.createDataFrame([(n, -(-c // group)) for n, c in sorted(counts.items())], "length long, _salts long")
    order = ["doc_id", "piece", "ids_crc32"]
    # one row per length that occurs, at most the capacity: small whatever the input
    salted = rows.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64(*order), F.col("_salts")))
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    sums = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    return (salted.withColumn("_inside", inside).join(first, ["length", "_salt"])
            .withColumn("_rank", (F.col("_first") + F.col("_inside")).cast("long")).select(*rows.columns, "_rank"))


def pack(docs: DataFrame, spec: PackSpec, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of every piece of every row."""
    rows, _ = materialise(pieces(docs, spec, with_ids))
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(pack_lengths(counts, spec.capacity), key=lambda r: (r.length, r.first))
    if not runs:
        return rows.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = docs.sparkSession.sparkContext.broadcast(np.array([(r.length, r.first, r.per, r.base, r.offset) for r in runs], np.int64))
    placed = ranked(rows, counts, spec)
    kept = [f.name for f in rows.schema.fields]

    def place(batches):
        table = shared.value
        wide = np.int64(1) << np.int64(44)
        key = table[:, 0] * wide + table[:, 1]
        for batch in batches:
            length, rank = np.asarray(batch.column("length"), np.int64), np.asarray(batch.column("_rank"), np.int64)
            i = np.searchsorted(key, length * wide + rank, side="right") - 1
            step, per = rank - table[i, 1], table[i, 2]
            yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(table[i, 3] + step // per), pa.array(table[i, 4] + step % per * length)],
                                  names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return placed.mapInArrow(place, f"{fields}, sequence_id long, offset long")
