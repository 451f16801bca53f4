"""Token ids in a binary format compressed by Re-Pair, readable document by document.

Documents are dealt to range partitions of doc_id and written in ascending order. A partition writes
blocks of about ``block_tokens`` ids. Within a block, frequent pairs of neighbouring symbols are
replaced by new symbols, round after round, until no pair saves more bytes than its rule takes; of
overlapping pairs the more frequent goes first. A rule that would widen the symbols of the whole block
from two to four bytes does not pay. A pair never spans two documents, so every document is a stretch of symbols of its own. A block stores the
pairs behind the new symbols (the rules) and how many ids each symbol stands for, from which the place
of any document or id range is known without expanding what precedes it.

A block, all numbers little-endian: magic ``UMRP``, version, width of a symbol in bytes, documents,
distinct ids, rules, symbols (unsigned 32-bit each); per document its id (64-bit), whether it is null
(8-bit) and its symbols (32-bit); the distinct ids (32-bit); the rules (two symbols of 32 bits); the
expansion length of each rule (32-bit); the symbols. Symbols below the number of distinct ids stand
for these, the others for the rules in order.

The blocks are rows (shard, block, before, n_tokens, payload) of a table, so Spark's commit protocol
guards them against lost executors. Defined cases: a null text is an empty one and holds only the end
id; a null doc_id comes first; rows with one doc_id follow each other in the order of their texts;
other columns are ignored; an empty table writes no block and reads back empty.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, slices
from umbral.llm.wordcache import _ranges, encoder
from umbral.session import ensure_checkpoint_dir

_HEAD = struct.Struct("<4s6I")
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepairSpec:
    tokenizer: str
    end_id: int = 2
    mode: str = "leading"           # how words meet in the tokenizer, see wordcache
    block_tokens: int = 1 << 20
    least_count: int = 0            # of a pair that becomes a rule; 0: as many as pay for it
    rules_per_round: int = 4096
    least_gain: float = 0.0         # share by which a round must shorten a block to be followed by another


_RULE_BYTES, _NARROW = 12, 1 << 16  # two symbols and a length; symbols that two bytes can tell apart


def _frequent_first(at: np.ndarray, rank: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` (ascending) remain when those of lower rank, taken first, rule out their neighbours; neighbours differ in rank."""
    keep, open_ = np.zeros(len(at), bool), np.arange(len(at))
    while len(open_):
        a, k = at[open_], rank[open_]
        touch = after[a[:-1]] == a[1:]
        win = np.ones(len(a), bool)
        win[1:] &= ~touch | (k[1:] < k[:-1])
        win[:-1] &= ~touch | (k[:-1] < k[1:])
        keep[open_[win]] = True
        gone = win.copy()
        gone[1:] |= touch & win[:-1]
        gone[:-1] |= touch & win[1:]
        open_ = open_[~gone]
    return keep


def _cells(key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed cell of every key, rows of each cell), about four cells a key."""
    bits = min(20, max(10, (4 * len(key)).bit_length()))
    spread = np.uint32(0x9E3779B1) if width == 32 else _MULT
    cell = ((key * spread) >> key.dtype.type(width - bits)).astype(np.int64)
    return cell, np.bincount(cell, minlength=1 << bits)


def compress(symbols: np.ndarray, last: np.ndarray, alphabet: int, spec: RepairSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, last, rules): pairs that do not span a document's last symbol replaced, most frequent first.

    Places are linked to the next and the one before within their document, so a replacement touches
    its surroundings only. A pair that is too rare in one round stays so, as replacements only take
    occurrences away; a round therefore looks at the places where a frequent pair was left over or a
    new symbol has come. It counts their pairs in hashed cells, then those of full cells exactly,
    without overlap of a pair with itself, and replaces the chosen ones. The most frequent one is
    replaced everywhere, so every round makes a rule that pays.
    """
    size = len(symbols)
    symbols = symbols.astype(np.uint32)
    after, prior = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    after[last] = -1
    prior[1:][last[:-1]] = -1
    stay, mark = np.ones(size, bool), np.empty(size, bool)
    rules: list[np.ndarray] = []
    n, left, narrow = alphabet, size, alphabet <= _NARROW
    least = spec.least_count or _RULE_BYTES // (2 if narrow else 4) + 1
    kind, shift = (np.uint32, 16) if narrow else (np.uint64, 32)
    at = np.flatnonzero(after >= 0).astype(np.int32)
    while len(at):
        room = _NARROW - n if narrow else spec.rules_per_round
        key = (symbols[at].astype(kind) << kind(shift)) | symbols[after[at]]
        cell, rows = _cells(key, 2 * shift)
        full = np.flatnonzero((rows >= least)[cell])
        at, key = at[full], key[full]
        if not len(at) or not room:
            break
        head = np.ones(len(at), bool)                           # of a run of one symbol
        head[1:] = (after[at[:-1]] != at[1:]) | (key[1:] != key[:-1])
        place = np.arange(len(at), dtype=np.int32)
        apart = (place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0
        pair, index = np.unique(key, return_inverse=True)
        count = np.bincount(index[apart], minlength=len(pair))
        good = np.flatnonzero(count >= least)
        if not len(good):
            break
        rank = np.full(len(pair), -1, np.int32)
        rank[good] = len(good)
        mark[:] = False
        mark[at[(rank >= 0)[index]]] = True
        good = good[np.argsort(-count[good], kind="stable")[:min(room, spec.rules_per_round)]]
        rank[rank >= 0] = -1
        rank[good] = np.arange(len(good))
        chosen = rank[index]
        take = apart & (chosen >= 0)
        at, chosen = at[take], chosen[take]
        keep = _frequent_first(at, chosen, after)
        at, chosen = at[keep], chosen[keep]
        pays = np.bincount(chosen, minlength=len(good)) >= least
        keep = pays[chosen]
        at, chosen, good = at[keep], (np.cumsum(pays) - 1)[chosen[keep]], good[pays]
        gone = after[at]
        symbols[at] = n + chosen
        far = after[gone]
        after[at] = far
        prior[far[far >= 0]] = at[far >= 0]
        stay[gone] = False
        back = prior[at]
        mark[at] = mark[back[back >= 0]] = True
        mark[gone] = False
        rules.append(np.stack([pair[good] >> kind(shift), pair[good] & kind((1 << shift) - 1)], 1).astype(np.uint32))
        n += len(good)
        if len(at) < spec.least_gain * left:
            break
        left -= len(at)
        at = np.flatnonzero(mark).astype(np.int32)
        at = at[after[at] >= 0]
    return symbols[stay], after[stay] < 0, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(ids: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, flat): what every symbol stands for, rules resolved in groups that only need earlier ones."""
    base, total = len(ids), len(ids) + len(rules)
    start, length = np.zeros(total, np.int64), np.ones(total, np.int64)
    start[:base] = np.arange(base)
    flat, used, done = ids, base, base
    while done < total:
        # rules up to the first that needs one not yet resolved
        need = rules[done - base:].max(axis=1).astype(np.int64)
        late = np.flatnonzero(need >= done)
        end = done + (int(late[0]) if len(late) else len(need))
        both = rules[done - base:end - base].astype(np.int64).ravel()
        add = flat[_ranges(start[both], length[both])]
        length[done:end] = length[both].reshape(-1, 2).sum(axis=1)
        start[done:end] = used + np.cumsum(length[done:end]) - length[done:end]
        flat, used, done = np.concatenate([flat, add]), used + len(add), end
    return start, length, flat


def write_block(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, spec: RepairSpec) -> bytes:
    """The payload of documents with ``lengths`` ids each."""
    seen = np.zeros(int(ids.max()) + 1, bool)
    seen[ids] = True
    distinct, code = np.flatnonzero(seen), np.cumsum(seen) - 1
    symbols = code[ids]
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths) - 1] = True
    symbols, last, rules = compress(symbols, last, len(distinct), spec)
    width = 2 if len(distinct) + len(rules) <= 1 << 16 else 4
    per_doc = np.diff(np.concatenate([[-1], np.flatnonzero(last)]))
    size = expansions(distinct.astype(np.uint32), rules)[1][len(distinct):]
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([_HEAD.pack(b"UMRP", 1, width, len(doc_ids), len(distinct), len(rules), len(symbols)),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), per_doc.astype("<u4").tobytes(), distinct.astype("<u4").tobytes(),
                     rules.astype("<u4").tobytes(), size.astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes()])


class Block:
    """A payload opened for reading: ``ids(i)`` of document i, or of a range of documents, without the others."""

    def __init__(self, payload: bytes):
        magic, version, width, docs, ids, rules, symbols = _HEAD.unpack_from(payload)
        if magic != b"UMRP" or version != 1:
            raise ValueError("not a block of this format")
        at = _HEAD.size

        def part(kind, n):
            nonlocal at
            x = np.frombuffer(payload, kind, n, at)
            at += x.nbytes
            return x

        self.doc_ids, self.null, per_doc = part("<i8", docs), part("u1", docs).astype(bool), part("<u4", docs)
        self.distinct, self.rules = part("<u4", ids), part("<u4", 2 * rules).reshape(-1, 2)
        self.expansion = np.concatenate([np.ones(ids, np.int64), part("<u4", rules).astype(np.int64)])
        self.symbols = part(f"<u{width}", symbols)
        self.edges = np.concatenate([[0], np.cumsum(per_doc.astype(np.int64))])
        self.tables = None

    def token_counts(self) -> np.ndarray:
        """Ids per document, from the expansion lengths alone."""
        run = np.concatenate([[0], np.cumsum(self.expansion[self.symbols])])
        return np.diff(run[self.edges])

    def ids(self, first: int = 0, end: int | None = None) -> np.ndarray:
        if self.tables is None:
            self.tables = expansions(self.distinct, self.rules)
        start, length, flat = self.tables
        s = self.symbols[self.edges[first]:self.edges[len(self.doc_ids) if end is None else end]]
        return flat[_ranges(start[s], length[s])]


def write_tokens(docs: DataFrame, spec: RepairSpec, path: str) -> None:
    """Encode, compress and write every row of ``docs`` as blocks in ascending order of doc_id."""

    def blocks(batches):
        enc, shard = encoder(spec.tokenizer, spec.mode), TaskContext.get().partitionId()
        names, lengths, parts, held, block, before = [], [], [], 0, 0, 0

        def flush():
            nonlocal names, lengths, parts, held, block, before
            payload = write_block(names, np.concatenate(lengths), np.concatenate(parts), spec)
            row = pa.record_batch([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([held], pa.int64()),
                                   pa.array([payload], pa.binary())], names=["shard", "block", "before", "n_tokens", "payload"])
            names, lengths, parts, block, before, held = [], [], [], block + 1, before + held, 0
            return row

        for batch in slices(batches):
            offsets, ids = enc.encode(batch.column("text"))
            n = len(offsets) - 1
            ended = np.insert(ids, offsets[1:], spec.end_id).astype(np.uint32)
            offsets = offsets + np.arange(n + 1)
            keys, i = batch.column("doc_id").cast(pa.int64()).to_pylist(), 0
            while i < n:
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + spec.block_tokens - held, side="right")) - 1)
                j = min(j, n)
                names += keys[i:j]
                lengths.append(np.diff(offsets[i:j + 1]))
                parts.append(ended[offsets[i]:offsets[j]])
                held += int(offsets[j] - offsets[i])
                i = j
                if held >= spec.block_tokens or i < n:
                    yield flush()
        if names:
            yield flush()

    (doc_frame(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(blocks, "shard int, block int, before long, n_tokens long, payload binary").write.parquet(path))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the blocks under ``path``."""
    rows = spark.read.schema("shard int, block int, before long, n_tokens long, payload binary").parquet(path)
    # one row per range partition of the writer
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    placed = rows.join(shards, "shard").select((F.col("_base") + F.col("before")).alias("start"), "payload")

    def docs(batches):
        for batch in batches:
            for base, payload in zip(batch.column("start").to_pylist(), batch.column("payload")):
                block = Block(payload.as_buffer())
                count = block.token_counts()
                edge = np.concatenate([[0], np.cumsum(count)])
                ids = block.ids().astype("<u4")
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                columns = [pa.array(block.doc_ids, pa.int64(), mask=block.null), pa.array(base + edge[:-1], pa.int64()), pa.array(count, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32), pa.int32())))
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    return placed.mapInArrow(docs, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)


def token_files(docs: DataFrame, spec: RepairSpec, path: str | None = None) -> DataFrame:
    """Write ``docs`` under ``path`` (by default a new folder of the checkpoint folder) and read the digests back."""
    path = path or f"{ensure_checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, spec, path)
    return read_tokens(docs.sparkSession, path)
