"""Encoding through distinct words, attribution, Re-Pair files and packing against plain definitions."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from umbral.llm import attribution, packing, repair  # noqa: E402
from umbral.llm.wordcache import WordEncoder  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, n_tokens string, piece string"
ODD = ["", " ", "a  b", " lead", "tail ", "x\n y", "x \ny", "a<|endoftext|>b <|endoftext|> c<|startoftext|>", "é́ ́x", "it's 'sure 's", "İ ſ ß ÀÉ ﬁ", "a b　e",
       "\x1c a \x1fb", "日本語 テスト 123 456", "one two one two", "\n\n", "a\n\nb.\n", "😀 😀x"]


@pytest.fixture(scope="module")
def tokenizers_():
    from tokenizers import Tokenizer
    return {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i * 3, t, "x", None) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(rng.choice(["ban", "ana", "the", "of", "quick.", "Fox\n"]) for _ in range(rng.randint(1, 200))), None, None) for i in range(40)]
    rows += [(7, None, None, None), (None, "no id", None, None), (3, ODD[1], "x", None), (500, "lorem ipsum " * 6000, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.mark.parametrize("path, mode", [(BYTE, "leading"), (WORD, "dropped"), (BYTE, "whole")])
@pytest.mark.parametrize("cache", [0, 3, 1000])
def test_encoder_equals_the_library(tokenizers_, path, mode, cache):
    enc = WordEncoder(path, mode, cache)
    for texts in (ODD, ODD[::-1], ["x y z " * 50, "x q"]):
        offsets, ids = enc.encode(pa.array(texts, pa.string()))
        for i, t in enumerate(texts):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizers_[path].encode(t, add_special_tokens=False).ids, repr(t)
    assert enc.encode(pa.array([], pa.string()))[0].tolist() == [0]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_sections_hold_every_token_once(docs, tokenizers_, rule):
    rows = attribution.section_counts(docs, attribution.CountSpec(BYTE, rule=rule)).collect()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for d in docs.collect():
        text = d["text"] or ""
        enc = tokenizers_[BYTE].encode(text, add_special_tokens=False)
        sections, at = [], 0
        for line in text.split("\n")[:-1]:
            sections.append((at, at + len(line) + 1))
            at += len(line) + 1
        if at < len(text) or not sections:
            sections.append((at, len(text)))
        own = sorted(by[d["doc_id"]], key=lambda r: (r["section"], r["start"]))
        copies = len(own) // len(sections)
        assert [(r["start"], r["end"]) for r in own[::copies]] == sections
        assert sum(r["n_tokens"] for r in own) == copies * len(enc.ids)
        if text.isascii():
            want = [0] * len(sections)
            for a, b in enc.offsets:
                held = [min(b, y) - max(a, x) for x, y in sections]
                want[held.index(max(held)) if rule == "majority" else [x <= a < y for x, y in sections].index(True)] += 1
            assert [r["n_tokens"] for r in own[::copies]] == want
    with pytest.raises(ValueError):
        attribution.CountSpec(BYTE, rule="other")


def test_crossing_tokens_by_rule():
    border, start, end = np.array([0, 2, 9]), np.array([0, 1, 5]), np.array([1, 5, 9])
    assert attribution.allocate(start, end, border, "start").tolist() == [0, 0, 1]
    assert attribution.allocate(start, end, border, "majority").tolist() == [0, 1, 1]


def test_token_files_round_trip(spark, docs, tokenizers_, tmp_path):
    spec = repair.RepairSpec(BYTE, block_tokens=500, least_count=4)
    path = str(tmp_path / "tokens")
    repair.write_tokens(docs, spec, path)
    got = sorted(repair.read_tokens(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    want = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    at = 0
    for g, w in zip(got, want, strict=True):
        ids = tokenizers_[BYTE].encode(w["text"] or "", add_special_tokens=False).ids + [2]
        assert (g["doc_id"], g["start"], g["n_tokens"], g["ids"]) == (w["doc_id"], at, len(ids), ids)
        assert g["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    empty = str(tmp_path / "empty")
    repair.write_tokens(docs.filter("false"), spec, empty)
    assert repair.read_tokens(spark, empty).count() == 0


def test_blocks_compress_and_open_anywhere():
    rng = np.random.default_rng(0)
    phrase = rng.integers(0, 50_000, 40)
    docs = [np.append(np.concatenate([phrase if rng.random() < 0.7 else rng.integers(0, 50_000, 40) for _ in range(int(rng.integers(1, 9)))]), 2) for _ in range(300)]
    ids, lengths = np.concatenate(docs).astype(np.uint32), np.array([len(d) for d in docs])
    block = repair.Block(repair.write_block(list(range(300)), lengths, ids, repair.RepairSpec("", least_gain=0.01)))
    assert len(block.symbols) < len(ids) / 2 and len(block.rules) > 39
    assert block.token_counts().tolist() == lengths.tolist()
    for i in (0, 17, 299):
        assert (block.ids(i, i + 1) == docs[i]).all()
    assert (block.ids() == ids).all()
    same = np.full(5000, 9, np.uint32)          # overlapping pairs
    block = repair.Block(repair.write_block([5], np.array([5000]), same, repair.RepairSpec("")))
    assert (block.ids() == same).all() and len(block.symbols) < 100
    with pytest.raises(ValueError):
        repair.Block(b"nope" + bytes(40))


def plain_best_fit(lengths, capacity):
    rooms = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= x]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= x
        else:
            rooms.append(capacity - x)
    return len(rooms)


def exact_bins(lengths, capacity):
    """The fewest bins, by search over the set of partial packings."""
    states = {()}
    for x in sorted(lengths, reverse=True):
        nxt = set()
        for s in states:
            for i, r in enumerate(s):
                if r >= x:
                    nxt.add(tuple(sorted([*s[:i], r - x, *s[i + 1:]])))
            nxt.add(tuple(sorted([*s, capacity - x])))
        states = nxt
    return min(map(len, states))


def lay_out(counts, capacity):
    bins, ranks = {}, {}
    for r in packing.pack_lengths(counts, capacity):
        ranks.setdefault(r.length, []).append((r.first, r.count))
        for i in range(r.count):
            bins.setdefault(r.base + i // r.per, []).append((r.offset + i % r.per * r.length, r.length))
    for length, c in counts.items():
        at = 0
        for first, n in sorted(ranks[length]):
            assert first == at
            at += n
        assert at == c
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_never_loses_to_best_fit():
    for seed in range(150):
        rng = random.Random(seed)
        capacity, counts = rng.choice([10, 20, 50, 100]), {}
        for _ in range(rng.randint(1, 40)):
            n = rng.randint(1, capacity)
            counts[n] = counts.get(n, 0) + rng.choice([1, 1, 2, 30])
        lengths = [n for n, c in counts.items() for _ in range(c)]
        assert lay_out(counts, capacity) <= plain_best_fit(lengths, capacity)


def test_reduction_keeps_the_optimum():
    """After the fixed sets, the exact optimum of the rest adds up to the exact optimum of all."""
    for seed in range(60):
        rng = random.Random(seed)
        lengths = [rng.randint(2, 12) for _ in range(8)]
        h, runs = packing.Histogram({n: lengths.count(n) for n in lengths}), []
        fixed = packing.reduce_instance(h, 12, 0, runs)
        rest = [n for n, c in h.left.items() for _ in range(c)]
        assert fixed + (exact_bins(rest, 12) if rest else 0) == exact_bins(lengths, 12)


def test_pack_places_every_piece(spark, docs, tokenizers_):
    spec = packing.PackSpec(WORD, capacity=64, least_group=4)
    rows = packing.pack(docs, spec, with_ids=True).collect()
    want = {}
    for d in docs.collect():
        ids = tokenizers_[WORD].encode(d["text"] or "", add_special_tokens=False).ids + [1]
        for k, a in enumerate(range(0, len(ids), 64)):
            want.setdefault((d["doc_id"], k), []).append((a, ids[a:a + 64]))
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["piece"]), []).append((r["start"], r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])
    assert got == want
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 64
    assert len(seqs) <= plain_best_fit([r["length"] for r in rows], 64)
    assert packing.pack(docs.filter("false"), spec).count() == 0


def test_one_length_is_ranked_in_groups(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(5).cast("long").alias("length"), F.lit(1).cast("long").alias("ids_crc32"))
    got = packing.ranked(rows, {5: 1000}, packing.PackSpec("", least_group=100)).collect()
    assert sorted(r["_rank"] for r in got) == list(range(1000))


def test_repair_goes_on_until_no_pair_pays():
    """At the settings that queries use: no pair is left that saves more than its rule takes, and decoding is exact."""
    rng = np.random.default_rng(6)
    phrases = [rng.integers(0, 900, 8) for _ in range(150)]
    ids = np.concatenate([phrases[i] if rng.random() < 0.3 else rng.integers(0, 900, 8) for i in rng.integers(0, 150, 4000)])
    lengths = np.full(320, 100)
    payload = repair.write_block(list(range(320)), lengths, ids.copy(), repair.RepairSpec(""))
    block = repair.Block(payload)
    assert np.array_equal(block.ids(), ids)
    last = np.zeros(len(ids), bool)
    last[np.cumsum(lengths) - 1] = True
    distinct, code = np.unique(ids, return_inverse=True)
    symbols, last, rules = repair.compress(code.astype(np.int64), last, len(distinct), repair.RepairSpec(""))
    seen, used = {}, -1
    for i, (a, b) in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())):
        if not last[i] and not (a == b and used == i - 1 and symbols[i - 1] == a):
            seen[a, b] = seen.get((a, b), 0) + 1
            used = i
    assert len(rules) and 2 * max(seen.values()) <= 12


def test_the_more_frequent_of_overlapping_pairs_goes_first():
    symbols = np.array([0, 1, 2] * 10 + [1, 2] * 10)
    last = np.zeros(len(symbols), bool)
    last[-1] = True
    rules = repair.compress(symbols, last, 3, repair.RepairSpec(""))[2]
    assert rules[0].tolist() == [1, 2]


def plain_rounds(symbols, last, n, least):
    """Every pair of the block counted anew in every round."""
    symbols, last, rules = list(symbols), list(last), []
    while True:
        count, free = {}, {}
        for i in range(len(symbols) - 1):
            p = symbols[i], symbols[i + 1]
            if not last[i] and free.get(p, 0) <= i:
                count[p], free[p] = count.get(p, 0) + 1, i + 2
        order = sorted((p for p in count if count[p] >= least), key=lambda p: (-count[p], p))
        taken, places = set(), {}
        for p in order:
            i, places[p] = 0, []
            while i < len(symbols) - 1:
                if not last[i] and (symbols[i], symbols[i + 1]) == p:
                    # a place of a run counts whether or not it is free
                    if i not in taken and i + 1 not in taken:
                        places[p].append(i)
                    i += 2
                else:
                    i += 1
            taken |= {j for i in places[p] for j in (i, i + 1)}
        made = [p for p in order if len(places[p]) >= least]
        if not made:
            return symbols, last, rules
        new = {i: n + k for k, p in enumerate(made) for i in places[p]}
        gone = {i + 1 for i in new}
        last = [last[i + 1] if i in new else last[i] for i in range(len(symbols)) if i not in gone]
        symbols = [new.get(i, s) for i, s in enumerate(symbols) if i not in gone]
        rules, n = rules + made, n + len(made)


def test_rounds_equal_counting_the_whole_block_anew():
    rng = np.random.default_rng(11)
    for turn in range(60):
        k, lengths = int(rng.integers(1, 7)), rng.integers(1, 50, rng.integers(1, 20))
        ids = rng.integers(0, k, lengths.sum())
        ids = np.repeat(ids, 3)[:len(ids)] if turn % 3 == 0 else ids
        last = np.zeros(len(ids), bool)
        last[np.cumsum(lengths) - 1] = True
        least = int(rng.integers(2, 6))
        got = repair.compress(ids, last.copy(), k, repair.RepairSpec("", least_count=least))
        want = plain_rounds(ids.tolist(), last.tolist(), k, least)
        assert got[0].tolist() == want[0] and got[1].tolist() == want[1] and [tuple(r) for r in got[2].tolist()] == want[2]
