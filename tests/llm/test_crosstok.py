"""Cross-tokenizer alignment against a direct comparison of all token ends."""

import hashlib
from collections import Counter
from dataclasses import replace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from umbral.llm import crosstok as C

SPEC = C.CrossSpec(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string"

TEXTS = ["The quick brown fox.", "  two  spaces ", "a\n\nb\tc\r\n", " ", "\t", "", None, "ﬁ é① 日本 語 　x", "<s>hi</s> <unk> <0x41>", "<|endoftext|> again<|endoftext|>",
         "▁not a space", "\x00nul", "éééé ÿÿ ßtraße", "x" * 3000, "1234567890 " * 50, "🙂🙂 family 👨‍👩‍👧", "the the the the", "a b   c"]


def brute(rows):
    """Every token end of either side by sets; counts over all rows."""
    import sentencepiece
    from tokenizers import Tokenizer
    ta, tb = Tokenizer.from_file(SPEC.byte_path), sentencepiece.SentencePieceProcessor(model_file=SPEC.piece_path)
    ta.encode_special_tokens = True
    letter = C.byte_alphabet()
    out, pairs = [], []
    for doc_id, text in rows:
        a, b = (ta.encode(" " + text, add_special_tokens=False), tb.encode(text)) if text else (None, [])
        bytes_a = [bytes(letter[c] for c in t) for t in (ta.id_to_token(i) for i in a.ids)] if a else []
        bytes_b = [bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, tb.id_to_piece(i)) for i in b)]
        want = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want:
            out.append([doc_id, 0, 0, 0, 0, ""])
            pairs.append([])
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        both = sorted(set(ends_a) & set(ends_b))
        groups, linked, low = [], [], 0
        for cut in both:
            ga = [i for i, e in zip(a.ids, ends_a) if low < e <= cut]
            gb = [i for i, e in zip(b, ends_b) if low < e <= cut]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            linked.append((ga[-1], gb[-1]))
            low = cut
        out.append([doc_id, len(a.ids), len(b), len(both), len(linked), hashlib.sha256(";".join(groups).encode()).hexdigest()])
        pairs.append(linked)
    count = Counter(p for x in pairs for p in x)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((*r[:5], sum(count[p] == most[p[1]] for p in x), sum(count[p] for p in x), r[5]) for r, x in zip(out, pairs)), key=str)


def found(df):
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("spec", [SPEC, replace(SPEC, slice_bytes=40, broadcast_pairs=0)], ids=["broadcast", "shuffled"])
def test_groups_equal_brute_force(spark, spec):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, TEXTS[0]), (3, TEXTS[0])]
    assert found(C.cross_tokens(spark.createDataFrame(rows, SCHEMA), spec)) == brute(rows)


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found(C.cross_tokens(docs, SPEC)) == brute([tuple(r) for r in docs.collect()])


def test_empty_table_string_ids_and_clashing_columns(spark):
    assert C.cross_tokens(spark.createDataFrame([], SCHEMA), SPEC).count() == 0
    docs = spark.createDataFrame([("x", "one two"), ("y", None)], "doc_id string, text string")
    for name in ("row", "pair", "pairs", "times", "count", "best", "n_a", "groups_sha256"):
        docs = docs.withColumn(name, F.lit(1))
    assert found(C.cross_tokens(docs, SPEC)) == brute([("x", "one two"), ("y", None)])


def test_very_long_text(spark):
    rows = [(1, "Straße über ânes 4711, " * 40_000), (2, "q" * 200_000)]
    got = found(C.cross_tokens(spark.createDataFrame(rows, SCHEMA), SPEC))
    assert [r[0] for r in got] == [1, 2] and all(r[3] == r[4] > 0 for r in got)


@pytest.mark.parametrize("seed", range(30))
def test_division_finds_every_shared_cut(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 400))
    edges = np.concatenate([[0], np.unique(rng.integers(1, n + 1, 4)), [n]])
    edges = np.unique(edges)
    a, b = (np.union1d(np.flatnonzero(rng.random(n + 1) < p)[1:], edges[1:]) for p in rng.random(2))
    assert C.shared_cuts(a, b, edges).tolist() == np.intersect1d(a, b).tolist()
