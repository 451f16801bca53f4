"""Spelling variants against brute force on small tables, and the k-d tree against all pairs."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbral.llm import spelling as S

SCHEMA = "doc_id long, text string"


def brute(rows):
    """Words, near words, forms and roots by comparing all pairs."""
    count = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    out, form = {}, {}
    for w, n in count.items():
        others = [x for x in count if x != w and near(w, x)]
        best = min(others, key=lambda x: (-count[x], x), default=None)
        if best is not None and count[best] >= 2 * n:
            form[w] = best
        out[w] = [form.get(w), None, n, len(others), count[form[w]] if w in form else None]
    for w in out:
        r = w
        while r in form:
            r = form[r]
        out[w][1] = r
    return {w: tuple(x) for w, x in out.items()}


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def texts(seed, n_docs, n_words):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(["the", "on", "er", "éa", "st", "ß", "in", "eee", "a", "É"]) for _ in range(rng.randint(2, 5))) for _ in range(60)]

    def vary(w):
        i, r = rng.randrange(len(w)), rng.random()
        return w if r < .5 else w[:i] + rng.choice("aenÿ×") + w[i:] if r < .65 else w[:i] + w[i + 1:] if r < .8 else w[:i] + rng.choice("aeR") + w[i + 1:]

    return [(d, " ".join(vary(rng.choice(stems)) for _ in range(rng.randint(0, n_words)))) for d in range(n_docs)]


@pytest.mark.parametrize("spec", [S.SpellSpec(), S.SpellSpec(cell=20, leaf=3, per_cell=8), S.SpellSpec(cell=64, leaf=5, block_chars=90)], ids=["whole", "cells", "blocks"])
def test_groups_equal_brute_force(spark, spec):
    rows = texts(1, 60, 80) + [(None, "THEON theon; thëon"), (7, None), (8, ""), (8, "same same same same words words words"), (8, "same same same same words words words")]
    assert found(S.spelling_groups(spark.createDataFrame(rows, SCHEMA), spec)) == brute(rows)


def test_deleted_letter_follows_the_checksum(spark):
    word = next(w for w in ("letter" + c * k for k in range(1, 400) for c in "abcdefgh") if zlib.crc32(f"5:{w}".encode()) % 97 == 0)
    h = zlib.crc32(f"5:{word}".encode())
    gone = word[:h % len(word)] + word[h % len(word) + 1:]
    rows = [(5, " ".join([word] * 3)), (6, " ".join([word.upper()] * 9))]
    assert found(S.spelling_groups(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert gone in brute(rows)


def test_chain_of_forms_ends_at_the_last(spark):
    # each word is one letter from the next, which occurs twice as often
    chain = ["abcdefgh"[:8 - i] + "z" * i for i in range(8)]
    whole = lambda w: next(d for d in range(99) if zlib.crc32(f"{d}:{w}".encode()) % 97)
    rows = [(whole(w), " ".join([w] * (3 << i))) for i, w in enumerate(chain)]
    got = found(S.spelling_groups(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and {r[1] for r in got.values()} == {chain[-1]}


def test_empty_table_very_long_words_and_clashing_columns(spark):
    assert S.spelling_groups(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "x" * 30_000
    rows = [(1, f"{long} {long} {long}"), (2, f"{long}y " * 7)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("word", "n", "run", "h", "key", "size", "leaf", "query", "best"):
        docs = docs.withColumn(name, F.lit(1))
    assert found(S.spelling_groups(docs)) == brute(rows)


def test_tree_reaches_every_pair_within_the_radius():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("aabcdeéß"), 7)) for _ in range(400)]
    code = S.codes(words)
    apart = sum(np.bitwise_count(code[:, None, w] ^ code[None, :, w]).astype(int) for w in range(2))
    tight, open_ = S.Tree(code, 8, True), S.Tree(code[:50], 8, False)
    home = open_.place(code)
    for tree, leaf_of in ((tight, np.argsort(np.concatenate(tight.members), kind="stable")), (open_, None)):
        if leaf_of is None:
            where = home
        else:
            where = np.repeat(np.arange(len(tree.members)), [len(m) for m in tree.members])[leaf_of]
        q, leaf = tree.reach(code, 2)
        reached = set(zip(q.tolist(), leaf.tolist()))
        assert all((a, int(where[b])) in reached for a, b in zip(*np.nonzero(apart <= 2)))
    # a box leaves most of the tree out
    assert len(tight.reach(code, 2)[0]) < 0.7 * len(code) * len(tight.members)
