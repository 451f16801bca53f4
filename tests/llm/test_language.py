"""Language identification: presence and kernels against sets, ridge against a direct solution, held-out accuracy."""

import unicodedata
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbral.llm import language as L
from umbral.llm.labelled import in_fold

SPEC = L.LanguageSpec(buckets=1 << 18)
TEXTS = ["The cat", "  THE  cat!! ", "", "1234 !?", "ñandú über\n\nß", "кот и кошка", "a", "x" * 5000, "日本 語", "éte", "\x00a\x00"]


def grams(text, width):
    """N-grams of the text with case folded and runs of other characters as one gap, gaps at both ends."""
    out, s = set(), "-"
    for c in text.lower():
        letter = unicodedata.category(c)[0] in "LM"
        s += c if letter else "-" if s[-1] != "-" else ""
    s += "-" if s[-1] != "-" else ""
    if s == "-":
        return set()
    return {s[i:i + n] for n in range(1, width + 1) for i in range(len(s) - n + 1)}


def test_presence_is_the_set_of_ngrams():
    x, has = L.presence(TEXTS, SPEC)
    want = [grams(t, SPEC.width) for t in TEXTS]
    assert has.tolist() == [any(unicodedata.category(c)[0] in "LM" for c in t) for t in TEXTS]
    for i, a in enumerate(want):
        if has[i]:
            assert x[i].sum() == len(a)
        for j, b in enumerate(want):
            if has[i] and has[j]:
                assert (x[i] & x[j]).sum() == len(a & b)


def test_scores_equal_kernel_ridge_regression():
    rng = np.random.default_rng(5)
    draw = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(12))
    langs = ["aa"] * 20 + ["bb"] * 20 + ["cc"] * 20
    texts = [draw({"aa": "abcde", "bb": "cdefg", "cc": "efghi"}[g]) for g in langs]
    # with every text a landmark the Nyström space holds the whole kernel: ridge regression in it is kernel ridge regression
    spec = replace(SPEC, landmarks=60, ridge=1.0)
    model = L.fit(texts, langs, spec)
    fresh = [draw("abcde"), draw("cdefg"), draw("efghi"), draw("abefi")]
    bits, asked = (L.presence(t, spec)[0].astype(float) for t in (texts, fresh))
    unit = lambda x: x / np.sqrt(x.sum(axis=1, keepdims=True))
    gram, ask = unit(bits) @ unit(bits).T, unit(asked) @ unit(bits).T
    for col, g in enumerate(model.langs):
        y = np.where(np.array(langs) == g, 1.0, -1.0)
        # all weights are 1/60: the dual solution with a free constant
        n = len(y)
        system = np.block([[gram + spec.ridge * np.eye(n), np.ones((n, 1))], [np.ones((1, n)), np.zeros((1, 1))]])
        alpha = np.linalg.solve(system, np.append(y, 0.0))
        assert np.allclose(model.scores(L.presence(fresh, spec)[0])[:, col], ask @ alpha[:-1] + alpha[-1], atol=2e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.languages(docs, in_fold(5, 0)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_labels_and_other_columns_are_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    base = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.languages(docs, in_fold(5, 0)).collect()}
    other = docs.withColumn("lang", F.when(in_fold(5, 0), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.languages(other.repartition(5), in_fold(5, 0)).collect()} == base


def test_cases(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(i, "the cat and the dog " * (1 + i % 3), "en") for i in range(1, 30)] + [(i, "le chat et la souris " * (1 + i % 3), "fr") for i in range(30, 60)]
    rows += [(60, None, "en"), (61, "", "fr"), (62, "123 !!", None), (None, "the cat", None), (63, "le chat", None), (63, "le chat", None), (64, "la souris " * 60_000, None)]
    docs = spark.createDataFrame(rows, schema)
    for name in ("h", "n", "held_out", "lang_pred", "score", "rows"):
        docs = docs.withColumn(name, F.lit("x"))
    got = sorted(((r["doc_id"], r["lang_pred"], r["held_out"]) for r in L.languages(docs, in_fold(5, 0)).collect()), key=str)
    assert len(got) == len(rows)
    pred = {g[0]: g[1] for g in got}
    assert [pred[k] for k in (60, 61, 62, None, 63, 64)] == ["und", "und", "und", "en", "fr", "fr"]
    assert sum(g[0] == 63 for g in got) == 2 and not any(g[2] for g in got if g[0] is None)
    nothing = L.languages(docs.withColumn("lang", F.lit(None).cast("string")), in_fold(5, 0)).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert L.languages(spark.createDataFrame([], schema), in_fold(5, 0)).count() == 0


@pytest.mark.parametrize("n", [1, 7])
def test_sample_is_bounded_and_repeats_itself(spark, n):
    rows = [(i, f"text {i % 40} letters", "en" if i % 3 else "fr") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    spec = L.LanguageSpec(sample=2 * n)
    first = L.labelled_sample(docs, in_fold(5, 0), spec)
    assert len(first) <= 2 * n and {g for g, _ in first} == {"en", "fr"} and len(set(first)) == len(first)
    assert first == L.labelled_sample(docs.repartition(7), in_fold(5, 0), spec)
