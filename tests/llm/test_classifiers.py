"""Quality and toxicity: held-out accuracy, calibration and the defined cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from umbral.llm.labelled import in_fold
from umbral.llm.quality import QualitySpec, quality_scores
from umbral.llm.subword import Features, platt, sigmoid
from umbral.llm.toxicity import ToxicitySpec, toxicity_scores

SYLLABLES = ["ta", "lo", "mi", "ren", "sha", "ked", "ou", "ble", "tion", "wer"]
DOCS = "doc_id long, text string, lang string, score string, held_out string"


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng, docs, labels = random.Random(1), [], []
    for i in range(400):
        w, bad, toxic = words(rng, rng.randint(30, 90)), i % 4 == 0, i % 5 == 0
        if bad:
            w = [x + rng.choice(["###", "$$$"]) for x in w]
        if toxic:
            for _ in range(2):
                w[rng.randrange(len(w))] = "vexgru" + rng.choice(SYLLABLES)     # endings vary, so some are unseen
        docs.append((i, " ".join(w), "en", "clash", None))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000, None, None, None, None), (1001, "", None, None, None), (1002, "ta " * 60_000, None, None, None), (None, "lo mi", None, None, None),
             (3, docs[3][1], "en", None, None)]
    labels += [(7, None, None), (None, 1, 1), (5000, 1, 0), (8, 0, 0), (8, 0, 0)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def auc(rows, truth):
    pos = [r["score"] for r in rows if truth(r["doc_id"])]
    neg = [r["score"] for r in rows if not truth(r["doc_id"])]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("run, spec, fold, truth", [
    (quality_scores, QualitySpec(bits=14), (5, 0), lambda i: i % 4 != 0),
    (toxicity_scores, ToxicitySpec(bits=14), (4, 2), lambda i: i % 5 == 0)])
def test_held_out_accuracy_and_cases(corpus, run, spec, fold, truth):
    docs, labels = corpus
    rows = run(docs, labels, in_fold(*fold), spec).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 400]
    assert len(held) > 40 and auc(held, truth) > 0.95
    assert len({r["score"] for r in rows if r["doc_id"] in (1000, 1001)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] == 3}) == 1
    assert [r["held_out"] for r in rows if r["doc_id"] is None] == [False]
    again = run(docs, labels, in_fold(*fold), spec).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


@pytest.mark.parametrize("run", [quality_scores, toxicity_scores])
def test_without_labels_and_rows(spark, corpus, run):
    docs, labels = corpus
    none = labels.filter("false")
    rows = run(docs.limit(5), none, in_fold(5, 0)).collect()
    assert [r["score"] for r in rows] == [0.5] * 5
    assert run(docs.filter("false"), none, in_fold(5, 0)).count() == 0
    one = labels.filter("quality = 1 AND toxic = 0")
    assert len({r["score"] for r in run(docs.limit(5), one, in_fold(5, 0)).collect()}) == 1


def test_labels_are_not_read_in_the_fold(spark, corpus):
    docs, labels = corpus
    turned = labels.withColumn("quality", F.when(in_fold(5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality_scores(docs, labels, in_fold(5, 0), QualitySpec(bits=12)).collect()
    b = quality_scores(docs, turned, in_fold(5, 0), QualitySpec(bits=12)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_features_depend_on_the_word_alone():
    one, many = Features(["Taren"], 16), Features(["lo", "taren", "x"], 16)
    assert set(one.ids) == set(many.ids[many.starts[1]:many.starts[2]])
    assert one.count[0] == 1 + 5 + 4 + 3
    assert not len(Features([], 16).ids)


def test_platt_reaches_the_shares():
    rng = np.random.default_rng(0)
    z = rng.normal(size=4000) * 8
    y = (rng.random(4000) < sigmoid(0.7 * z - 2)).astype(int)
    a, b = platt(z, y)
    assert abs(a - 0.7) < 0.1 and abs(b + 2) < 0.3
