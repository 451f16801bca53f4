"""Toxicity: bags of subword vectors averaged into a linear softmax, trained jointly in numpy.

A bag is a short run of words; its vector is the mean over the vectors of all words and character
n-grams in it, so a misspelt or inflected word that was never seen is near the words it shares
n-grams with. A document is as toxic as its most toxic bag, which keeps one insult visible in a text
of any length. Training starts with whole documents as bags and goes on with the highest bag of each
document. The output is calibrated on the training sample to the class shares of all labels.

Defined cases: a null text is an empty one; a text without words has the score of the lowest logit
seen in training; repeated rows are scored alike; other columns are ignored; without labels of both
classes the score is the share of label 1 (0.5 if there are none); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, slices
from umbral.llm.labelled import training_sample
from umbral.llm.subword import coded_words, platt, sigmoid


@dataclass(frozen=True)
class ToxicitySpec:
    """Sizes of the model and bounds of the sample it is fitted on."""
    bits: int = 18
    dim: int = 8
    window: int = 3           # words in a bag
    warm_epochs: int = 2
    epochs: int = 10
    rate: float = 0.6
    decay: float = 1e-3       # shrinking of the vectors that a step touches
    per_class: int = 1200     # documents of each class in the training sample
    max_chars: int = 12_000   # longer texts are not trained on; all texts are scored whole
    spare: int = 4            # one sample document in so many is for the calibration
    threshold: float = 0.3
    seed: int = 5


@dataclass(frozen=True)
class BagModel:
    """Logit difference per bucket, intercept, calibration, and the logit of an empty text."""
    table: np.ndarray
    intercept: float
    slope: float
    shift: float
    empty: float


def window_sums(values: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first positions of all runs of ``width`` words inside a text, or of the whole shorter text, their ends)."""
    length = np.diff(offsets)
    start = np.arange(len(values))
    text = np.repeat(np.arange(len(length)), length)
    end = np.minimum(start + width, offsets[1:][text])
    ok = (end - start == width) | (start == offsets[:-1][text])
    return start[ok], end[ok]


def _texts(spec: ToxicitySpec):
    """Arrow function: each training text as word indices into its own table of features, packed."""
    def run(batches):
        for batch in slices(batches):
            offsets, index, feats = coded_words(batch.column("text"), spec.bits)
            index_col, starts_col, ids_col = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                word, at = np.unique(index[a:b], return_inverse=True)
                flat = [feats.ids[feats.starts[w]:feats.starts[w + 1]] for w in word]
                index_col.append(at.astype(np.int32).tobytes())
                starts_col.append(np.concatenate([[0], np.cumsum(feats.count[word])]).astype(np.int32).tobytes())
                ids_col.append(np.concatenate(flat).astype(np.int32).tobytes() if flat else b"")
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("y").cast(pa.int32()), pa.array(index_col, pa.binary()),
                                   pa.array(starts_col, pa.binary()), pa.array(ids_col, pa.binary())],
                                  names=["doc_id", "y", "words", "starts", "ids"])
    return run


def train_bags(texts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], y: np.ndarray, spec: ToxicitySpec):
    """(vectors' logit differences, intercept): whole documents first, then each document's highest bag."""
    rng = np.random.default_rng(spec.seed)
    vectors = rng.uniform(-0.05, 0.05, (1 << spec.bits, spec.dim)).astype(np.float32)
    out = np.zeros((2, spec.dim), np.float32)
    out[1, :spec.dim // 2], out[0, spec.dim // 2:] = 1.0, 1.0
    bias = np.zeros(2, np.float32)
    total, at = max(1, (spec.warm_epochs + spec.epochs) * len(texts)), 0
    for epoch in range(spec.warm_epochs + spec.epochs):
        for i in rng.permutation(len(texts)):
            words, starts, ids = texts[i]
            rate = np.float32(spec.rate * (1 - at / total))
            at += 1
            if not len(words):
                continue
            if epoch < spec.warm_epochs:
                chosen = ids
            else:
                per_word = np.add.reduceat(vectors[ids] @ (out[1] - out[0]), starts[:-1])
                n = np.diff(starts)
                s = np.concatenate([[0.0], np.cumsum(per_word[words])])
                c = np.concatenate([[0], np.cumsum(n[words])])
                width = min(spec.window, len(words))
                best = int(np.argmax((s[width:] - s[:-width]) / (c[width:] - c[:-width])))
                chosen = np.concatenate([ids[starts[w]:starts[w + 1]] for w in words[best:best + width]])
            bucket, count = np.unique(chosen, return_counts=True)
            share = (count / count.sum()).astype(np.float32)
            mean = share @ vectors[bucket]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = p @ out
            # AdaGrad-free: a bag's step is spread over its features in proportion to their share
            vectors[bucket] = vectors[bucket] * (1 - spec.decay) - rate * (share / share.max())[:, None] * back[None, :]
            out -= rate * np.float32(0.02) * np.outer(p, mean)
            bias -= rate * np.float32(0.05) * p
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def top_bag(words: np.ndarray, sums: np.ndarray, counts: np.ndarray, offsets: np.ndarray, width: int, empty: float) -> np.ndarray:
    """The highest mean logit among the bags of each text; ``empty`` for a text without words."""
    start, end = window_sums(words, offsets, width)
    s = np.concatenate([[0.0], np.cumsum(sums[words])])
    c = np.concatenate([[0], np.cumsum(counts[words])])
    mean = (s[end] - s[start]) / np.maximum(c[end] - c[start], 1)
    out = np.full(len(offsets) - 1, empty)
    has = np.flatnonzero(np.diff(offsets) > 0)
    if len(has):
        out[has] = np.maximum.reduceat(mean, np.searchsorted(start, offsets[:-1][has]))
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, spec: ToxicitySpec = ToxicitySpec(),
                 label: str = "toxic") -> BagModel:
    sample, counts = training_sample(docs, labels, label, held_out, spec.per_class, spec.max_chars)
    flat = BagModel(np.zeros(1 << spec.bits, np.float32), 0.0, 0.0, float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))), 0.0)
    if len(counts) < 2:
        return flat
    rows = sorted(sample.mapInArrow(_texts(spec), "doc_id long, y int, words binary, starts binary, ids binary").collect(), key=lambda r: r["doc_id"])
    y = np.array([r["y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return flat
    texts = [tuple(np.frombuffer(r[c], np.int32) for c in ("words", "starts", "ids")) for r in rows]
    del rows
    # one document in ``spare`` is kept from training, for a calibration on texts the vectors have not seen
    aside = np.arange(len(y)) % spec.spare == spec.spare - 1
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    fit = np.flatnonzero(~aside)
    table, intercept = train_bags([texts[i] for i in fit], y[fit], spec)
    top = np.array([top_bag(w, np.add.reduceat(table[ids].astype(np.float64), st[:-1]), np.diff(st), np.array([0, len(w)]), spec.window, 0.0)[0]
                    if len(w) else np.nan for w, st, ids in texts])
    ok = ~np.isnan(top)
    check = ok & aside if len(set(y[ok & aside].tolist())) == 2 else ok
    slope, shift = platt(top[check], y[check])
    share = y[check].mean()
    prior = np.log(counts[1] / counts[0]) - np.log(share / (1 - share)) if 0 < share < 1 else 0.0
    return BagModel(table, intercept, slope, float(shift + prior), float(top[ok].min()))


def score_toxicity(docs: DataFrame, model: BagModel, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """(doc_id, score) of every row: the probability of label 1 by the most toxic bag of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.slope, model.shift, model.empty))

    def run(batches):
        table, slope, shift, empty = shared.value
        for batch in slices(batches):
            offsets, index, feats = coded_words(batch.column("text"), spec.bits)
            top = top_bag(index, feats.word_sums(table), feats.count, offsets, spec.window, empty)
            yield pa.record_batch([batch.column("doc_id"), pa.array(sigmoid(slope * top + shift), pa.float64())], names=["doc_id", "score"])

    frame = doc_frame(docs)
    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column, spec: ToxicitySpec = ToxicitySpec()) -> DataFrame:
    """(doc_id, held_out, score, predicted): the model fitted outside the fold, applied to every row."""
    model = fit_toxicity(docs, labels, held_out, spec)
    return score_toxicity(docs, model, spec).select("doc_id", held_out.alias("held_out"), "score",
                                                    (F.col("score") >= spec.threshold).cast("int").alias("predicted"))
