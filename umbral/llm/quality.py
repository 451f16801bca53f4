"""Quality classifier: supervised subword embeddings averaged per document.

Every word and every character n-gram of it has a learned vector in a hashed table, and so has the
fact that a word stands in an n-gram of words which the text has already used: a hashed word n-gram whose
hash is that of "seen before". A document is the mean of the vectors of all its features, a softmax over that mean gives the class, and vectors
and softmax are trained together by stochastic gradient descent in numpy on a bounded sample.

Because the output is linear in the mean, a fitted model scores through one number per bucket: the
difference of the two class logits. Only that table (2 ** bits floats) is shipped to the executors,
and a batch computes it once per distinct word.

Defined cases: a null text is an empty one; a text without words has the intercept's score; repeated
rows are scored alike, each on its own; other columns are ignored; without labels of both classes
the score is the share of label 1 (0.5 if there are none); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, repeated_words, segment_sum, slices
from umbral.llm.labelled import training_sample
from umbral.llm.subword import coded_words, platt, sigmoid


@dataclass(frozen=True)
class QualitySpec:
    """Sizes of the model and bounds of the sample it is fitted on."""
    bits: int = 18            # buckets of the hashed table, as a power of two
    dim: int = 8
    epochs: int = 8
    rate: float = 8.0
    per_class: int = 1500     # documents of each class in the training sample
    max_chars: int = 20_000   # longer texts are not trained on; all texts are scored whole
    repeat_window: int = 5    # words of an n-gram that counts as seen before
    repeat_mass: int = 10     # features that one word in such an n-gram counts as
    threshold: float = 0.3
    seed: int = 11


@dataclass(frozen=True)
class LinearModel:
    """Class-logit difference per bucket, and the intercept."""
    table: np.ndarray
    intercept: float


def _bags(spec: QualitySpec):
    """Arrow function: each training text as its distinct features with their shares, packed."""
    def run(batches):
        for batch in slices(batches):
            offsets, index, feats = coded_words(batch.column("text"), spec.bits)
            ids, shares = [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                word, n = np.unique(index[a:b], return_counts=True)
                flat = np.concatenate([feats.ids[feats.starts[w]:feats.starts[w + 1]] for w in word]) if len(word) else np.zeros(0, np.int32)
                bucket, at = np.unique(flat, return_inverse=True)
                mass = np.bincount(at, weights=np.repeat(n, feats.count[word]), minlength=len(bucket)) if len(word) else np.zeros(0)
                seen = spec.repeat_mass * repeated_words(index[a:b], np.array([0, b - a]), spec.repeat_window)[0]
                if seen:
                    bucket, mass = np.append(bucket, 1 << spec.bits), np.append(mass, seen)
                ids.append(bucket.astype(np.int32).tobytes())
                shares.append((mass / max(mass.sum(), 1)).astype(np.float32).tobytes())
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("y").cast(pa.int32()), pa.array(ids, pa.binary()),
                                   pa.array(shares, pa.binary())], names=["doc_id", "y", "ids", "shares"])
    return run


def train_average(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, spec: QualitySpec) -> LinearModel:
    """Joint descent on vectors and softmax, one document at a time, the rate falling linearly."""
    rng = np.random.default_rng(spec.seed)
    vectors = rng.uniform(-1 / spec.dim, 1 / spec.dim, ((1 << spec.bits) + 1, spec.dim)).astype(np.float32)
    out = np.zeros((2, spec.dim), np.float32)
    out[1, :spec.dim // 2], out[0, spec.dim // 2:] = 0.1, 0.1
    bias = np.zeros(2, np.float32)
    steps, at = max(1, spec.epochs * len(bags)), 0
    for _ in range(spec.epochs):
        for i in rng.permutation(len(bags)):
            ids, share = bags[i]
            rate = spec.rate * (1 - at / steps)
            at += 1
            mean = share @ vectors[ids] if len(ids) else np.zeros(spec.dim, np.float32)
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = p @ out
            out -= np.float32(0.05 * rate) * np.outer(p, mean)
            bias -= np.float32(0.01 * rate) * p
            if len(ids):
                # step per feature scaled by its share over the bag's mean share
                vectors[ids] -= np.float32(rate) * (share / share.max())[:, None] * back[None, :] * np.float32(0.02)
    table = vectors @ (out[1] - out[0])
    return LinearModel(table.astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, held_out: Column, spec: QualitySpec = QualitySpec(),
                label: str = "quality") -> LinearModel:
    """The model fitted on the bounded sample, its logits set to the class shares of all labels."""
    sample, counts = training_sample(docs, labels, label, held_out, spec.per_class, spec.max_chars)
    flat = LinearModel(np.zeros((1 << spec.bits) + 1, np.float32), float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))))
    if len(counts) < 2:
        return flat
    rows = sorted(sample.mapInArrow(_bags(spec), "doc_id long, y int, ids binary, shares binary").collect(), key=lambda r: r["doc_id"])
    y = np.array([r["y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return flat
    bags = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
    raw = train_average(bags, y, spec)
    logit = np.array([share @ raw.table[ids] if len(ids) else 0.0 for ids, share in bags]) + raw.intercept
    a, b = platt(logit, y)
    prior = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return LinearModel((raw.table * a).astype(np.float32), float(raw.intercept * a + b + prior))


def score_quality(docs: DataFrame, model: LinearModel, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """(doc_id, score) of every row: the probability of label 1 over the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.table, model.intercept))

    def run(batches):
        table, intercept = shared.value
        for batch in slices(batches):
            offsets, index, feats = coded_words(batch.column("text"), spec.bits)
            total = segment_sum(feats.word_sums(table)[index], offsets)
            count = segment_sum(feats.count[index], offsets)
            seen = spec.repeat_mass * repeated_words(index, offsets, spec.repeat_window)
            total, count = total + seen * float(table[-1]), count + seen
            score = sigmoid(total / np.maximum(count, 1) + intercept)
            yield pa.record_batch([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    frame = doc_frame(docs)
    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, spec: QualitySpec = QualitySpec()) -> DataFrame:
    """(doc_id, held_out, score, predicted): the model fitted outside the fold, applied to every row."""
    model = fit_quality(docs, labels, held_out, spec)
    return score_quality(docs, model, spec).select("doc_id", held_out.alias("held_out"), "score",
                                                   (F.col("score") >= spec.threshold).cast("int").alias("predicted"))
