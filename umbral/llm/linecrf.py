"""Quality rules: a linear-chain conditional random field over the lines of a text.

Each line is content or boilerplate. Binary features of a line and the label of the line before it
score a labelling; Viterbi decoding finds the best one, and a document is kept if enough of its
words stand in content lines and no base rule fails. Emission and transition weights are trained by
gradient ascent on the conditional likelihood, with forward-backward expectations, over a bounded
sample of documents whose quality label is spread to their lines.

Base measures, over words ``[^\\x20\\x09-\\x0D]+`` of the whole text: word_chars, n_symbols, n_dup_lines
(lines with a word that equal an earlier line) and n_repeat_words (words inside 8-word windows that
occur twice or more in the text).

Defined cases: a null text is an empty one, has no words and fails the base rule; lines without a
word carry no label; ties go to content; repeated rows are judged alike; other columns are ignored;
without labels of both classes all weights are 0 and the base rules alone decide; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import SMALL_SLICE_BYTES, doc_frame, give_back, repeated_words, segment_sum, slices, split_words
from umbral.llm.labelled import training_sample

CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class LineSpec:
    min_words: int = 20
    max_repeat_percent: int = 30
    repeat_window: int = 8
    content_share: float = 0.5     # of the words, in lines decoded as content
    per_class: int = 400           # documents of each class in the training sample
    max_chars: int = 12_000        # longer texts are not trained on; all are decoded whole
    epochs: int = 12
    rate: float = 0.5
    penalty: float = 1e-3
    seed: int = 3


#: What a line feature says; the columns of ``line_features`` in order.
FEATURES = ("any", "one_or_two_words", "three_to_five_words", "over_forty_words", "symbols_over_3_percent", "symbols_over_10_percent", "has_pipe",
            "over_three_pipes", "letters_under_60_percent", "letters_under_80_percent", "digits_over_10_percent", "ends_a_sentence",
            "starts_upper", "repeats_earlier_line", "exclamations", "mean_word_over_12", "mean_word_under_3", "long_repeats")


@dataclass(frozen=True)
class ChainModel:
    emission: np.ndarray       # features x 2
    transition: np.ndarray     # from x to
    start: np.ndarray


def untrained() -> ChainModel:
    return ChainModel(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2))


@dataclass
class Lines:
    """The lines with a word of a slice of texts: per line its text's row, words and features."""
    row: np.ndarray
    offsets: np.ndarray        # lines per text
    words: np.ndarray
    features: np.ndarray
    duplicates: np.ndarray     # per text


def _count(text: pa.Array, pattern: str) -> np.ndarray:
    return np.asarray(pc.count_substring_regex(text, pattern), dtype=np.int64)


def read_lines(text: pa.Array) -> Lines:
    """Lines and their features; everything that depends on the line alone is found once per distinct line."""
    parts = pc.split_pattern(text, "\n")
    offsets = np.asarray(parts.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    coded = parts.flatten().dictionary_encode()
    code, line = np.asarray(coded.indices, dtype=np.int64), coded.dictionary
    words = _count(line, r"[^\x20\x09-\x0D]+")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    full = words[code] > 0 if len(code) else np.zeros(0, bool)
    code, row = code[full], row[full]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])
    key = row * max(len(line), 1) + code
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = key[order[1:]] == key[order[:-1]]
    chars = np.maximum(np.asarray(pc.utf8_length(line), dtype=np.int64), 1)
    symbol, pipe = _count(line, r"[#*$%&|<>]"), _count(line, r"\|")
    letter, digit, space = _count(line, r"\pL"), _count(line, r"[0-9]"), _count(line, r"[\x20\x09-\x0D]")
    w = np.maximum(words, 1)
    mean = (chars - space) / w
    solid = np.maximum(chars - space, 1)
    alone = np.stack([np.ones(len(w), bool), words <= 2, (words >= 3) & (words <= 5), words > 40, symbol > 0.03 * solid, symbol > 0.10 * solid, pipe > 0, pipe > 3,
                      letter < 0.6 * solid, letter < 0.8 * solid, digit > 0.1 * solid,
                      np.asarray(pc.match_substring_regex(line, r"[.!?…][\x20\x09-\x0D]*\z"), bool),
                      np.asarray(pc.match_substring_regex(line, r"\A[\x20\x09-\x0D]*\p{Lu}"), bool), np.zeros(len(w), bool),
                      _count(line, r"!!|!\x20") > 0, mean > 12, mean < 3, np.zeros(len(w), bool)], axis=1)
    features = alone[code].astype(np.float64)
    features[:, FEATURES.index("repeats_earlier_line")] = later
    features[:, FEATURES.index("long_repeats")] = later & (words[code] > 5)
    return Lines(row, offsets, words[code], features, np.bincount(row[later], minlength=len(offsets) - 1))


def viterbi(score: np.ndarray, offsets: np.ndarray, model: ChainModel) -> np.ndarray:
    """The best label of every line; chains are decoded side by side, a position at a time, ties to content."""
    n = np.diff(offsets)
    label = np.zeros(len(score), np.int8)
    gain = score[:, BOILERPLATE] - score[:, CONTENT]
    (cc, cb), (bc, bb) = model.transition
    for chain in np.flatnonzero(n > 512):      # long chains one by one: few are that long at a time
        label[offsets[chain]:offsets[chain + 1]] = _viterbi_one(gain[offsets[chain]:offsets[chain + 1]], model)
    order = np.flatnonzero((n > 0) & (n <= 512))
    order = order[np.argsort(-n[order], kind="stable")]
    if not len(order):
        return label
    first, length = offsets[order], n[order]
    back = np.zeros((len(score), 2), np.int8)
    diff = model.start[1] - model.start[0] + gain[first]       # best score ending in boilerplate less that in content
    last = np.zeros(len(order))
    active = np.array([np.searchsorted(-length, -t, side="right") for t in range(1, int(length[0]) + 1)])
    for t in range(int(length[0])):
        k = int(active[t])
        if t:
            d = diff[:k]
            from_c, from_b = cc >= d + bc, cb >= d + bb
            back[first[:k] + t, 0], back[first[:k] + t, 1] = ~from_c, ~from_b
            diff[:k] = np.maximum(cb, d + bb) - np.maximum(cc, d + bc) + gain[first[:k] + t]
    state = (diff > 0).astype(np.int8)
    for t in range(int(length[0]) - 1, -1, -1):
        k = int(active[t])
        at = first[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return label


def _viterbi_one(gain: np.ndarray, model: ChainModel) -> np.ndarray:
    (cc, cb), (bc, bb) = model.transition.tolist()
    back, d = [], 0.0
    for t, g in enumerate(gain.tolist()):
        if t:
            back.append((d + bc > cc, d + bb > cb))
            d = max(cb, d + bb) - max(cc, d + bc) + g
        else:
            d = float(model.start[1] - model.start[0]) + g
    out = np.zeros(len(gain), np.int8)
    state = int(d > 0)
    for t in range(len(gain) - 1, -1, -1):
        out[t] = state
        if t:
            state = int(back[t - 1][state])
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def train_chain(chains: list[np.ndarray], label: np.ndarray, spec: LineSpec) -> ChainModel:
    """Weights that raise the likelihood of every line of chain i having label[i], by AdaGrad steps per chain."""
    rng = np.random.default_rng(spec.seed)
    m = untrained()
    e, t, s = m.emission, m.transition, m.start
    past = [np.full(x.shape, 1e-2) for x in (e, t, s)]
    for _ in range(spec.epochs):
        for i in rng.permutation(len(chains)):
            x, y = chains[i], int(label[i])
            score = x @ e
            fwd, bwd = np.empty_like(score), np.zeros_like(score)
            fwd[0] = score[0] + s
            for k in range(1, len(x)):
                fwd[k] = score[k] + _log_sum(fwd[k - 1][:, None] + t, 0)
            for k in range(len(x) - 2, -1, -1):
                bwd[k] = _log_sum(t + (score[k + 1] + bwd[k + 1])[None, :], 1)
            z = _log_sum(fwd[-1], 0)
            node = np.exp(fwd + bwd - z)
            want = np.zeros_like(node)
            want[:, y] = 1
            ge, gs = x.T @ (want - node), want[0] - node[0]
            gt = np.zeros((2, 2))
            if len(x) > 1:
                pair = np.exp(fwd[:-1, :, None] + t[None] + (score[1:] + bwd[1:])[:, None, :] - z)
                gt = -pair.sum(axis=0)
                gt[y, y] += len(x) - 1
            for w, g, h in ((e, ge, past[0]), (t, gt, past[1]), (s, gs, past[2])):
                g = g / len(x) - spec.penalty * w
                h += g * g
                w += spec.rate * g / np.sqrt(h)
    return ChainModel(e, t, s)


def fit_lines(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, spec: LineSpec = LineSpec(), label: str = "quality") -> ChainModel:
    """A model from labelled documents; with one class or none, the untrained one."""
    sample, counts = training_sample(docs, labels, label, F.lit(False) if held_out is None else held_out, spec.per_class, spec.max_chars)
    if len(counts) < 2:
        return untrained()

    def run(batches):
        for batch in slices(batches):
            lines = read_lines(batch.column("text"))
            packed = np.packbits(lines.features.astype(bool), axis=1)
            cells = [packed[a:b].tobytes() for a, b in zip(lines.offsets[:-1], lines.offsets[1:])]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), batch.column("y").cast(pa.int32()), pa.array(cells, pa.binary())], names=["doc_id", "y", "lines"])

    rows = sorted(sample.mapInArrow(run, "doc_id long, y int, lines binary").collect(), key=lambda r: r["doc_id"])
    rows = [r for r in rows if len(r["lines"])]
    wide = -(-len(FEATURES) // 8)
    chains = [np.unpackbits(np.frombuffer(r["lines"], np.uint8).reshape(-1, wide), axis=1)[:, :len(FEATURES)].astype(float) for r in rows]
    y = np.array([CONTENT if r["y"] == 1 else BOILERPLATE for r in rows])
    return train_chain(chains, y, spec) if len(set(y.tolist())) == 2 else untrained()


def judge(docs: DataFrame, model: ChainModel, spec: LineSpec = LineSpec()) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_words, base_failed, kept) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_words"]

    def run(batches):
        m = shared.value
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            text = batch.column("text")
            offsets, words = split_words(text)
            coded = words.dictionary_encode()
            code = np.asarray(coded.indices, dtype=np.int64)
            chars = np.asarray(pc.utf8_length(coded.dictionary), dtype=np.int64)
            symbols = _count(coded.dictionary, r"[#*$%&|<>]")
            lines = read_lines(text)
            label = viterbi(lines.features @ m.emission, lines.offsets, m)
            n = np.diff(offsets)
            repeats = repeated_words(code, offsets, spec.repeat_window)
            content = segment_sum(np.where(label == CONTENT, lines.words, 0), lines.offsets)
            failed = (n < spec.min_words) | (100 * repeats > spec.max_repeat_percent * n)
            cells = [n, segment_sum(chars[code], offsets), segment_sum(symbols[code], offsets), lines.duplicates, repeats, content]
            yield pa.record_batch([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cells], pa.array(failed),
                                   pa.array(~failed & (content >= spec.content_share * n))], names=["doc_id", *names, "base_failed", "kept"])
        give_back()

    frame = doc_frame(docs)
    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean")


def kept_documents(docs: DataFrame, model: ChainModel, spec: LineSpec = LineSpec()) -> DataFrame:
    """The rows of ``docs`` that pass; the verdict is taken on each row's own text."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    at = columns.index("text")

    def run(batches):
        m = shared.value
        for batch in slices(batches, limit=SMALL_SLICE_BYTES):
            text = pc.fill_null(batch.column(at), "")
            offsets, words = split_words(text)
            code = np.asarray(words.dictionary_encode().indices, dtype=np.int64)
            lines = read_lines(text)
            label = viterbi(lines.features @ m.emission, lines.offsets, m)
            n = np.diff(offsets)
            failed = (n < spec.min_words) | (100 * repeated_words(code, offsets, spec.repeat_window) > spec.max_repeat_percent * n)
            content = segment_sum(np.where(label == CONTENT, lines.words, 0), lines.offsets)
            yield batch.filter(pa.array(~failed & (content >= spec.content_share * n)))
        give_back()

    return docs.mapInArrow(run, docs.schema)
