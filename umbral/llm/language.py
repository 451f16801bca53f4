"""Language of a text by string kernels: Nyström landmarks and one-versus-rest kernel ridge regression.

The blended spectrum of a text is the set of its character n-grams of 1 to ``width`` letters, where case is
folded and every run of other characters is one gap. The kernel of two texts is the number of n-grams both
have, over the geometric mean of how many each has. Landmarks are labelled texts, as many of each language;
a text is seen through its kernels with them, and one ridge regression a language, fitted in that space,
scores it. Scoring a batch is three matrix products: presence by landmarks, kernels by whitening and
weights (kept as one matrix), the largest column wins.

N-grams are hashed into ``buckets`` columns, so presence is a matrix of bits whatever the script.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.llm.common import doc_frame, ship_package, slices

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSpec:
    """``sample``: labelled texts fitted on at most, dealt evenly to the languages (one each at least), of up to
    ``max_chars`` characters; ``landmarks``: how many of them are landmarks; ``ridge``: weight of the penalty.
    """
    width: int = 4
    buckets: int = 1 << 15
    sample: int = 1600
    max_chars: int = 20_000
    landmarks: int = 128
    ridge: float = 0.01


# ---- presence -----------------------------------------------------------------------------

_GAP = np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LETTERS: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For every code point whether it is a letter or a mark written on one."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, symbols, whether a text has a letter): letters in lower case, between them, before and after them one gap."""
    raw = [t.lower() for t in texts]
    flat = np.frombuffer("\n".join([*raw, ""]).encode("utf-32-le", "surrogatepass"), np.uint32) if raw else np.zeros(0, np.uint32)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    letter = letter_table()[flat]
    # of a run of other characters its first stays; the line end after every text is one, the first before a text is not its own
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    symbols = np.where(letter, flat, _GAP)[keep]
    n_letters = np.concatenate([[0], np.cumsum(letter)])[np.concatenate([[0], ends])]
    return np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])], symbols, np.diff(n_letters) > 0


def presence(texts: list[str], spec: LanguageSpec) -> tuple[np.ndarray, np.ndarray]:
    """(texts x buckets, 1 where the text has an n-gram of the bucket; whether the text has a letter)."""
    offsets, symbols, has = folded(texts)
    out = np.zeros((len(texts), spec.buckets), np.uint8)
    row = np.repeat(np.arange(len(texts)) * spec.buckets, np.diff(offsets))
    # a gap before the first letter, too
    front = np.flatnonzero(np.diff(offsets) > 0)
    symbols = np.insert(symbols.astype(np.uint64), offsets[front], _GAP)
    row = np.insert(row, offsets[front], front * spec.buckets)
    mixed = (symbols + np.uint64(1)) * _ODD
    mixed ^= mixed >> np.uint64(29)
    shift = np.uint64(64 - (spec.buckets - 1).bit_length())
    flat, h = out.reshape(-1), np.zeros(len(symbols), np.uint64)
    for n in range(1, spec.width + 1):
        if len(symbols) < n:
            break
        h = (h[:len(symbols) - n + 1] + mixed[n - 1:]) * _ODD
        h ^= h >> np.uint64(32)
        same = row[:len(h)] == row[n - 1:]
        flat[(row[:len(h)] + ((h * _ODD) >> shift).astype(np.int64))[same]] = 1
    return out, has


# ---- fitting ------------------------------------------------------------------------------

class LanguageModel:
    """Landmarks as packed presence rows, which is what travels; ``weights``: one row a landmark and the constant last, one column a language."""

    def __init__(self, spec: LanguageSpec, langs: list[str], marks: np.ndarray, weights: np.ndarray):
        self.spec, self.langs, self.packed, self.weights = spec, langs, np.packbits(marks, axis=1), weights
        self._marks = None

    def __getstate__(self):
        return self.__dict__ | {"_marks": None}

    def scores(self, x: np.ndarray) -> np.ndarray:
        """texts x languages: about 1 for the language of a text and -1 for the others; a text's row does not depend on its neighbours."""
        if self._marks is None:
            self._marks = np.unpackbits(self.packed, axis=1).astype(np.float32)
        return np.einsum("ij,jk->ik", kernel(x, self._marks), self.weights[:-1]) + self.weights[-1]


#: Presence rows turned into floats at a time.
_ROWS = 128


def kernel(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernels of presence rows with those of the landmarks, a bounded batch at a time; the products count n-grams, so they are exact."""
    out, size = np.zeros((len(x), len(marks))), np.sqrt(np.maximum(marks.sum(axis=1, dtype=np.float64), 1))
    for at in range(0, len(x), _ROWS):
        part = x[at:at + _ROWS]
        own = np.sqrt(np.maximum(part.sum(axis=1, dtype=np.int64), 1))
        out[at:at + _ROWS] = (part.astype(np.float32) @ marks.T) / own[:, None] / size
    return out


def fit(texts: list[str], langs: list[str], spec: LanguageSpec = LanguageSpec()) -> LanguageModel | None:
    """The model of texts in a fixed order; landmarks are the first of each language. None without a text that has a letter."""
    x, has = presence(texts, spec)
    x, langs = x[has], [g for g, h in zip(langs, has) if h]
    names = sorted(set(langs))
    if not names:
        return None
    y = np.array([names.index(g) for g in langs])
    each = max(1, spec.landmarks // len(names))
    chosen = np.concatenate([np.flatnonzero(y == k)[:each] for k in range(len(names))])
    marks = x[chosen].astype(np.float32)
    # whitening by the landmarks' own kernels; directions without weight are left out
    value, vector = np.linalg.eigh(kernel(x[chosen], marks))
    good = value > 1e-6 * value[-1]
    white = vector[:, good] / np.sqrt(value[good])
    z = np.concatenate([kernel(x, marks) @ white, np.ones((len(x), 1))], axis=1)
    target = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    # languages weigh alike however many of their texts are in the sample
    weight = (1.0 / np.bincount(y))[y][:, None] / len(names)
    penalty = np.full(z.shape[1], spec.ridge / len(z))
    penalty[-1] = 0.0
    beta = np.linalg.solve(z.T @ (z * weight) + np.diag(penalty), z.T @ (target * weight))
    return LanguageModel(spec, names, x[chosen], np.concatenate([white @ beta[:-1], beta[-1:]]))


def labelled_sample(docs: DataFrame, held_out: Column, spec: LanguageSpec) -> list[tuple[str, str]]:
    """(lang, text) to fit on: of each language outside the fold, distinct texts whose hashes are the lowest.

    At most ``spec.sample`` pairs in all; where there are more languages than that, the most frequent ones.
    """
    rows = (docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.length("text") <= spec.max_chars) & ~held_out)
            .select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h")))
    held = (rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"), F.count(F.lit(1)).alias("rows"))
            .orderBy(F.desc("rows"), "lang").limit(spec.sample).collect())
    if not held:
        return []
    each = max(1, spec.sample // len(held))
    # about twice as many distinct texts as are taken, all where there are few
    limit = F.create_map(*[F.lit(v) for r in held for v in (r["lang"], int(min(1.0, (2 * each + 16) / max(r["n"], 1)) * (1 << 30)))])
    some = rows.filter(F.pmod("h", F.lit(1 << 30)) < F.try_element_at(limit, F.col("lang"))).dropDuplicates(["lang", "text"])
    by_lang: dict[str, list] = {}
    for r in some.collect():
        by_lang.setdefault(r["lang"], []).append((r["h"], r["text"]))
    return [(g, t) for g in sorted(by_lang) for _, t in sorted(by_lang[g])[:each]]


# ---- scoring ------------------------------------------------------------------------------

def predict(texts: list[str], model: LanguageModel | None) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    names, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is None:
        return names, score
    for at in range(0, len(texts), _ROWS):
        x, has = presence(texts[at:at + _ROWS], model.spec)
        value = model.scores(x)
        best = value.argmax(axis=1)
        for i in np.flatnonzero(has).tolist():
            names[at + i] = model.langs[best[i]]
            score[at + i] = min(1.0, max(0.0, (1.0 + float(value[i, best[i]])) / 2))
    return names, score


def languages(docs: DataFrame, held_out: Column, spec: LanguageSpec = LanguageSpec()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per document, learned from the rows outside the fold.

    Null texts and texts without a letter are ``und`` with score 0, as every text is where nothing is labelled;
    ties go to the language that sorts first. Rows that repeat count each; copies of a text are one in the
    sample. A null doc_id is outside the fold. An empty table gives no rows; only doc_id, text and lang are
    read, so further columns may have any name. Memory grows with the longest single text.
    """
    ship_package(docs.sparkSession)
    pairs = labelled_sample(docs, held_out, spec)
    model = fit([t for _, t in pairs], [g for g, _ in pairs], spec)
    rows = doc_frame(docs, held_out.alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            names, score = predict(part.column("text").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                                             names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
