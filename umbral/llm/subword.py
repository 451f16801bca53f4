"""Hashed words and character n-grams of many words at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from umbral.llm.common import split_words, unique_words

_MULT, _MIX, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Features:
    """Hashed features of distinct words: ``ids`` of word w stand at ``starts[w] : starts[w + 1]``.

    Features of a word are one for the whole word and one for every character n-gram of ``<word>``
    with n in ``sizes``, each a bucket below ``2 ** bits``. Words count in lower case.
    """

    def __init__(self, words: list[str], bits: int, sizes: tuple[int, ...] = (3, 4, 5), whole: bool = True):
        marked = [f"<{w.lower()}>" for w in words]
        length = np.fromiter(map(len, marked), np.int64, len(marked))
        point = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum(length)])
        word = np.repeat(np.arange(len(marked)), length)
        left = first[1:][word] - np.arange(len(point))      # characters up to the end of the word
        shift = np.uint64(64 - bits)
        part, owner = [], []
        rolling = point + np.uint64(1)
        for n in range(2, max(sizes) + 1):
            rolling = rolling[:-1] * _MULT + point[n - 1:] if len(rolling) > 1 else rolling[:0]
            if n in sizes:
                ok = np.flatnonzero(left[:len(rolling)] >= n)
                h = (rolling[ok] ^ (rolling[ok] >> np.uint64(31))) * _MIX + np.uint64(n * int(_WORD) % 2 ** 64)
                part.append(((h ^ (h >> np.uint64(29))) * _MULT) >> shift)
                owner.append(word[ok])
        if whole and len(marked):
            place = (np.arange(len(point)) - first[word]).astype(np.uint64)
            term = (point + _WORD) * ((place * np.uint64(2) + np.uint64(1)) * _MIX ^ (place + _MULT))
            h = np.add.reduceat(term, first[:-1])
            part.append(((h ^ (h >> np.uint64(32))) * _MULT) >> shift)
            owner.append(np.arange(len(marked)))
        owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        self.ids = np.concatenate(part).astype(np.int32)[order] if part else np.zeros(0, np.int32)
        self.count = np.bincount(owner, minlength=len(marked)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.count)])

    def word_sums(self, table: np.ndarray) -> np.ndarray:
        """Per word, the sum of ``table`` over its features."""
        if not len(self.count):
            return np.zeros(0)
        return np.add.reduceat(table[self.ids].astype(np.float64), self.starts[:-1])


def coded_words(text: pa.Array, bits: int, sizes: tuple[int, ...] = (3, 4, 5), whole: bool = True):
    """(word offsets per text, index of each word, Features of the distinct words)."""
    offsets, words = split_words(text)
    index, distinct = unique_words(words)
    return offsets, index, Features(distinct, bits, sizes, whole)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def platt(logit: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """(slope, intercept) of a logistic fit of labels on logits, by Newton steps with halving."""
    n1, n0 = label.sum(), (1 - label).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    soft = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([logit, np.ones_like(logit)], 1)
    loss = lambda w: float(np.sum(np.logaddexp(0, x @ w) - soft * (x @ w)))
    w = np.array([0.0, np.log(n1 / n0)])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - soft))
        size, before = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > before:
            size /= 2
        w = w - size * step
        if before - loss(w) < 1e-10 * max(1.0, before):
            break
    a, b = w
    return float(a), float(b)
