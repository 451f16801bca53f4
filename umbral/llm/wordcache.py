"""Whole-text encoding through distinct words: the same ids as the tokenizer gives, at a fraction of the work.

A tokenizer whose pre-tokens never cross the border between two words gives for a text the ids of its
words one after the other. So a slice of texts is cut into words in Arrow, the distinct ones are encoded
by the library, and the ids are gathered. Words seen before stay in a bounded cache of the worker.

mode "leading": a word owns the single space before it (byte-level vocabularies). Texts in which a
space meets other white space are encoded whole. mode "dropped": white space makes no ids, so words
are cut at any of it. mode "whole": every text is encoded whole.
"""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from umbral.llm.common import split_words

MODES = ("leading", "dropped", "whole")


#: Words of these characters alone are normalised letter by letter, and their pre-tokens are runs of letters, single digits or runs of the rest.
_PLAIN = r"\A[A-Za-z0-9À-ÿ!-&(-/:-@\[-`{-~]+\z"
_PRETOKEN = r"\pL+|\pN|[^\pL\pN]+"


class WordEncoder:
    def __init__(self, path: str, mode: str, cache_words: int = 900_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer
        self.tokenizer, self.mode, self.limit = Tokenizer.from_file(path), mode, cache_words
        vocab = self.tokenizer.get_vocab()
        edge = [i for t, i in vocab.items() if (t[:1] == "\u0120" if mode == "leading" else t.endswith("</w>"))]
        self.edge = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.edge[edge] = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if mode == "dropped" and not edge:
            self.mode = "whole"
        self.known: dict[str, int] = {}
        self.start, self.length, self.flat, self.used = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32), 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for i in range(0, len(texts), 64):
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[i:i + 64], add_special_tokens=False)]
        return out

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, ids) of words; those whose borders the ids themselves show are encoded many to a text."""
        column = pa.array(words, pa.string())
        if self.mode == "leading":
            # a word starts with its space, and only its first id holds a space
            plain = np.asarray(pc.starts_with(column, " "), bool) & (np.asarray(pc.binary_length(column)) > 1)
            pieces = np.ones(len(words), np.int64)
        else:
            plain = np.asarray(pc.match_substring_regex(column, _PLAIN), bool)
            pieces = np.asarray(pc.count_substring_regex(column, _PRETOKEN), np.int64)
        for x in self.special:
            plain &= ~np.asarray(pc.match_substring(column, x), bool)
        lengths, chunks, order = np.zeros(len(words), np.int64), [], []
        many = np.flatnonzero(plain)
        for i in range(0, len(many), 400):
            part = many[i:i + 400]
            ids = self._ids("".join([words[k] for k in part.tolist()]) if self.mode == "leading" else " ".join([words[k] for k in part.tolist()]))
            mark = np.flatnonzero(self.edge[ids])
            if len(mark) != pieces[part].sum():
                plain[part] = False
                continue
            if self.mode == "leading":
                size = np.diff(np.append(mark, len(ids)))
            else:
                size = np.diff(np.concatenate([[0], mark[np.cumsum(pieces[part]) - 1] + 1]))
            lengths[part] = size
            chunks.append(ids)
            order.append(part)
        rest = np.flatnonzero(~plain)
        for k, ids in zip(rest.tolist(), self.whole([words[k] for k in rest.tolist()])):
            lengths[k] = len(ids)
            chunks.append(ids)
        order = np.concatenate([*order, rest]) if len(words) else rest
        flat = np.concatenate(chunks) if chunks else np.zeros(0, np.uint32)
        # ids stand in encoding order: bring them into the order of the words
        at = np.zeros(len(words), np.int64)
        at[order] = np.concatenate([[0], np.cumsum(lengths[order])])[:-1] if len(words) else 0
        return lengths, flat[_ranges(at, lengths)]

    def _lookup(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, lengths, ids) of the distinct ``words``, from the cache where it has them."""
        known = self.known
        found = np.fromiter(map(known.get, words, itertools.repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        start, length = self.start[found], self.length[found]
        flat = self.flat[:self.used]
        if len(new):
            fresh = [words[i] for i in new.tolist()]
            size, ids = self._fresh(fresh)
            ends = np.cumsum(size)
            n, room = len(known), self.limit - len(known)
            if room >= len(fresh):
                self.flat = _grown(self.flat, self.used + len(ids))
                self.flat[self.used:self.used + len(ids)] = ids
                self.start, self.length = _grown(self.start, n + len(fresh)), _grown(self.length, n + len(fresh))
                self.start[n:n + len(fresh)] = self.used + ends - size
                self.length[n:n + len(fresh)] = size
                known.update(zip(fresh, range(n, n + len(fresh))))
                start[new], length[new] = self.start[n:n + len(fresh)], size
                self.used += len(ids)
                flat = self.flat[:self.used]
            else:
                start[new], length[new] = self.used + ends - size, size
                flat = np.concatenate([flat, ids])
        return start, length, flat

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ``ids[offsets[i]:offsets[i + 1]]``."""
        if self.mode == "whole":
            return _joined(self.whole(text.to_pylist()))
        if self.mode == "dropped":
            offsets, words = split_words(text)
            coded = words.dictionary_encode()
            return self._gather(np.asarray(coded.indices, np.int64), offsets, coded.dictionary.to_pylist())
        parts = pc.split_pattern(text, " ")
        offsets = np.asarray(parts.offsets, dtype=np.int64)
        offsets = offsets - offsets[0]
        coded = parts.flatten().dictionary_encode()
        code, words = np.asarray(coded.indices, np.int64), coded.dictionary
        risky = np.asarray(pc.or_(pc.not_equal(pc.utf8_trim_whitespace(words), words), pc.equal(words, "")), bool)
        words = words.to_pylist()
        spoilt = np.add.reduceat(np.concatenate([risky[code], [False]]).astype(np.int64), offsets[:-1]) > 0 if len(offsets) > 1 else np.zeros(0, bool)
        if not spoilt.any():
            return self._spaced(code, offsets, words)
        good, bad = np.flatnonzero(~spoilt), np.flatnonzero(spoilt)
        o1, i1 = self.encode(text.take(pa.array(good))) if len(good) else (np.zeros(1, np.int64), np.zeros(0, np.uint32))
        rows = [None] * len(spoilt)
        for k, i in enumerate(good.tolist()):
            rows[i] = i1[o1[k]:o1[k + 1]]
        for i, ids in zip(bad.tolist(), self.whole(text.take(pa.array(bad)).to_pylist())):
            rows[i] = ids
        return _joined(rows)

    def _spaced(self, code, offsets, words):
        first = code[offsets[:-1]]
        lead, at = np.unique(first, return_inverse=True)
        index = code.copy()
        index[offsets[:-1]] = len(words) + at
        return self._gather(index, offsets, [" " + w for w in words] + [words[i] for i in lead.tolist()])

    def _gather(self, index, offsets, words):
        start, length, flat = self._lookup(words)
        size = length[index]
        return np.concatenate([[0], np.cumsum(size)])[offsets], flat[_ranges(start[index], size)]


def _grown(x: np.ndarray, need: int) -> np.ndarray:
    return x if len(x) >= need else np.concatenate([x, np.zeros(max(need, len(x) * 3 // 2) - len(x), x.dtype)])


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for ``length[0]`` places, then the same for the next."""
    step = np.repeat(start - (np.cumsum(length) - length), length)
    step += np.arange(len(step))
    return step


def _joined(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)))])
    return offsets, np.concatenate(rows) if rows else np.zeros(0, np.uint32)


_ENCODERS: dict[tuple[str, str], WordEncoder] = {}


def encoder(path: str, mode: str) -> WordEncoder:
    """The worker's encoder of that file, loaded once."""
    if (path, mode) not in _ENCODERS:
        _ENCODERS[path, mode] = WordEncoder(path, mode)
    return _ENCODERS[path, mode]
