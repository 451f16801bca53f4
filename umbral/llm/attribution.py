"""Token counts per section by offsets: documents are encoded once, whole, and tokens are mapped to sections.

Tokens of a byte-level vocabulary tile the bytes of a text, so their spans are running sums of their
byte lengths. Sections tile the text as well; here a section is a line with its line break. The
interval join of the two lists is a merge by position. A token that crosses a border is allocated by
an explicit rule: ``start`` gives it to the section of its first byte, ``majority`` to the section that
holds most of its bytes, the earlier one if two hold as many. Either way every token counts once, so the
counts of a document's sections add up to its length in tokens.

Defined cases: a null or empty text has one section, 0, of no characters and no tokens; a text that
ends in a line break has no further empty section; repeated rows each have their own result; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from umbral.llm.common import doc_frame, slices
from umbral.llm.wordcache import encoder

RULES = ("start", "majority")


@dataclass(frozen=True)
class CountSpec:
    tokenizer: str
    mode: str = "leading"
    rule: str = "majority"

    def __post_init__(self):
        if self.rule not in RULES:
            raise ValueError(f"rule must be one of {RULES}")


def token_bytes(enc) -> np.ndarray:
    """Bytes of text behind every id of a byte-level vocabulary: one per character of its printed form."""
    special = enc.tokenizer.get_added_tokens_decoder()
    size = np.zeros(len(enc.edge), np.int64)
    for token, i in enc.tokenizer.get_vocab().items():
        size[i] = len(special[i].content.encode()) if i in special else len(token)
    return size


def allocate(start: np.ndarray, end: np.ndarray, border: np.ndarray, rule: str) -> np.ndarray:
    """The section of every token; section i spans ``border[i] : border[i + 1]`` of one running text."""
    own = np.searchsorted(border, start, side="right") - 1
    if rule == "start":
        return own
    cross = np.flatnonzero(end > border[own + 1])
    for t in cross.tolist():
        s = np.arange(own[t], np.searchsorted(border, end[t], side="left"))
        held = np.minimum(border[s + 1], end[t]) - np.maximum(border[s], start[t])
        own[t] = s[int(np.argmax(held))]
    return own


def section_counts(docs: DataFrame, spec: CountSpec) -> DataFrame:
    """(doc_id, section, start, end, n_tokens): per line its number from 0, its code points and its tokens."""
    frame = doc_frame(docs)

    def run(batches):
        enc = encoder(spec.tokenizer, spec.mode)
        size = token_bytes(enc)
        for batch in slices(batches):
            text = batch.column("text")
            offsets, ids = enc.encode(text)
            length = size[ids]
            stop = np.cumsum(length)
            parts = pc.split_pattern(text, "\n")
            edge = np.asarray(parts.offsets, np.int64)
            edge = edge - edge[0]
            line, n = parts.flatten(), np.diff(edge)
            row = np.repeat(np.arange(len(n)), n)
            last = np.zeros(len(line), bool)
            last[edge[1:] - 1] = True
            bytes_, chars = (np.asarray(f(line), np.int64) + ~last for f in (pc.binary_length, pc.utf8_length))
            keep = (bytes_ > 0) | (np.arange(len(line)) == edge[:-1][row])
            row, bytes_, chars = row[keep], bytes_[keep], chars[keep]
            border = np.concatenate([[0], np.cumsum(bytes_)])
            text_bytes = np.bincount(row, weights=bytes_, minlength=len(n)).astype(np.int64)
            if not (np.diff(np.concatenate([[0], stop])[offsets]) == text_bytes).all():
                raise ValueError("tokens do not tile the text: the vocabulary is not byte-level")
            # empty sections hold no byte and no token: leave them out of the search
            some = np.flatnonzero(bytes_ > 0)
            own = some[allocate(stop - length, stop, np.append(border[:-1][some], border[-1]), spec.rule)] if len(ids) else np.zeros(0, np.int64)
            first = np.searchsorted(row, np.arange(len(n)))
            run_ = np.cumsum(chars) - chars
            start = run_ - run_[first][row]
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row)), pa.array(np.arange(len(row)) - first[row], pa.int32()), pa.array(start),
                                   pa.array(start + chars), pa.array(np.bincount(own, minlength=len(row)).astype(np.int64))],
                                  names=["doc_id", "section", "start", "end", "n_tokens"])

    kind = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {kind}, section int, start long, end long, n_tokens long")
