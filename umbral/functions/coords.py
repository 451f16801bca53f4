"""Linear and circular coordinates. ``start > end`` means ``start..L`` followed by ``1..end``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbral.functions import bind
from umbral.functions.fixed import MAX_OVERLAP_BP


def _c(x) -> Column:
    return x if isinstance(x, Column) else (F.col(x) if isinstance(x, str) else F.lit(x))


def segments(start, end, length) -> Column:
    """One or two plain intervals as an array of (seg_start, seg_end)."""
    s, e, n = _c(start), _c(end), _c(length)
    iv = lambda a, b: F.struct(a.cast("bigint").alias("seg_start"), b.cast("bigint").alias("seg_end"))
    return F.when(s <= e, F.array(iv(s, e))).otherwise(F.array(iv(s, n), iv(F.lit(1), e)))


def is_minus(strand) -> Column:
    return _c(strand).cast("string").isin("-1", "-")


def reverse_complement(seq) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTNacgtn", "TGCANtgcan"))


def extract_segment(seq, start, end, strand, spans=None, min_len: int = 6) -> Column:
    """The bases of a feature on its own strand; NULL when shorter than ``min_len``."""
    s, a, b = _c(seq), _c(start).cast("int"), _c(end).cast("int")
    wraps = _c(spans) if spans is not None else a > b
    plain = F.substring(s, a, F.greatest(F.lit(0), b - a + 1))
    joined = F.concat(F.substring(s, a, F.length(s)), F.substring(s, F.lit(1), b))
    nt = F.when(wraps, joined).otherwise(plain)
    nt = F.when(is_minus(strand), reverse_complement(nt)).otherwise(nt)
    return F.when(F.length(nt) >= min_len, nt)


def extend_circular(seq, max_overlap: int = MAX_OVERLAP_BP) -> Column:
    """The sequence followed by its own first ``min(max_overlap, L)`` characters."""
    return F.concat(_c(seq), F.substring(_c(seq), 1, max_overlap))


def terminal_repeat_length(seq, min_repeat: int = 20) -> Column:
    """Length of the longest exact repeat shared by both ends, at most half the record, or 0.

    Splitting the text at the seed (zero-width look-ahead, so overlapping sites all count)
    yields every place where the first ``min_repeat`` characters recur; the running total of
    the piece lengths is where each site starts. The earliest site in the second half that
    runs through to the end is the longest repeat. Only real recurrences of the seed are
    compared in full, so the cost follows the number of sites, not the square of the length.
    """
    return bind(_c(seq), lambda s: _repeat_of(s, min_repeat))


def _repeat_of(s: Column, min_repeat: int) -> Column:
    n = F.length(s)
    half = n - F.floor(n / 2)
    seed = F.substring(s, 1, min_repeat)
    # Records are letter sequences; quoting keeps any other character literal.
    pieces = F.split(s, F.concat(F.lit(r"(?=\Q"), seed, F.lit(r"\E)")))
    start = F.struct(F.lit(0).cast("int").alias("at"), F.lit(0).cast("int").alias("found"))

    def step(acc, piece):
        at = acc["at"] + F.length(piece)
        late = (acc["found"] == 0) & (at >= half) & (at < n)
        runs_through = F.substring(s, at + 1, n) == F.substring(s, F.lit(1), n - at)
        return F.struct(at.alias("at"), F.when(late & runs_through, n - at).otherwise(acc["found"]).alias("found"))

    return F.when(n < 2 * min_repeat, 0).otherwise(F.aggregate(pieces, start, step)["found"]).cast("int")


def trim_terminal_repeat(seq, circular, min_repeat: int = 20) -> Column:
    """Struct of (trimmed, repeat_len): one copy of the repeat dropped from closed records."""
    s = _c(seq)
    k = F.when(_c(circular), terminal_repeat_length(F.upper(s), min_repeat)).otherwise(F.lit(0))
    return F.struct(F.substring(s, F.lit(1), F.length(s) - k).alias("trimmed"), k.alias("repeat_len"))
