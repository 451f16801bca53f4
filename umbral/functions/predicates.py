"""Predicates and bands over single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.specs import Thresholds


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def blank(c) -> Column:
    """True for NULL and for whitespace only."""
    return ~F.coalesce(_col(c).rlike(r"\S"), F.lit(False))


def is_informative(label) -> Column:
    """Whether a label names a function; a blank label never does."""
    return F.when(blank(label), False).otherwise(~_col(label).rlike(X.UNINFORMATIVE))


def is_domain_named(label) -> Column:
    return F.coalesce(_col(label).rlike(X.DOMAIN_NAMED), F.lit(False))


def as_evalue(e) -> Column:
    """A comparable E-value; what cannot be parsed sorts last."""
    return F.coalesce(_col(e).cast("string").try_cast("double"), F.lit(float("inf")))


def significance_gate(e, floor) -> Column:
    """Inclusive floor. No floor admits everything; with one, an unparsable value fails.

    ``floor`` is a number, None, or a Column (NULL for "no floor") so that one pass can gate
    the hits of all tiers at once.
    """
    if floor is None:
        return F.lit(True)
    limit = floor if isinstance(floor, Column) else F.lit(float(floor))
    parsed = _col(e).cast("string").try_cast("double")
    return limit.isNull() | F.coalesce(parsed <= limit, F.lit(False))


def is_closed(topology) -> Column:
    return F.coalesce(F.lower(F.trim(_col(topology))).isin(*X.CIRCULAR_TOPOLOGIES), F.lit(False))


def completeness_band(fraction, thr: Thresholds = Thresholds(), measured=None) -> Column:
    f = _col(fraction)
    band = (F.when(f >= thr.full_at, "FULL").when(f >= thr.partial_at, "PARTIAL")
            .when(f > 0, "FRAGMENT").otherwise("NONE"))
    return band if measured is None else F.when(_col(measured), band).otherwise(X.NOT_MEASURED)


def reasons(*pairs: tuple[str, Column]) -> Column:
    """Array of the names whose condition holds, in the given order."""
    return F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in pairs]),
                    lambda x: x.isNotNull())


def artefact_reasons(family, masked_fraction, max_fraction: float = 0.5) -> Column:
    return reasons(("antifam", ~blank(family)),
                   ("low_complexity", F.coalesce(_col(masked_fraction), F.lit(0.0)) > max_fraction))


def soft_masked_fraction(seq) -> Column:
    """Share of lower-case letters, four decimals; NULL for an empty sequence."""
    s = _col(seq)
    kept = F.length(F.regexp_replace(s, r"[^\p{Ll}]", ""))
    return F.round(kept / F.nullif(F.length(s), F.lit(0)), 4)


def status_of(ran, found) -> Column:
    """NOT_RUN / NO_HIT / SUCCESS companion of a nullable value."""
    return (F.when(~_col(ran), X.NOT_RUN).when(~_col(found), X.NO_HIT).otherwise(X.SUCCESS))


def absent(c, *sentinels: str) -> Column:
    """Trimmed text, with blanks and the given sentinels read as NULL."""
    t = F.trim(_col(c))
    return F.when((t == "") | t.isin(*sentinels) if sentinels else (t == ""), F.lit(None)).otherwise(t)
