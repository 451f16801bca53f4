"""Conservation of the arrangement around a family, voted over lineages."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.operators import context as K
from umbral.operators import neighbours as N
from umbral.session import cut
from umbral.specs import ContextSpec

MEASURES = ("left", "right", "neighborhood", "synteny")


def lineage_modal_vote(votes: DataFrame, group: Sequence[str], lineage: str = "lineage", value: str = "value",
                       min_lineages: int = 2, empty: str = "") -> DataFrame:
    """(group, conservation, modal, n_voting): each lineage has one vote, split over its values.

    Counts come first, so a group or lineage holding a third of all rows shuffles its distinct
    values, not its rows. Fractions inside a lineage are exact counts over one divisor; sums
    are compared at twelve decimals, equal sums go to the smallest value.
    """
    g = list(group)
    named = votes.filter(F.col(value).isNotNull() & (F.col(value) != empty))
    counts = cut(named.groupBy(*g, lineage, value).agg(F.count(F.lit(1)).alias("_k")))
    totals = counts.groupBy(*g, lineage).agg(F.sum("_k").alias("_t"))
    score = (counts.join(totals, [*g, lineage]).withColumn("_s", F.col("_k") / F.col("_t"))
             .groupBy(*g, value).agg(F.round(F.sum("_s"), 12).alias("_score")))
    voting = totals.groupBy(*g).agg(F.count(F.lit(1)).alias("n_voting"))
    best = score.groupBy(*g).agg(F.min_by(F.struct(F.col(value).alias("modal"), F.col("_score").alias("top")),
                                          F.struct((-F.col("_score")).alias("a"), F.col(value).alias("b"))).alias("_w"))
    ok = F.col("n_voting") >= min_lineages
    return best.join(voting, g).select(
        *g, F.when(ok, F.round(F.col("_w.top") / F.col("n_voting"), 4)).alias("conservation"),
        F.when(ok, F.col("_w.modal")).alias("modal"), "n_voting")


def occurrences(items: DataFrame, circular: Column, length: Column, spec: ContextSpec, levels: Sequence[str],
                record: str = "plasmid_id", item: str = "orf_id", cls: str = "functional_class",
                strand: str = "strand", lineage: str = "lineage", order=("start", "end"), keep=(), around: DataFrame | None = None) -> DataFrame:
    """One row per (item, level): strand-relative neighbour names and the operon flag.

    Neighbours are found once; naming them at every cluster level is a projection, because
    each level's cluster id travels in the neighbour payload. ``around`` is their
    :func:`umbral.operators.context.surroundings` with the levels as fields, where known.
    """
    if around is None:
        around = K.surroundings(items, circular, length, spec, record, item, cls, order, [F.col(c) for c in levels])
    base = N.strand_relative(around, F.col(strand) == -1).withColumn("operon", F.col("_nf") - (F.col(cls) == "FUNCTIONAL").cast("int") > 0)
    name = lambda side, c: F.transform(side, lambda x: F.coalesce(x[c].cast("string"), F.lit("")))
    level = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("family_id"),
                                         name("left", c).alias("left"), name("right", c).alias("right"))
                                for c in levels]))
    return base.select(record, item, lineage, "operon", *keep, level.alias("_x")).select(
        record, item, lineage, "operon", *keep, "_x.*")


def conservation(occ: DataFrame, group: Sequence[str] = ("level", "family_id"), lineage: str = "lineage",
                 min_lineages: int = 2) -> DataFrame:
    """Left, right, neighbourhood, ordered-pair and operon conservation with their statuses."""
    return _measured(occ, group, lineage, min_lineages, {"": F.lit(True)})


def scoped_conservation(occ: DataFrame, small: Column, lineage: str = "lineage", min_lineages: int = 2,
                        group: Sequence[str] = ("level", "family_id")) -> DataFrame:
    """:func:`conservation` over all occurrences and, with a ``small_`` prefix, over the small ones.

    A scope is one more count in the same rows, so both are measured in one pass.
    """
    return _measured(occ, group, lineage, min_lineages, {"": F.lit(True), "small_": F.coalesce(small, F.lit(False))})


def _measured(occ: DataFrame, group: Sequence[str], lineage: str, min_lineages: int, scopes: dict[str, Column]) -> DataFrame:
    """The measures of :func:`conservation` for every scope (prefix: which occurrences).

    Equal arrangements of a lineage are counted first, so a group or lineage that holds a third of all rows
    shuffles its arrangements. One row per lineage then holds the divisors of all four votes, and the
    votes are summed by value. Whether a lineage has two pairs is told by the ends of two 64-bit fingerprints.
    """
    g = list(group)
    head = lambda c: F.coalesce(F.try_element_at(F.col(c), F.lit(1)), F.lit(""))
    around = F.array_join(F.sort_array(F.array_distinct(F.filter(F.concat("left", "right"), lambda x: x != ""))), ",")
    told = F.col("operon").cast("int")
    rows = occ.select(*g, lineage, ((F.size("left") > 0) | (F.size("right") > 0)).alias("_u"), head("left").alias("_l"), head("right").alias("_r"),
                      around.alias("_n"), told.alias("_o"), *[f.alias(f"_is{s}") for s, f in scopes.items()])
    per = []
    for s in scopes:
        per += [F.count_if(f"_is{s}").alias(f"_k{s}"), F.sum(F.when(F.col(f"_is{s}"), F.col("_o"))).alias(f"_o{s}"),
                F.count_if(F.col(f"_is{s}") & F.col("_o").isNotNull()).alias(f"_c{s}")]
    rows = cut(rows.groupBy(*g, lineage, "_u", "_l", "_r", "_n").agg(*per))   # read for the lineages and for the votes
    l, r = F.col("_l"), F.col("_r")
    has_pair = (l != "") | (r != "")
    value = {"left": l, "right": r, "neighborhood": F.col("_n"), "synteny": F.when(has_pair, F.concat_ws("|", l, r)).otherwise("")}
    has = {"left": l != "", "right": r != "", "neighborhood": F.col("_n") != "", "synteny": has_pair}
    by_lineage = []
    for s in scopes:
        k, u = F.col(f"_k{s}"), F.col("_u")
        seen = u & has_pair & (k > 0)
        apart = lambda i: F.min(F.when(seen, F.xxhash64(F.lit(i), l, r))) != F.max(F.when(seen, F.xxhash64(F.lit(i), l, r)))
        by_lineage += [F.sum(k).alias(f"_all{s}"), F.sum(F.when(u, k).otherwise(0)).alias(f"_used{s}"),
                       (F.sum(F.when(u, F.col(f"_o{s}"))) / F.nullif(F.sum(F.when(u, F.col(f"_c{s}"))), F.lit(0))).alias(f"_op{s}"),
                       F.coalesce(apart(1) | apart(2), F.lit(False)).alias(f"_mixed{s}"),
                       *[F.sum(F.when(u & has[m], k).otherwise(0)).alias(f"_t_{m}{s}") for m in MEASURES]]
    lineages = cut(rows.groupBy(*g, lineage).agg(*by_lineage))
    facts = []
    for s in scopes:
        facts += [F.sum(f"_all{s}").alias(f"{s}n_occurrences"), F.sum(f"_used{s}").alias(f"{s}context_recurrence"),
                  F.count_if(F.col(f"_used{s}") > 0).alias(f"{s}n_lineages"), F.count_if(f"_mixed{s}").alias(f"{s}n_lineages_discordant"),
                  F.round(F.avg(f"_op{s}"), 4).alias(f"_op{s}"), *[F.count_if(F.col(f"_t_{m}{s}") > 0).alias(f"_nv_{m}{s}") for m in MEASURES]]
    facts = lineages.groupBy(*g).agg(*facts)
    share = lambda m, s: F.when(F.col(f"_k{s}") > 0, F.col(f"_k{s}") / F.col(f"_t_{m}{s}")).alias(f"_s{s}")
    votes = (rows.filter("_u").join(lineages.select(*g, lineage, *[f"_t_{m}{s}" for m in MEASURES for s in scopes]), [*g, lineage])
             .select(*g, F.inline(F.filter(F.array(*[F.when(has[m], F.struct(F.lit(m).alias("measure"), value[m].alias("value"), *[share(m, s) for s in scopes]))
                                                     for m in MEASURES]), lambda x: x.isNotNull()))))
    scored = votes.groupBy(*g, "measure", "value").agg(*[F.round(F.sum(f"_s{s}"), 12).alias(f"_s{s}") for s in scopes])
    rank = lambda s: F.when(F.col(f"_s{s}").isNotNull(), F.struct((-F.col(f"_s{s}")).alias("a"), F.col("value").alias("b")))
    best = scored.groupBy(*g, "measure").agg(*[F.min_by(F.struct("value", F.col(f"_s{s}").alias("top")), rank(s)).alias(f"_w{s}") for s in scopes])
    wide = best.groupBy(*g).agg(*[F.max(F.when(F.col("measure") == m, F.col(f"_w{s}"))).alias(f"_w_{m}{s}") for m in MEASURES for s in scopes])
    out = facts.join(wide, g, "left")
    cols = []
    for s in scopes:
        status = (F.when(F.col(f"{s}context_recurrence") == 0, X.NO_CONTEXT)
                  .when(F.col(f"{s}n_lineages") < min_lineages, X.TOO_FEW_LINEAGES).otherwise(X.SUCCESS))
        voted = lambda m, c, status=status, s=s: F.when((status == X.SUCCESS) & (F.col(f"_nv_{m}{s}") >= min_lineages), c)
        top = lambda m, s=s: F.round(F.col(f"_w_{m}{s}.top") / F.col(f"_nv_{m}{s}"), 4)
        cols += [f"{s}n_occurrences", f"{s}context_recurrence", f"{s}n_lineages", f"{s}n_lineages_discordant",
                 *[voted(m, top(m)).alias(f"{s}lineage_{m}_conservation") for m in MEASURES],
                 F.when(status == X.SUCCESS, F.col(f"_op{s}")).alias(f"{s}lineage_operon_like_conservation"),
                 *[voted(m, F.col(f"_w_{m}{s}.value")).alias(f"{s}modal_{m}") for m in ("left", "right", "synteny")], status.alias(f"{s}status")]
    return out.select(*g, *cols)


def families_per_cluster(members: DataFrame, cluster: str, family: str) -> DataFrame:
    """Which families the members of each finer cluster belong to (the levels are not nested)."""
    return members.select(cluster, family).distinct().groupBy(cluster).agg(
        F.array_join(F.sort_array(F.collect_set(F.col(family).cast("string"))), ",").alias("intermediate_family_ids"))
