"""The annotation cascade: which hits exist, what they explain, and the class they add up to."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.functions.predicates import (artefact_reasons, as_evalue, completeness_band, is_domain_named,
                                         is_informative, reasons, significance_gate)
from umbral.operators.coverage import covered_fraction, merged_length
from umbral.session import cut
from umbral.specs import Thresholds, TierSpec


def admit_hits(hits: DataFrame, tiers: Sequence[TierSpec]) -> DataFrame:
    """Rows that pass their tier's floor, with tier_idx, ev, informative and spanned columns.

    All tiers are gated in one pass: the tier list is configuration and becomes two CASEs.
    """
    idx = F.coalesce(*[F.when(F.col("tier") == t.id, F.lit(i)) for i, t in enumerate(tiers)])
    floor = F.coalesce(*[F.when(F.col("tier") == t.id, F.lit(t.max_evalue).cast("double")) for t in tiers],
                       F.lit(None).cast("double"))
    return (hits.withColumn("tier_idx", idx).filter(F.col("tier_idx").isNotNull())
            .filter(significance_gate("evalue", floor))
            .withColumn("ev", as_evalue("evalue"))
            .withColumn("informative", is_informative("label"))
            .withColumn("spanned", F.col("start").isNotNull() & F.col("end").isNotNull()))


def explained(admitted: DataFrame, lengths: DataFrame, key: str = "seq_id", length: str = "qlen") -> DataFrame:
    """Per entity: explained_fraction (informative spans) and dark_covered_fraction (the rest)."""
    spans = admitted.filter("spanned")
    merged = (merged_length(spans, [key, "informative"]).groupBy(key)
              .agg(F.max(F.when(F.col("informative"), F.col("covered"))).alias("_inf"),
                   F.max(F.when(~F.col("informative"), F.col("covered"))).alias("_dark")))
    return (lengths.select(key, length).join(merged, key, "left")
            .select(key, length, covered_fraction("_inf", length).alias("explained_fraction"),
                    covered_fraction("_dark", length).alias("dark_covered_fraction")))


def summarise_hits(admitted: DataFrame, key: str = "seq_id", tie: Sequence[str] = ("label",)) -> DataFrame:
    """One row per entity that has hits, in a single aggregation with partial combine.

    Winner for the label: informative first, then tier order, then E-value, then ``tie``.
    Winner for the strongest: informative first, then E-value, then tier order, then ``tie``.
    A winner is the smallest struct that starts with its order: one value is kept per entity and order.
    """
    inf = F.col("informative")
    t = [F.col(c) for c in tie]
    also = lambda *shown: [F.col(c) for c in shown if c not in tie]
    by_tier = F.struct((~inf).alias("u"), F.col("tier_idx"), F.col("ev"), *t, *also("tier", "label", "coverage", "target_coverage", "evalue"))
    by_ev = F.struct((~inf).alias("u"), F.when(inf, F.col("ev")).otherwise(F.col("tier_idx").cast("double")).alias("a"),
                     F.when(inf, F.col("tier_idx").cast("double")).otherwise(F.col("ev")).alias("b"), *t, *also("tier", "label"))
    rung = (F.when(F.col("label").rlike(X.RUNG_CURATED), 0)
            .when(F.col("label").rlike(X.RUNG_CONSERVED), 1)
            .when(~(F.coalesce(F.col("label"), F.lit("")) == ""), 2).otherwise(3))
    return admitted.groupBy(key).agg(
        F.min(by_tier).alias("_best"), F.min(by_ev).alias("_strong"),
        F.coalesce(F.min(F.when(inf, F.col("tier_idx"))), F.min("tier_idx")).alias("_depth"),
        F.count_if(inf).alias("n_informative_hits"),
        F.count_if(~inf).alias("n_uninformative_hits"),
        F.bool_and(F.when(inf, is_domain_named("label"))).alias("_domain"),
        F.bool_or(inf & ~F.col("spanned")).alias("_family"),
        F.bool_or(~inf & F.col("spanned")).alias("_dark_span"),
        F.bit_count(F.coalesce(F.bit_or(F.when(~inf, F.expr("shiftleft(1L, tier_idx)"))), F.lit(0).cast("long"))).alias("n_dark_databases"),
        F.min(F.when(~inf, rung)).alias("_rung"))


def ordered_distinct_concat(admitted: DataFrame, key: str = "seq_id", order: Sequence[str] = ("tier_idx", "ev", "label")) -> DataFrame:
    """First-seen distinct labels (' | ') and tiers (',') of the informative and the other hits.

    Repeats are removed before anything is collected, so a list is as long as the output (once per tier),
    and both lists come from one pass over the hits.
    """
    first = admitted.groupBy(key, "informative", "label", "tier").agg(F.min(F.struct(*order)).alias("_at"))

    def joined(what, sep, informative):
        rows = F.filter("_seen", lambda x: x["informative"] == F.lit(informative))
        return F.concat_ws(sep, F.array_distinct(F.transform(F.sort_array(F.transform(rows, lambda x: F.struct(x["_at"], x[what].alias(what)))), lambda x: x[what])))

    return first.groupBy(key).agg(F.collect_list(F.struct("informative", "_at", "label", "tier")).alias("_seen")).select(
        key, joined("label", " | ", True).alias("informative_labels"), joined("label", " | ", False).alias("uninformative_labels"),
        joined("tier", ",", True).alias("informative_tiers"), joined("tier", ",", False).alias("uninformative_tiers"))


def classify(hits: DataFrame, lengths: DataFrame, tiers: Sequence[TierSpec], thr: Thresholds = Thresholds(),
             key: str = "seq_id", length: str = "qlen", tie: Sequence[str] = ("label",)) -> DataFrame:
    """Class, labels and coverage of every entity of ``lengths`` over the hits of all tiers.

    FUNCTIONAL: explained enough, or named by a span-less family assignment, unless every name
    is domain-level. DOMAIN_ONLY: named otherwise. UNCHARACTERIZED_HOMOLOG: seen, never named.
    NONE: no hit at all. Spans and winners are two aggregations over the same key; the joins
    that assemble them reuse that partitioning.
    """
    adm = admit_hits(hits, tiers)
    s, cov = summarise_hits(adm, key, tie), explained(adm, lengths, key, length)
    out = cov.join(s, key, "left")
    named, has_hit = F.coalesce("n_informative_hits", F.lit(0)) > 0, F.col("_best").isNotNull()
    domain, family = F.coalesce("_domain", F.lit(False)), F.coalesce("_family", F.lit(False))
    cls = (F.when(~has_hit, "NONE").when(~named, "UNCHARACTERIZED_HOMOLOG")
           .when(((F.col("explained_fraction") >= thr.min_coverage) | family) & ~domain, "FUNCTIONAL")
           .otherwise("DOMAIN_ONLY"))
    measured = ~(family & (F.col("explained_fraction") == 0))
    dark_measured = F.coalesce("_dark_span", F.lit(False)) | (F.coalesce("n_uninformative_hits", F.lit(0)) == 0)
    rung = F.coalesce(F.element_at(F.array(*[F.lit(r) for r in X.RUNGS]), F.col("_rung") + 1), F.lit("NONE"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return out.select(
        key, F.lit("self").alias("annot_source"),
        F.col("_best.tier").alias("annot_tier"), F.col("_best.label").alias("annot_label"),
        cls.alias("functional_class"), (F.col("_depth") + 1).alias("homology_depth"),
        F.col("_best.coverage").alias("annot_qcov"), F.col("_best.target_coverage").alias("annot_tcov"),
        F.col("_best.evalue").alias("annot_evalue"), zero("n_informative_hits").alias("n_informative_hits"),
        F.col("_strong.label").alias("best_evalue_label"), F.col("_strong.tier").alias("best_evalue_tier"),
        domain.cast("int").alias("named_by_domain_only"), "explained_fraction",
        completeness_band("explained_fraction", thr, measured).alias("annot_completeness"),
        "dark_covered_fraction",
        completeness_band("dark_covered_fraction", thr, dark_measured).alias("dark_completeness"),
        rung.alias("dark_evidence"), zero("n_dark_databases").alias("n_dark_databases"),
        *provenance(thr))


def provenance(thr: Thresholds):
    """The thresholds as columns: they travel on every row they governed."""
    return [F.lit(getattr(thr, n)).alias(f"thr_{n}") for n in ("min_coverage", "narrow_at", "full_at", "partial_at")]


def resolve_annotation(own: DataFrame, selection: DataFrame, transferred: DataFrame,
                       thr: Thresholds = Thresholds(), key: str = "seq_id") -> DataFrame:
    """One row per entity from five origins, named in annot_source.

    ``own`` is :func:`classify` with the label lists joined on. ``selection`` holds (key, role,
    search_representative). ``transferred`` holds (key, transfer_class, transfer_label).
    """
    own = cut(own)      # read by the rows of its own and by those that copy from it
    artefacts = selection.filter("role = 'artefact_antifam'").select(key)
    ps = (transferred.filter("transfer_class = 'ANNOTATED'").join(artefacts, key, "left_anti")
          .select(key, F.lit("plasmidscope").alias("annot_source"), F.lit("PS").alias("annot_tier"),
                  F.col("transfer_label").alias("annot_label"), F.lit("FUNCTIONAL").alias("functional_class"),
                  F.lit(1).cast("bigint").alias("n_informative_hits"),
                  F.col("transfer_label").alias("informative_labels"), F.lit("PS").alias("informative_tiers"),
                  F.lit(X.NOT_MEASURED).alias("annot_completeness"), *provenance(thr)))
    members = copy_from_representative(own, selection.filter("role = 'member'"), key)
    unsearched = selection.filter("role IN ('not_selected', 'artefact_antifam')").select(
        key, F.when(F.col("role") == "not_selected", "not_searched").otherwise(F.col("role")).alias("annot_source"),
        F.lit("NOT_SEARCHED").alias("functional_class"), *provenance(thr))
    return (own.withColumn("annot_representative", F.lit(None).cast("string"))
            .unionByName(ps, allowMissingColumns=True).unionByName(members, allowMissingColumns=True)
            .unionByName(unsearched, allowMissingColumns=True))


def copy_from_representative(rows: DataFrame, members: DataFrame, key: str = "seq_id",
                             rep: str = "search_representative") -> DataFrame:
    """Members with their representative's row, the representative named beside it."""
    m = members.select(F.col(key).alias("_member"), F.col(rep).alias(key))
    return (rows.drop("annot_source", "annot_representative").join(m, key)
            .withColumn("annot_representative", F.col(key)).withColumn("annot_source", F.lit("representative"))
            .drop(key).withColumnRenamed("_member", key))


# ---- narrowing and selection --------------------------------------------------------------

def residual(ids: DataFrame, fractions: DataFrame, threshold: float, key: str = "seq_id") -> DataFrame:
    """Ids explained less than ``threshold``; an id without a fraction is explained 0."""
    done = fractions.filter(F.col("explained_fraction") >= threshold)
    return ids.join(done.select(key), key, "left_anti")


def skip_if_named_by(ids: DataFrame, admitted: DataFrame, sources: Sequence[str], key: str = "seq_id") -> DataFrame:
    """Ids that no informative hit of ``sources`` has named."""
    named = admitted.filter(F.col("informative") & F.col("source").isin(*sources))
    return ids.join(named.select(key).distinct(), key, "left_anti")


def open_families(members: DataFrame, family: str = "family_id", skipped: str = "skipped",
                  small: str = "on_small") -> DataFrame:
    """Non-skipped members of the families that hold a non-skipped small member."""
    free = members.filter(~F.col(skipped))
    opened = free.filter(F.col(small)).select(family).distinct()
    return free.join(opened, family, "left_semi")


def assign_role(antifam, transferred, representative, key) -> Column:
    """artefact > transferred > representative > member > not_selected."""
    return (F.when(antifam, "artefact_antifam").when(transferred, "plasmidscope")
            .when(representative == key, "representative")
            .when(representative.isNotNull(), "member").otherwise("not_selected"))


def eligibility(annotation: DataFrame, artefacts: DataFrame, key: str = "seq_id") -> DataFrame:
    """Why an entity is, or is not, part of the dark set. Every entity keeps its row."""
    flagged = artefacts.filter(F.col("artefact_flag") == 1).select(key, F.lit(1).alias("_f")).distinct()
    cls = F.col("functional_class")
    why = reasons(("artefact", F.col("_f").isNotNull()), ("not_searched", cls == "NOT_SEARCHED"),
                  ("annotated", ~cls.isin("NOT_SEARCHED", "UNCHARACTERIZED_HOMOLOG", "NONE")))
    return annotation.join(flagged, key, "left").select(
        key, "functional_class", F.coalesce("_f", F.lit(0)).alias("is_artefact"),
        (F.size(why) == 0).cast("int").alias("target_eligible"),
        F.concat_ws(",", why).alias("exclusion_reason"))


def eligibility_summary(flags: DataFrame) -> DataFrame:
    strict = (F.col("target_eligible") == 1) & (F.col("functional_class") == "NONE")
    return flags.agg(F.count(F.lit(1)).alias("n_entities"), F.sum("is_artefact").alias("n_artefact"),
                     F.sum("target_eligible").alias("n_eligible"), F.count_if(strict).alias("n_no_homologue"))


def dark_set(flags: DataFrame, items: DataFrame, key: str = "seq_id", partial: str = "partial") -> DataFrame:
    """Eligible entities that have at least one complete item (or no item at all)."""
    fragments = items.groupBy(key).agg(F.bool_and(F.col(partial) != 0).alias("_p")).filter("_p").select(key)
    return flags.filter("target_eligible = 1").select(key).join(fragments, key, "left_anti")


def artefact_flags(entities: DataFrame, family_hits: DataFrame, max_fraction: float = 0.5,
                   key: str = "seq_id", masked: str = "low_complexity_fraction", max_evalue: float | None = None) -> DataFrame:
    """Strongest artefact-family hit and masked share per entity, with the reasons; no row is dropped.

    ``max_evalue`` admits hits up to it, where the search itself has not cut its list.
    """
    admitted = family_hits if max_evalue is None else family_hits.filter(as_evalue("evalue") <= max_evalue)
    best = best_hit(admitted, key, ["evalue"], ["family", "evalue"])
    why = artefact_reasons("family", masked, max_fraction)
    return entities.join(best, key, "left").select(
        key, (F.size(why) > 0).cast("int").alias("artefact_flag"), F.col("family").alias("antifam_family"),
        F.col("evalue").alias("antifam_ievalue"), masked, F.concat_ws(",", why).alias("artefact_reason"))


def best_hit(hits: DataFrame, key: str, order: Sequence[str], fields: Sequence[str],
             evalue: str = "evalue") -> DataFrame:
    """Per key the hit with the smallest E-value, then ``order``: a min_by, never a sort."""
    rank = F.struct(as_evalue(evalue).alias("_ev"), *[F.col(o) for o in order if o != evalue],
                    *[F.col(f).alias(f"_t_{f}") for f in fields])
    return hits.groupBy(key).agg(F.min_by(F.struct(*fields), rank).alias("_w")).select(key, "_w.*")


def expand_to_items(items: DataFrame, annotation: DataFrame, flags: DataFrame | None = None,
                    key: str = "seq_id") -> DataFrame:
    """Entity annotation over every item. On a name collision the item's column wins.

    Annotation and flags have one row per entity. They are stacked and folded by key first, one
    aggregation instead of a full join, so the items meet one side in one left join, which can be
    broadcast where the side is small and split where an entity is hot.
    """
    side = annotation.drop(*[c for c in annotation.columns if c in items.columns and c != key])
    if flags is not None:
        flags = flags.drop(*[c for c in flags.columns if c in items.columns + side.columns and c != key])
        stacked = side.unionByName(flags, allowMissingColumns=True).filter(F.col(key).isNotNull())
        side = stacked.groupBy(key).agg(*[F.any_value(F.col(c), True).alias(c) for c in stacked.columns if c != key])
    return items.join(side, key, "left")


def working_subset(entities: DataFrame, named: DataFrame, resolved: DataFrame,
                   representatives: DataFrame | None = None, key: str = "seq_id") -> DataFrame:
    """What an expensive step sees: named but not yet resolved, optionally representatives only."""
    out = entities.join(named.select(key), key, "left_semi").join(resolved.select(key), key, "left_anti")
    return out if representatives is None else out.join(representatives.select(key), key, "left_semi")


def orthology_union(named: DataFrame, transferred: DataFrame, searched: DataFrame | None,
                    fields: Sequence[str], key: str = "seq_id") -> DataFrame:
    """Per named entity: the transferred result if it has one, else the searched one, else its status."""
    t = transferred.select(key, *[F.col(f).alias(f"_t_{f}") for f in fields], F.lit(1).alias("_t"))
    out = named.select(key).distinct().join(t, key, "left")
    if searched is None:
        return out.select(key, *[F.coalesce(f"_t_{f}", F.lit("")).alias(f) for f in fields],
                          F.when(F.col("_t") == 1, "plasmidscope").otherwise("not_run").alias("orthology_source"))
    s = searched.select(key, *[F.col(f).alias(f"_s_{f}") for f in fields], F.lit(1).alias("_s"))
    pick = lambda f: F.when(F.col("_t") == 1, F.col(f"_t_{f}")).otherwise(F.col(f"_s_{f}"))
    return out.join(s, key, "left").select(
        key, *[F.coalesce(pick(f), F.lit("")).alias(f) for f in fields],
        F.when(F.col("_t") == 1, "plasmidscope").when(F.col("_s") == 1, "emapper").otherwise("").alias("orthology_source"))
