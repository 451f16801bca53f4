"""The evidence reports: one row per item and one per family, nothing scored or ranked."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.checks import ContractError
from umbral.functions import fixed as X
from umbral.functions.predicates import blank, reasons
from umbral.specs import EvidenceLine, RealityThresholds

#: The four lines of evidence that a family is real. A user adds one by adding an entry.
REALITY_LINES = (
    EvidenceLine("purifying_selection", lambda t: (F.col("dnds_status") == "MEASURED") & (
        F.col("dnds_median").cast("double") < t.purifying_max)),
    EvidenceLine("multi_lineage", lambda t: F.coalesce("independent_plasmid_cluster_count", F.lit(0)) >= t.min_lineages),
    EvidenceLine("is_family", lambda t: F.coalesce("n_members", F.lit(0)) >= t.min_members, implied_by=("purifying_selection",)),
    EvidenceLine("folds", lambda t: ~blank("structural_match")),
)


def reality_lines(rows: DataFrame, thr: RealityThresholds = RealityThresholds(),
                  lines: Sequence[EvidenceLine] = REALITY_LINES) -> DataFrame:
    """Rows with the fired lines, those implied by another fired line set apart, and the darkness state."""
    fired = reasons(*[(l.name, F.coalesce(l.test(thr), F.lit(False))) for l in lines])
    out = rows.withColumn("_fired", fired)
    implied = reasons(*[(l.name, F.array_contains("_fired", l.name)
                         & F.arrays_overlap("_fired", F.array(*[F.lit(n) for n in l.implied_by])))
                        for l in lines if l.implied_by])
    out = out.withColumn("_implied", implied).withColumn("_own", F.array_except("_fired", "_implied"))
    text = lambda c: F.when(F.size(c) > 0, F.concat_ws("+", c)).otherwise("none")
    return (out.withColumn("reality_n", F.size("_own")).withColumn("reality_lines", text("_own"))
            .withColumn("reality_lines_implied", text("_implied"))
            .withColumn("darkness_state", F.when(blank("structural_match"), "DARK_NO_STRUCTURE").otherwise("DARK_FOLD_KNOWN"))
            .drop("_fired", "_implied", "_own"))


def evidence_dimensions(rows: DataFrame) -> DataFrame:
    """Which of the eight dimensions were measured. A measured zero is a measurement."""
    yes = lambda c: F.coalesce(F.col(c).cast("double") != 0, F.lit(False))
    told = lambda c: ~blank(F.col(c).cast("string"))
    context = lambda c: told(c) & (F.col(c) != X.TOO_FEW_LINEAGES)
    tests = (yes("artefact_screened"), yes("cascade_searched"), yes("eggnog_searched"),
             told("cons_annotated_neighbour") | context("synteny_status") | context("cooccurrence_status"),
             told("dnds_status") | told("rnacode_status"),
             F.coalesce(F.col("independent_cluster_status") == X.SUCCESS, F.lit(False)),
             yes("structure_searched"), yes("representative_length_aa"))
    present = reasons(*zip(X.DIMENSIONS, tests))
    return rows.withColumns({
        "evidence_dimensions_present": F.concat_ws(",", present), "evidence_dimension_count": F.size(present),
        "supporting_observations_count": F.coalesce("n_informative_hits", F.lit(0)),
        "supporting_observations_are_not_independent": F.lit(1)})


def measured_inputs(members: DataFrame, screened: DataFrame, annotation: DataFrame, orthology: DataFrame,
                    lengths: DataFrame, family: str = "family_id", entity: str = "seq_id", rep: str = "representative") -> DataFrame:
    """Per family: was any member screened, searched, in orthology; informative hits; representative length."""
    mark = lambda df, name: df.select(entity).distinct().withColumn(name, F.lit(1))
    searched = annotation.filter(~F.coalesce("functional_class", F.lit("")).isin("", "NOT_SEARCHED"))
    j = (members.join(mark(screened, "_s"), entity, "left").join(mark(orthology, "_o"), entity, "left")
         .join(searched.select(entity, F.coalesce("n_informative_hits", F.lit(0)).alias("_h")), entity, "left"))
    flag = lambda c: F.max(F.col(c).isNotNull().cast("int"))
    agg = j.groupBy(family, rep).agg(flag("_s").alias("artefact_screened"), flag("_h").alias("cascade_searched"),
                                     flag("_o").alias("eggnog_searched"), F.coalesce(F.sum("_h"), F.lit(0)).alias("n_informative_hits"))
    return agg.join(lengths.select(F.col(entity).alias(rep), F.col("length").alias("representative_length_aa")), rep, "left").drop(rep)


def guard_columns(catalogue: Sequence[str], *tables: DataFrame, prefix: str = "small_", ignore: Sequence[str] = ()) -> None:
    """Every measurement a table writes under ``prefix`` must be carried by the report."""
    for t in tables:
        lost = [c for c in t.columns if c.startswith(prefix) and c not in catalogue and c not in ignore]
        if lost:
            raise ContractError(f"the report does not carry {lost}")


def star_join(base: DataFrame, sides: Mapping[str, tuple[DataFrame, Sequence[str], Mapping[str, str]]], key: str) -> DataFrame:
    """Left joins of ``sides`` on ``key``, each with an explicit column list and renames.

    A column that would land twice under one name raises: the last one merged would win
    silently. Sides are unique per key, so every join keeps the row count.
    """
    out, have = base, set(base.columns)
    for name, (df, cols, rename) in sides.items():
        target = [rename.get(c, c) for c in cols]
        clash = have & set(target)
        if clash:
            raise ContractError(f"{name} would overwrite {sorted(clash)}")
        out = out.join(df.select(key, *[F.col(c).alias(t) for c, t in zip(cols, target)]), key, "left")
        have |= set(target)
    return out


def family_report(families: DataFrame, sides: Mapping[str, tuple[DataFrame, Sequence[str], Mapping[str, str]]],
                  cooccurrence_fdr: float = 0.05, cooccurrence_min_lineages: int = 2,
                  thr: RealityThresholds = RealityThresholds(), key: str = "family_id",
                  catalogue: Sequence[str] | None = None) -> DataFrame:
    """One row per family with every measurement side by side.

    The reality lines and the dimensions are computed from the assembled row, so they describe
    exactly what a reader sees. Evidence columns that no side supplies are NULL. With a ``catalogue``
    of columns no side may write a ``small_`` measurement that the report does not carry.
    """
    if catalogue:
        guard_columns(catalogue, *[df.select(*[F.col(c).alias(rename.get(c, c)) for c in df.columns]) for df, _, rename in sides.values()])
    out = star_join(families, sides, key)
    needed = {"dnds_status": "string", "dnds_median": "double", "rnacode_status": "string", "structural_match": "string",
              "independent_plasmid_cluster_count": "bigint", "independent_cluster_status": "string",
              "synteny_status": "string", "cons_annotated_neighbour": "double", "n_informative_hits": "bigint",
              "artefact_screened": "int", "cascade_searched": "int", "eggnog_searched": "int", "structure_searched": "int",
              "representative_length_aa": "bigint", "n_cooccurring_partners": "bigint"}
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in out.columns})
    status = F.when(F.col("n_cooccurring_partners").isNull(), X.TOO_FEW_LINEAGES).otherwise(X.SUCCESS)
    out = out.withColumn("cooccurrence_status", status).withColumns({
        "n_cooccurring_partners": F.coalesce("n_cooccurring_partners", F.lit(0)),
        "cooccurrence_fdr": F.lit(cooccurrence_fdr), "cooccurrence_min_lineages": F.lit(cooccurrence_min_lineages)})
    out = evidence_dimensions(reality_lines(out, thr))
    return out.select(*catalogue) if catalogue else out


def item_report(items: DataFrame, sides: Sequence[tuple[str, DataFrame]], carried: DataFrame, family_key: str = "family_id") -> DataFrame:
    """One row per item: ordered left joins of pre-aggregated sides, then the carried family columns.

    ``sides`` are (key, table) pairs. Any column that an earlier table already has raises.
    """
    out = items
    for k, df in [*sides, (family_key, carried)]:
        clash = (set(df.columns) - {k}) & set(out.columns)
        if clash:
            raise ContractError(f"joining on {k} would overwrite {sorted(clash)}")
        out = out.join(df, k, "left")
    return out
