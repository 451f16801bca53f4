"""Aligned families: consensus, codon projection and summaries of pairwise rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.functions.predicates import is_informative
from umbral.operators.selection import medians


def family_consensus(aligned: DataFrame, family: str = "family_id", seq: str = "aligned",
                     max_gap_fraction: float = 0.5) -> DataFrame:
    """(family, consensus): the commonest residue per kept column, ties to the smaller letter.

    A column is kept when its residues exceed the gap share (strictly). Gaps ('-', '.') are
    dropped before the shuffle and residues are counted per (family, column, letter) map-side;
    only one letter per column is collected. Unequal lengths in a family raise.
    """
    shape = aligned.groupBy(family).agg(F.count(F.lit(1)).alias("_n"), F.min(F.length(seq)).alias("_lo"),
                                        F.max(F.length(seq)).alias("_hi"))
    shape = shape.withColumn("_n", F.when(F.col("_lo") == F.col("_hi"), F.col("_n")).otherwise(
        F.raise_error(F.lit("aligned sequences differ in length")).cast("bigint")))
    cells = (aligned.select(family, F.posexplode(F.split(F.upper(seq), "")).alias("_i", "_r"))
             .filter(~F.col("_r").isin("-", ".", "")))
    counts = cells.groupBy(family, "_i", "_r").agg(F.count(F.lit(1)).alias("_k"))
    col = counts.groupBy(family, "_i").agg(F.sum("_k").alias("_res"), F.min_by(
        "_r", F.struct((-F.col("_k")).alias("a"), F.col("_r").alias("b"))).alias("_best"))
    kept = col.join(shape, family).filter(F.col("_res") > F.col("_n") * max_gap_fraction)
    text = F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("_i", "_best"))), lambda x: x["_best"]))
    out = kept.groupBy(family).agg(text.alias("consensus"))
    return shape.select(family, F.col("_n").alias("n_aligned")).join(out, family, "left").withColumn(
        "consensus", F.coalesce("consensus", F.lit("")))


def project_gaps(aligned, source, width: int = 3, gap: str = "-") -> Column:
    """The source text cut into ``width``-letter units laid under the aligned text.

    Each gap becomes ``width`` gaps, each residue the next unit. A source too short for the
    residues raises.
    """
    a, s = F.col(aligned) if isinstance(aligned, str) else aligned, F.col(source) if isinstance(source, str) else source
    residues = F.length(F.replace(a, F.lit(gap), F.lit("")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    # Unit i of the source belongs to the i-th residue: number the residues by a running count.
    walked = F.aggregate(
        F.split(a, ""), start,
        lambda acc, ch: F.struct(
            F.when(ch == gap, acc["at"]).otherwise(acc["at"] + 1).alias("at"),
            F.concat(acc["out"], F.array(F.when(ch == gap, F.lit(gap * width)).otherwise(
                F.substring(s, acc["at"] * width + 1, F.lit(width))))).alias("out")),
        lambda acc: F.concat_ws("", acc["out"]))
    short = F.raise_error(F.concat(F.lit("source of "), F.length(s).cast("string"), F.lit(" letters is too short for "),
                                   residues.cast("string"), F.lit(" residues"))).cast("string")
    return F.when(F.length(s) < residues * width, short).otherwise(walked)


def pairwise_rate_summary(families: DataFrame, pairs: DataFrame, family: str = "family_id", min_codons: int = 20,
                          min_members: int = 3, purifying_max: float = 0.5) -> DataFrame:
    """Per family the median and minimum rate, or the status that says why there is none.

    ``families``: (family, n_usable, alignment_failed, rate_failed, n_codons). ``pairs``:
    (family, omega); NaN has no value.
    """
    valued = pairs.filter(~F.isnan("omega") & F.col("omega").isNotNull())
    rates = valued.groupBy(family).agg(F.count(F.lit(1)).alias("_n"), F.min("omega").alias("_min"))
    f = families.join(rates, family, "left").join(medians(valued, family, "omega", "_med"), family, "left")
    status = (
        F.when(F.col("n_usable") < min_members, "TOO_FEW_MEMBERS").when(F.col("alignment_failed"), "ALIGNMENT_FAILED")
        .when(F.col("rate_failed"), "YN00_FAILED").when(F.col("n_codons") < min_codons, "TOO_SHORT")
        .when(F.col("_n").isNull(), "NO_ESTIMATE").otherwise("MEASURED"))
    got = status == "MEASURED"
    med = F.round("_med", 4)
    return f.select(family, F.when(got, F.col("_n")).otherwise(F.lit(0)).alias("n_pairs"),
                    F.when(got, med).alias("dnds_median"), F.when(got, F.round("_min", 4)).alias("dnds_min"),
                    F.when(got, (med < purifying_max).cast("int")).alias("under_purifying_selection"),
                    status.alias("dnds_status"))


def scoped_rate_summary(families: DataFrame, pairs: DataFrame, family: str = "family_id", scope: str = "member_set",
                        **cuts) -> DataFrame:
    """Both member sets in one pass: the scope is part of the key, then widened with ``small_``."""
    key = F.struct(family, scope)
    out = pairwise_rate_summary(families.withColumn("_k", key), pairs.withColumn("_k", key), "_k", **cuts)
    out = out.select(F.col(f"_k.{family}").alias(family), F.col(f"_k.{scope}").alias(scope), *out.columns[1:])
    vals = [c for c in out.columns if c not in (family, scope)]
    return (out.filter(F.col(scope) == "all").drop(scope)
            .join(out.filter(F.col(scope) == "small").select(family, *[F.col(c).alias(f"small_{c}") for c in vals]), family, "left"))


def consensus_label(families: DataFrame, tested: DataFrame, hits: DataFrame, family: str = "family_id") -> DataFrame:
    """Every family keeps a row; an untested one is NOT_RUN with no verdict on novelty."""
    from umbral.operators.classify import best_hit
    best = best_hit(hits, family, ["label"], ["label", "evalue"])
    ran = F.col("_t").isNotNull()
    return (families.select(family).join(tested.select(family, F.lit(1).alias("_t")).distinct(), family, "left")
            .join(best, family, "left")
            .select(family, F.when(ran, X.SUCCESS).otherwise(X.NOT_RUN).alias("consensus_status"),
                    F.when(ran, (F.coalesce("label", F.lit("")) != "").cast("int")).alias("consensus_hit"),
                    F.when(ran, F.coalesce("label", F.lit(""))).alias("consensus_label"),
                    F.when(ran, F.col("evalue")).alias("consensus_ievalue"),
                    F.when(ran, (~is_informative("label")).cast("int")).alias("collectively_novel")))
