"""Co-occurring pairs of entities, tested over independent lineages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.checks import require_all_in
from umbral.functions.stats import hypergeom_sf, step_up
from umbral.session import cut, spread
from umbral.specs import PairSpec

#: Entities per block side; a task joins at most BLOCK x BLOCK candidate pairs of one record set.
BLOCK = 512


def presence(items: DataFrame, lineage_of: DataFrame, record: str = "plasmid_id", entity: str = "seq_id",
             lineage: str = "lineage", check: bool = True) -> DataFrame:
    """Distinct (lineage, record, entity). A record without a lineage raises, it is never guessed."""
    if check:
        require_all_in(items, lineage_of, record, "records carrying an entity")
    d = items.select(record, entity).distinct()
    return d.join(lineage_of.select(record, lineage), record)


def eligible_presence(pres: DataFrame, m: int, record: str = "plasmid_id", entity: str = "seq_id",
                      lineage: str = "lineage") -> tuple[DataFrame, DataFrame]:
    """(counts, presence): lineages per entity, and the presence rows of entities in >= m of them.

    An entity in fewer lineages can be in no pair that reaches m, so it is dropped before any
    pair exists.
    """
    counts = pres.select(entity, lineage).distinct().groupBy(entity).agg(F.count(F.lit(1)).alias("n_lin"))
    return counts, pres.join(counts.filter(F.col("n_lin") >= m).select(entity), entity, "left_semi")


def distinct_content(pres: DataFrame, record: str = "plasmid_id", entity: str = "seq_id",
                     lineage: str = "lineage") -> DataFrame:
    """One record per distinct entity set within each lineage.

    A pair counts once per lineage, so copies with the same content add nothing. The set is
    compared by an order-free fingerprint (two 64-bit sums and the size), which is an algebraic
    aggregate: no set is ever collected.
    """
    h = lambda seed: F.xxhash64(F.lit(seed), F.col(entity)).cast("decimal(38,0)")
    finger = pres.groupBy(lineage, record).agg(F.count(F.lit(1)).alias("_n"), F.sum(h(1)).alias("_a"), F.sum(h(2)).alias("_b"))
    keep = finger.groupBy(lineage, "_n", "_a", "_b").agg(F.min(record).alias(record))
    return pres.join(keep.select(lineage, record, F.col("_n").alias("n_entities")), [lineage, record])


def pair_counts(pres: DataFrame, record: str = "plasmid_id", entity: str = "seq_id", lineage: str = "lineage",
                block: int = BLOCK) -> DataFrame:
    """(a, b, k): lineages in which a < b share a record.

    A record's entities are hashed into blocks and the record's pair triangle into block pairs.
    Each entity travels to the block pairs of its row and column; a key (record, i, j) then
    holds about ``2 * block`` entities however many the record has, so a record with a third of
    all rows is spread over many tasks. Every pair is counted, none is capped.
    """
    src = distinct_content(pres, record, entity, lineage)
    b = F.greatest(F.lit(1), F.ceil(F.col("n_entities") / block)).cast("int")
    mine = F.pmod(F.xxhash64(F.col(entity)), b).cast("int")
    src = src.select(lineage, record, entity, b.alias("_nb"), mine.alias("_m"))
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    placed = (src.withColumn("_o", other)
              .select(lineage, record, entity, "_m", F.least("_m", "_o").alias("_i"), F.greatest("_m", "_o").alias("_j")))
    left = placed.select(lineage, record, "_i", "_j", F.col(entity).alias("seq_a"), F.col("_m").alias("_ma"))
    right = placed.select(lineage, record, "_i", "_j", F.col(entity).alias("seq_b"), F.col("_m").alias("_mb"))
    met = left.join(right, [lineage, record, "_i", "_j"]).filter(
        (F.col("seq_a") < F.col("seq_b"))
        # Off the diagonal only pairs across the two blocks; within a block the diagonal has them.
        & ((F.col("_i") == F.col("_j")) | (F.col("_ma") != F.col("_mb"))))
    once = met.select(lineage, "seq_a", "seq_b").distinct()
    return once.groupBy("seq_a", "seq_b").agg(F.count(F.lit(1)).alias("k"))


def cooccurrence(items: DataFrame, lineage_of: DataFrame, spec: PairSpec = PairSpec(), record: str = "plasmid_id",
                 entity: str = "seq_id", lineage: str = "lineage", check: bool = True) -> DataFrame:
    """Pairs together in at least m lineages, with a hypergeometric p and a step-up q.

    q is corrected over every enumerated pair before the cut on k. The tail is evaluated once
    per distinct (k, K, n), and the correction runs over the distinct p-values only.
    """
    pres = presence(items, lineage_of, record, entity, lineage, check)
    counts, elig = eligible_presence(pres, spec.min_lineages_together, record, entity, lineage)
    total = lineage_of.agg(F.count_distinct(lineage).alias("n_lineages_total"))
    side = lambda s: counts.select(F.col(entity).alias(f"seq_{s}"), F.col("n_lin").alias(f"n_lineages_{s}"))
    pairs = pair_counts(elig, record, entity, lineage).join(side("a"), "seq_a").join(side("b"), "seq_b")
    # The tail is symmetric in K and n.
    key = {"_lo": F.least("n_lineages_a", "n_lineages_b"), "_hi": F.greatest("n_lineages_a", "n_lineages_b")}
    pairs = cut(pairs.withColumns(key))   # written once: the tests and the report both read it
    triples = pairs.groupBy("k", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n_tests")).withColumn(
        "n_lineages_total", total.scalar())
    # few rows with a long sum each: size alone would leave them to one task
    tested = cut(spread(cut(triples)).withColumn("p_value", hypergeom_sf(
        F.col("k"), F.col("n_lineages_total"), F.col("_lo"), F.col("_hi"))))
    graded = step_up(tested).drop("n_tests")
    out = pairs.filter(F.col("k") >= spec.min_lineages_together).join(graded, ["k", "_lo", "_hi"])
    k, K, n, N = F.col("k"), F.col("n_lineages_a"), F.col("n_lineages_b"), F.col("n_lineages_total")
    return out.select(
        "seq_a", "seq_b", "n_lineages_a", "n_lineages_b", k.alias("n_lineages_together"), "n_lineages_total",
        F.round(k / K, 4).alias("fraction_of_a"), F.round(k / n, 4).alias("fraction_of_b"),
        F.round(K * n / N, 4).alias("expected_together"), "p_value", "q_value")


def family_partners(pairs: DataFrame, members: DataFrame, fdr: float = 0.05, entity: str = "seq_id",
                    family: str = "family_id") -> DataFrame:
    """Per family the significant partners and the best partner, significant or not."""
    way = lambda f, p, frac: pairs.select(F.col(f).alias(entity), F.col(p).alias("partner"), F.col(frac).alias("fraction"),
                                          "p_value", "q_value", "n_lineages_together")
    both = way("seq_a", "seq_b", "fraction_of_a").unionByName(way("seq_b", "seq_a", "fraction_of_b"))
    rank = F.struct("q_value", "p_value", (-F.col("n_lineages_together")).alias("_k"), "partner", (-F.col("fraction")).alias("_f"))
    return both.join(members.select(entity, family), entity).groupBy(family).agg(
        F.count_distinct(F.when(F.col("q_value") <= fdr, F.col("partner"))).alias("n_cooccurring_partners"),
        F.min_by(F.struct("partner", "q_value", "fraction"), rank).alias("_w")).select(
        family, "n_cooccurring_partners", F.col("_w.partner").alias("top_cooccurring_partner"),
        F.col("_w.q_value").alias("top_cooccurring_partner_q"), F.col("_w.fraction").alias("top_cooccurring_partner_fraction"))
