"""Families: composition, distribution over independent units, and descriptive labels."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.functions.predicates import blank, reasons
from umbral.operators.graph import number_globally
from umbral.session import cut
from umbral.specs import RaritySpec


def entity_reach(items: DataFrame, small: Column, entity: str = "seq_id", record: str = "plasmid_id") -> DataFrame:
    """Per entity: copies, and whether it sits on small and on large records."""
    return items.groupBy(entity).agg(F.count(F.lit(1)).alias("n_copies"), F.bool_or(small).alias("on_small"),
                                     F.bool_or(~small).alias("on_large"))


def protein_families(members: DataFrame, reach: DataFrame, annotation: DataFrame, dark: DataFrame,
                     resolution: str = "resolution", rep: str = "representative", entity: str = "seq_id",
                     cls: str = "functional_class") -> DataFrame:
    """Composition of every family that holds a small member.

    Entity facts are joined before grouping, so the family pass is one algebraic aggregation
    whatever the family's size. Four counts partition the members: dark, annotated, excluded
    (searched, unnamed, not dark) and not searched.
    """
    k = F.coalesce(cls, F.lit("NOT_SEARCHED"))
    named = ~k.isin("NOT_SEARCHED", "UNCHARACTERIZED_HOMOLOG", "NONE")
    m = (members.join(reach, entity, "left").join(annotation.select(entity, cls), entity, "left")
         .join(dark.select(entity, F.lit(True).alias("_dark")), entity, "left")
         .withColumns({"_dark": F.coalesce("_dark", F.lit(False)), "on_small": F.coalesce("on_small", F.lit(False)),
                       "on_large": F.coalesce("on_large", F.lit(False)), "_named": named,
                       "_out": k == "NOT_SEARCHED"}))
    n = lambda c: F.count_if(c)
    s, l, d, nm = (F.col(c) for c in ("on_small", "on_large", "_dark", "_named"))
    agg = m.groupBy(resolution, rep).agg(
        F.count(F.lit(1)).alias("family_size"), F.sum(F.coalesce("n_copies", F.lit(0))).alias("n_orfs"),
        n(d).alias("dark_member_count"), n(nm).alias("annotated_member_count"), n(F.col("_out")).alias("n_not_searched"),
        n(s).alias("n_small_members"), n(l).alias("n_large_members"), n(s & d).alias("n_small_dark"),
        n(nm & s).alias("_ns"), n(nm & l).alias("_nl")).filter("n_small_members > 0")
    size, ann, dk = F.col("family_size"), F.col("annotated_member_count"), F.col("dark_member_count")
    scope = F.concat(F.when(F.col("n_large_members") > 0, "mixed").otherwise("small_only"),
                     F.when(ann > 0, "_known").otherwise("_unknown"))
    known = (F.when((F.col("_ns") > 0) & (F.col("_nl") > 0), "both").when(F.col("_ns") > 0, "small")
             .when(F.col("_nl") > 0, "large").otherwise(""))
    return agg.select(
        F.concat_ws(":", resolution, F.col(rep).cast("string")).alias("family_id"),
        F.col(resolution).alias("family_resolution"), F.col(rep).alias("representative"), "family_size", "n_orfs",
        "dark_member_count", "annotated_member_count",
        (size - dk - ann - F.col("n_not_searched")).alias("n_unnamed_excluded"),
        F.round(100.0 * dk / size, 2).alias("percentage_dark_in_family"),
        F.when(size == 1, "ORPHAN").otherwise("FAMILY").alias("family_class"),
        ((ann == 0) & (dk > 0)).cast("int").alias("dark_only"), "n_small_members", "n_large_members",
        "n_small_dark", "n_not_searched", scope.alias("scope"), known.alias("known_from"))


def dark_families(families: DataFrame, members: DataFrame, reach: DataFrame, dark: DataFrame, items: DataFrame,
                  mob: DataFrame, primary: str, resolution: str = "resolution", rep: str = "representative",
                  entity: str = "seq_id", record: str = "plasmid_id", cluster: str = "mob_cluster") -> DataFrame:
    """Families of the primary resolution with a dark small member.

    The representative is kept when it is dark and small, else the smallest such member stands
    in. Records and record clusters are counted over all members.
    """
    fam = families.filter((F.col("family_resolution") == primary) & (F.col("n_small_dark") > 0))
    mem = members.filter(F.col(resolution) == primary).select(F.col(rep).alias("representative"), entity)
    facts = (mem.join(dark.select(entity), entity, "left_semi").join(reach.select(entity, "on_small"), entity, "left")
             .filter("on_small"))
    stand_in = facts.groupBy("representative").agg(
        F.max(F.when(F.col(entity) == F.col("representative"), F.col(entity))).alias("_self"),
        F.min(entity).alias("_first"))
    on = (mem.join(items.select(entity, record), entity).select("representative", record).distinct()
          .join(mob.select(record, cluster), record, "left"))
    wide = on.groupBy("representative").agg(F.count(F.lit(1)).alias("n_plasmids"),
                                            F.count_distinct(F.when(~blank(F.col(cluster).cast("string")), F.col(cluster))).alias("n_mob_clusters"))
    return (fam.join(stand_in, "representative").join(wide, "representative", "left")
            .withColumn("representative", F.coalesce("_self", "_first")).drop("_self", "_first"))


def dark_members(dark_fams: DataFrame, members: DataFrame, reach: DataFrame, dark: DataFrame, primary: str,
                 resolution: str = "resolution", rep: str = "representative", entity: str = "seq_id") -> DataFrame:
    """(family_id, entity, on_small): the dark members of the dark families, one row each.

    Later stages measure these members only. They stay rows: a list per family would gather an
    unbounded group, and a sink can join them where a file format asks for it.
    """
    mem = members.filter(F.col(resolution) == primary).select(
        F.concat_ws(":", resolution, F.col(rep).cast("string")).alias("family_id"), entity)
    return (mem.join(dark_fams.select("family_id"), "family_id", "left_semi").join(dark.select(entity), entity, "left_semi")
            .join(reach.select(entity, F.col("on_small").cast("int").alias("on_small")), entity)
            .select("family_id", entity, "on_small"))


def family_records(members: DataFrame, items: DataFrame, family: str = "family_id", entity: str = "seq_id",
                   record: str = "plasmid_id") -> DataFrame:
    """(family, record, n_copies): the pre-aggregated input of every distribution count."""
    return items.groupBy(entity, record).agg(F.count(F.lit(1)).alias("_c")).join(
        members.select(family, entity), entity).groupBy(family, record).agg(F.sum("_c").alias("n_copies"))


#: Rows of a group whose distinct values are gathered as they are; a larger group counts in bitmaps.
GATHER = 4096


def distinct_counts(rows: DataFrame, key: str, values: dict[str, str], gather: int = GATHER) -> DataFrame:
    """(key, one column per entry): how many distinct values other than NULL each column of ``values`` (column: name) has in a group.

    No row is repeated per column. A group of at most ``gather`` rows holds its values in sets, which
    that bounds. In a larger group every value has a number, and a group's numbers are bits: a bitmap
    of 4 KB per 32,768 numbers, built where the rows lie and combined by OR, so a group that
    holds a third of all rows sends a few bitmaps per task and no task sees its rows.
    """
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > gather).select(key)
    large = cut(size)
    few = rows.join(large, key, "left_anti").groupBy(key).agg(*[F.size(F.collect_set(F.col(c))).cast("bigint").alias(a) for c, a in values.items()])
    if large.limit(1).count() == 0:
        return few
    many = rows.join(large, key, "left_semi").select(key, F.explode(F.array(*[
        F.struct(F.lit(a).alias("d"), F.col(c).cast("string").alias("v")) for c, a in values.items()])).alias("x")).select(key, "x.*").filter("v IS NOT NULL")
    names = number_globally(many.select("d", "v").distinct(), [F.asc("d"), F.asc("v")], "i")
    bits = (many.join(names, ["d", "v"]).groupBy(key, "d", F.bitmap_bucket_number("i").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("i")).alias("m")))
    count = lambda a: F.coalesce(F.sum(F.when(F.col("d") == a, F.bitmap_count("m"))), F.lit(0)).cast("bigint").alias(a)
    # a group without any value has no bitmap and still a row
    counted = large.join(bits, key, "left").groupBy(key).agg(*[count(a) for a in values.values()])
    return few.unionByName(counted)


def recurrence(members: DataFrame, items: DataFrame, registry: DataFrame, lineage: DataFrame, sources: DataFrame,
               family: str = "family_id", entity: str = "seq_id", record: str = "plasmid_id", gather: int = GATHER) -> DataFrame:
    """Separate distribution counts per family; record counts are never read as independence.

    ``registry``: (record, species, genus, predicted_host_range, mob_cluster, hab_top).
    ``lineage``: (record, lineage). ``sources``: (record, source), exploded.
    """
    fr = cut(family_records(members, items, family, entity, record))
    val = lambda c: F.when(~blank(F.col(c).cast("string")), F.col(c)).alias(c)
    facts = ("lineage", "species", "genus", "predicted_host_range", "mob_cluster", "hab_top")
    r = cut(fr.join(registry, record, "left").join(lineage.select(record, "lineage"), record, "left").select(family, "n_copies", *[val(c) for c in facts]))
    agg = r.groupBy(family).agg(
        F.sum("n_copies").alias("plasmid_occurrence_count"), F.count(F.lit(1)).alias("unique_plasmid_count"),
        F.count("genus").alias("n_plasmids_with_host"), F.count("species").alias("n_plasmids_with_species"),
        F.count("predicted_host_range").alias("n_plasmids_with_predicted_range"))
    # the list of ranges is part of the answer: distinct pairs first, so that it is gathered from the answer alone
    ranges = (r.filter("predicted_host_range IS NOT NULL").select(family, "predicted_host_range").distinct().groupBy(family)
              .agg(F.array_join(F.sort_array(F.collect_list("predicted_host_range")), ";").alias("predicted_host_ranges")))
    counts = distinct_counts(r, family, {"lineage": "independent_plasmid_cluster_count", "species": "host_count", "genus": "genus_count",
                                         "predicted_host_range": "predicted_host_range_count", "mob_cluster": "MOB_count", "hab_top": "habitat_count"}, gather)
    src = (fr.join(sources.select(record, "source").distinct(), record).select(family, "source").distinct().groupBy(family)
           .agg(F.count(F.lit(1)).alias("database_source_count")))
    fam = members.select(family).distinct()
    out = fam.join(agg, family, "left").join(counts, family, "left").join(ranges, family, "left").join(src, family, "left")
    zero = [x for x in out.columns if x not in (family, "predicted_host_ranges")]
    out = out.withColumns({x: F.coalesce(x, F.lit(0)) for x in zero})
    return out.withColumn("predicted_host_ranges", F.coalesce("predicted_host_ranges", F.lit(""))).withColumn(
        "independent_cluster_status", F.when(F.col("independent_plasmid_cluster_count") > 0, X.SUCCESS).otherwise(X.NOT_RUN)
    ).withColumn("host_count_status", F.when(F.col("n_plasmids_with_host") > 0, X.SUCCESS).otherwise(X.NOT_MEASURED))


def redundancy_ratio(rec: DataFrame, family: str = "family_id") -> DataFrame:
    """The family whose record count overstates its lineages the most."""
    ratio = F.col("unique_plasmid_count") / F.col("independent_plasmid_cluster_count")
    m = rec.filter("independent_plasmid_cluster_count > 0").withColumn("_r", ratio)
    return m.agg(F.min_by(F.struct(family, F.round("_r", 4).alias("ratio")),
                          F.struct((-F.col("_r")).alias("a"), F.col(family).alias("b"))).alias("_w")).select("_w.*")


def nearest_rank_percentile(counts: DataFrame, value: str, percentile: float, group: str) -> DataFrame:
    """(group, threshold): nearest-rank percentile of the values above 0.

    Values are collapsed to (value, how many) first; the cumulative count then runs over the
    distinct values of a group, which lineage counts keep few.
    """
    hist = counts.filter(F.col(value) > 0).groupBy(group, value).agg(F.count(F.lit(1)).alias("_k"))
    w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("_c", F.sum("_k").over(w)).withColumn("_n", F.sum("_k").over(Window.partitionBy(group)))
    return cum.filter(F.col("_c") >= F.ceil(F.col("_n") * percentile / 100.0)).groupBy(group).agg(F.min(value).alias("threshold"))


def rarity(rec: DataFrame, spec: RaritySpec = RaritySpec(), resolution: str = "family_resolution",
           family: str = "family_id") -> DataFrame:
    """Descriptive breadth labels; several may apply and none is a rank."""
    thr = nearest_rank_percentile(rec, "independent_plasmid_cluster_count", spec.widespread_percentile, resolution)
    r = rec.join(F.broadcast(thr), resolution, "left")   # one row per resolution
    lin, mob, host = F.col("independent_plasmid_cluster_count"), F.col("MOB_count"), F.col("host_count")
    why = reasons(
        ("RARE", (lin > 0) & (lin <= spec.rare_max_lineages)), ("LINEAGE_SPECIFIC", lin == 1),
        ("WIDESPREAD", (lin > 0) & (lin >= F.col("threshold"))), ("SINGLE_MOB", mob == 1), ("CROSS_MOB", mob >= 2),
        ("SINGLE_HOST", (host == 1) & (F.col("n_plasmids_with_species") == F.col("unique_plasmid_count"))),
        ("CROSS_HOST", host >= spec.cross_min_hosts), ("CROSS_TAXON", F.col("genus_count") >= spec.cross_min_genera))
    return r.select(family, resolution, F.concat_ws(",", why).alias("rarity_labels"), lin, "unique_plasmid_count",
                    mob, host, "genus_count", "n_plasmids_with_species",
                    F.lit(spec.rare_max_lineages).alias("rare_max_lineages"),
                    F.lit(spec.widespread_percentile).alias("widespread_percentile"),
                    F.col("threshold").alias("widespread_min_lineages"))


def rarity_counts(labels: DataFrame) -> DataFrame:
    each = F.when(F.col("rarity_labels") == "", F.array(F.lit("(none)"))).otherwise(F.split("rarity_labels", ","))
    return labels.select(F.explode(each).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
