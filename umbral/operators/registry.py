"""Record scope, hosts, classes and flags."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from umbral.functions import fixed as X
from umbral.functions.coords import trim_terminal_repeat
from umbral.functions.predicates import absent, is_closed
from umbral.functions.text import first_source_wins
from umbral.operators.selection import medians
from umbral.session import cut


def scope_filter(master: DataFrame, excluded: Sequence[str], small_below: int, habitat: str = "hab_top",
                 size: str = "size_bp", topology: str = "topology") -> DataFrame:
    """Records outside the excluded habitats, with ``small`` and ``circular`` flags."""
    keep = ~F.coalesce(F.col(habitat).isin(*excluded), F.lit(False)) if excluded else F.lit(True)
    return master.filter(keep).withColumns({"small": F.col(size).cast("bigint") < small_below,
                                            "circular": is_closed(topology)})


def ancestor_closure(nodes: DataFrame, target, node: str = "taxid", parent: str = "parent", max_rounds: int = 40) -> DataFrame:
    """(node, under): whether each node is the target or lies below it.

    Pointer doubling: every round a node learns what its current ancestor knows and jumps to
    that ancestor's ancestor, so depth d takes log2(d) equi-joins. A node whose parent is
    missing or itself is a root.
    """
    ids = nodes.select(F.col(node).alias("id"), F.col(parent).alias("up"))
    ids = ids.join(ids.select(F.col("id").alias("up"), F.lit(1).alias("_k")), "up", "left")
    st = ids.select("id", F.when(F.col("_k").isNull() | (F.col("up") == F.col("id")) | (F.col("id") == target), F.lit(None)
                                 ).otherwise(F.col("up")).alias("up"), (F.col("id") == target).alias("under"))
    st = cut(st)
    for _ in range(max_rounds):
        if st.filter("up IS NOT NULL").limit(1).count() == 0:
            return st.select(F.col("id").alias(node), "under")
        nxt = st.join(st.select(F.col("id").alias("up"), F.col("up").alias("_u2"), F.col("under").alias("_a")), "up", "left")
        st = cut(nxt.select("id", F.when(~F.col("_a"), F.col("_u2")).alias("up"), (F.col("under") | F.coalesce("_a", F.lit(False))).alias("under")))
    raise RuntimeError(f"the parent table holds a cycle or a chain deeper than 2^{max_rounds}")


def name_keys(names: DataFrame, node: str = "taxid", name: str = "name", cls: str = "name_class") -> DataFrame:
    """(name, node): each name, and for authority and synonym entries also its first one and two words."""
    words = F.split(name, r"\s+")
    short = F.array(words[0], F.array_join(F.slice(words, 1, 2), " "))
    loose = F.col(cls).rlike("^(authority|synonym)")
    keys = F.array_distinct(F.when(loose, F.concat(F.array(name), short)).otherwise(F.array(name)))
    return names.select(F.explode(keys).alias("name"), F.col(node)).distinct()


def names_under(wanted: DataFrame, names: DataFrame, closure: DataFrame, node: str = "taxid") -> DataFrame:
    """The wanted names that are known and whose every node lies under the target."""
    hit = names.join(wanted.select("name").distinct(), "name", "left_semi").join(closure, node, "left")
    return hit.groupBy("name").agg(F.bool_and(F.coalesce("under", F.lit(False))).alias("_all")).filter("_all").select("name")


def exclude_by_ancestor(records: DataFrame, under: DataFrame, host: str = "host") -> tuple[DataFrame, DataFrame]:
    """(kept, removed counts per host): records whose host is one of the names under the target go."""
    u = under.select(F.col("name").alias(host))
    kept = records.join(u, host, "left_anti")
    removed = records.join(u, host, "left_semi").groupBy(host).agg(F.count(F.lit(1)).alias("n_removed"))
    return kept, removed


def record_registry(master: DataFrame, transfer_hosts: DataFrame, working: DataFrame, record: str = "plasmid_id") -> DataFrame:
    """One row per record: cluster, observed host and its source, predicted range, topology, habitat.

    The organism field of a metagenomic record names its sample, not a host, and is not used.
    """
    org = working.select(record, F.when(F.coalesce("lifestyle", F.lit("")) != "metagenomic", F.col("organism")).alias("_org"))
    j = master.join(transfer_hosts.select(record, F.col("host").alias("_host")), record, "left").join(org, record, "left")
    h = first_source_wins(("plsdb", F.col("plsdb_species")), ("plasmidscope", F.col("_host")), ("organism", F.col("_org")))
    return j.withColumn("_h", h).select(record, absent("mob_cluster", "NA").alias("mob_cluster"), "_h.*",
                                        absent("mob_host_range").alias("predicted_host_range"), "topology", "hab_top")


def trimmed_records(sequences: DataFrame, scope: DataFrame, min_repeat: int = 20, record: str = "plasmid_id", seq: str = "seq") -> DataFrame:
    """In-scope sequences with the terminal repeat of closed records removed, and the lengths."""
    t = trim_terminal_repeat(F.col(seq), F.col("circular"), min_repeat)
    return (sequences.join(scope.select(record, "circular", "small"), record).withColumn("_t", t)
            .select(record, "circular", "small", F.length(seq).alias("record_bp"), F.col("_t.repeat_len").alias("repeat_bp"),
                    (F.length(seq) - F.col("_t.repeat_len")).alias("molecule_bp"), F.col("_t.trimmed").alias("seq")))


def record_class(records: DataFrame, systems: DataFrame, record: str = "plasmid_id", system: str = "system") -> DataFrame:
    """The most complete system type on each record; no system is pMOBless; an unknown type raises."""
    s = F.substring_index(system, "/", -1)
    rank = F.lit(None).cast("int")
    for i, (prefix, _) in reversed(list(enumerate(X.MOBILITY_CLASSES))):
        rank = F.when(s.startswith(prefix), F.lit(i)).otherwise(rank)
    rank = F.coalesce(rank, F.raise_error(F.concat(F.lit("unknown system type "), s)).cast("int"))
    best = systems.groupBy(record).agg(F.min(rank).alias("_r"))
    names = F.array(*[F.lit(c) for _, c in X.MOBILITY_CLASSES])
    return records.select(record).distinct().join(best, record, "left").select(
        record, F.coalesce(F.get(names, F.col("_r")), F.lit(X.NO_MOBILITY)).alias("class"))


def record_flag(records: DataFrame, calls: DataFrame, hallmarks: DataFrame, record: str = "plasmid_id") -> DataFrame:
    """Phage flag: a virus call or at least one hallmark gene. ``calls``: (record, name); ``hallmarks``: (record, n)."""
    c = calls.groupBy(record).agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("genomad_virus"))
    h = hallmarks.groupBy(record).agg(F.sum("n").cast("bigint").alias("n_virus_hallmarks"))
    out = records.select(record).distinct().join(c, record, "left").join(h, record, "left")
    n = F.coalesce("n_virus_hallmarks", F.lit(0))
    return out.select(record, F.coalesce("genomad_virus", F.lit("")).alias("genomad_virus"), n.alias("n_virus_hallmarks"),
                      (F.col("genomad_virus").isNotNull() | (n >= 1)).cast("int").alias("phage_plasmid"))


def propagate_components(component_entities: DataFrame, map_: DataFrame, entity: str = "seq_id") -> DataFrame:
    """Every item whose entity is a component: identical sequences have identical hits."""
    return map_.join(component_entities.select(entity).distinct(), entity, "left_semi")


def candidate_records(component_items: DataFrame, items: DataFrame, record: str = "plasmid_id") -> DataFrame:
    """All items of the records that carry at least one component item."""
    return items.join(component_items.select(record).distinct(), record, "left_semi")


def match_items(ours: DataFrame, theirs: DataFrame, record: str = "plasmid_id", seq: str = "seq_id") -> DataFrame:
    """IDENTICAL (same sequence on the record), SAME_STOP (same strand and stop), else ABSENT."""
    stop = F.when(F.col("strand") == 1, F.col("end")).otherwise(F.col("start"))
    same = theirs.select(record, seq).distinct().withColumn("_i", F.lit(1))
    stops = theirs.select(record, "strand", stop.alias("_stop")).distinct().withColumn("_s", F.lit(1))
    j = ours.withColumn("_stop", stop).join(same, [record, seq], "left").join(stops, [record, "strand", "_stop"], "left")
    return j.withColumn("kind", F.when(F.col("_i") == 1, "IDENTICAL").when(F.col("_s") == 1, "SAME_STOP").otherwise("ABSENT")).drop(
        "_stop", "_i", "_s")


def concordance(ours: DataFrame, theirs: DataFrame, length: str = "length", group: str = "group", record: str = "plasmid_id", seq: str = "seq_id") -> DataFrame:
    """Per (group, kind) our count, share and median length, and the reverse match count of the group."""
    m = cut(match_items(ours, theirs, record, seq).select(F.struct(group, "kind").alias("_g"), length))
    middle = medians(m, "_g", length, "median_length")
    per = m.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).join(middle, "_g", "left").select(f"_g.{group}", "_g.kind", "n", "median_length")
    tot = per.groupBy(group).agg(F.sum("n").alias("n_ours"))
    back = (theirs.join(ours.select(record, seq).distinct().withColumn("_m", F.lit(1)), [record, seq], "left").groupBy(group)
            .agg(F.count(F.lit(1)).alias("n_theirs"), F.count("_m").alias("n_theirs_matched")))
    return per.join(tot, group).join(back, group, "left").withColumn("share", F.round(F.col("n") / F.col("n_ours"), 4))
