"""Graphs as two DataFrames: components, top-k edges, node measures, communities."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.functions.predicates import is_informative
from umbral.session import cut, gather
from umbral.sources.sinks import summary_kv
from umbral.specs import NetworkSpec


#: Edges or nodes that one task of a round works on, about; fewer in all are left to adaptive execution.
TASK_ROWS = 500_000


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "id", a: str = "a", b: str = "b",
                         component: str = "component", max_rounds: int = 60) -> DataFrame:
    """(node, component): the component id is its smallest member; a node without edges is alone.

    Alternates two star steps until the edge set is a fixed point. The large star links the
    larger neighbours of every node to its smallest neighbour, the small star does the same for
    the smaller ones; the number of edges never grows and rounds are logarithmic. Each step is
    a min per node (partial aggregation) and a join whose other side is unique per node, so a
    hub is split by adaptive skew handling. Every round is cut into the checkpoint folder.
    More than ``TASK_ROWS`` edges are dealt by node over as many partitions as they fill before
    each star, so that what a task holds does not grow with the graph.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e, mark = cut(e), None
    big = e.count() > TASK_ROWS
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = gather(both, "u", TASK_ROWS) if big else both
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = (gather(cut(large), "u", TASK_ROWS) if big else large).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v")).filter("u <> v").distinct())
        e = cut(small)
        seen = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    label = e.groupBy("u").agg(F.min("v").alias(component)).withColumnRenamed("u", node)
    names = gather(nodes.select(node), node, TASK_ROWS) if big else nodes.select(node)
    return names.distinct().join(label, node, "left").withColumn(component, F.coalesce(component, node))


def extend_components(comp: DataFrame, edges: DataFrame, node: str = "id", a: str = "a", b: str = "b", component: str = "component") -> DataFrame:
    """``comp`` (node, component) after ``edges`` (a, b) between its nodes came in; ids stay smallest members.

    The edges are read as edges between the component ids of their ends, which leaves as many nodes as
    there are components that move; those are solved and composed with ``comp`` by one join.
    """
    end = lambda side: comp.select(F.col(node).alias(side), F.col(component).alias(f"_{side}"))
    between = cut(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).join(end("x"), "x").join(end("y"), "y")
                  .filter("_x <> _y").select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")).distinct())
    if between.limit(1).count() == 0:
        return comp
    moved = between.select(F.col("a").alias(component)).union(between.select("b")).distinct()
    solved = connected_components(moved, between, node=component, component="_to")
    return cut(comp.join(solved, component, "left").select(node, F.coalesce("_to", component).alias(component)))


def top_k_edges(hits: DataFrame, spec: NetworkSpec = NetworkSpec(), query: str = "query", target: str = "target") -> DataFrame:
    """(source, target, evalue): at most k best targets per query, then one row per undirected edge.

    A hit counts below the E-value cut (strict) and when it covers enough of either side.
    Ranking with a row-number filter lets Spark keep k rows per query before the shuffle.
    """
    ev = F.col("evalue").cast("double")
    ok = hits.filter((F.col(query) != F.col(target)) & (ev < spec.max_evalue)
                     & (F.greatest("qcov", "tcov") >= spec.min_cov)).withColumn("_ev", ev)
    w = Window.partitionBy(query).orderBy("_ev", target)
    kept = ok.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= spec.max_out_edges)
    return kept.groupBy(F.least(query, target).alias("source"), F.greatest(query, target).alias("target")).agg(
        F.min("_ev").alias("evalue"))


def edge_weight(evalue) -> Column:
    e = evalue if isinstance(evalue, Column) else F.col(evalue)
    return F.when(e > 0, -F.log10(e)).otherwise(300.0)


def node_brightness(annotation: DataFrame, members: DataFrame, node: str = "node_id", entity: str = "seq_id") -> DataFrame:
    """(node, brightness): the best explained fraction among measured members, NULL if none."""
    full = (F.col("functional_class") == "FUNCTIONAL") & (F.col("annot_completeness") == "NOT_MEASURED")
    measured = F.coalesce("functional_class", F.lit("NOT_SEARCHED")) != "NOT_SEARCHED"
    bright = F.when(measured, F.when(full, 1.0).otherwise(F.coalesce(F.col("explained_fraction").cast("double"), F.lit(0.0))))
    return members.select(node, entity).join(annotation, entity, "left").groupBy(node).agg(F.max(bright).alias("brightness"))


def communities(nodes: DataFrame, edges: DataFrame, node: str = "node_id", weight: Column | None = None) -> DataFrame:
    """(node, community_id): synchronous weighted label propagation, to its end.

    Every round each node takes the label with the largest summed edge weight among its neighbours,
    ties to the smallest label; a node without edges keeps its own. As edges weigh the same in both
    directions, the labels end at a fixed point or alternate between two states: the rounds stop
    when a state equals the one before the last, and a node's label is the smaller of the two.
    Should the states repeat after a longer cycle, that is detected and raised, never cut short.
    Labels are numbered by (size desc, smallest member).
    """
    w = edge_weight("evalue") if weight is None else weight
    half = edges.select(F.col("source").alias("u"), F.col("target").alias("v"), w.alias("w"))
    adj = cut(half.unionByName(half.select(F.col("v").alias("u"), F.col("u").alias("v"), "w")))
    lab = cut(nodes.select(F.col(node).alias("u"), F.col(node).alias("l"), F.lit(None).cast(nodes.schema[node].dataType).alias("p")).distinct())
    seen: set = set()
    while True:
        vote = adj.join(lab.select(F.col("u").alias("v"), "l"), "v").groupBy("u", "l").agg(F.round(F.sum("w"), 9).alias("s"))
        best = vote.groupBy("u").agg(F.min_by("l", F.struct((-F.col("s")).alias("a"), F.col("l").alias("b"))).alias("n"))
        nxt = cut(lab.join(best, "u", "left").select("u", F.coalesce("n", "l").alias("n"), "l", "p"))
        moved, state = nxt.agg(F.count_if(~F.col("n").eqNullSafe(F.col("p"))), F.sum(F.xxhash64("u", "n", "l").cast("decimal(38,0)"))).first()
        if not moved:
            break
        if state in seen:
            raise RuntimeError("the labels repeat after more than two rounds")
        seen.add(state)
        lab = nxt.select("u", F.col("n").alias("l"), F.col("l").alias("p"))
    lab = nxt.select("u", F.least("n", "l").alias("l"))
    sizes = lab.groupBy("l").agg(F.count(F.lit(1)).alias("s"), F.min("u").alias("m"))
    order = number_globally(sizes, [F.desc("s"), F.asc("m")], "community_id")
    return lab.join(order.select("l", "community_id"), "l").select(F.col("u").alias(node), "community_id")


def number_globally(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Zero-based global position in ``order`` without a one-task window.

    A range sort spreads the rows; each partition then numbers its own and adds the sizes of
    the partitions before it (one row per partition).
    """
    s = cut(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
            .withColumn("_part", F.shiftright("_mid", 33)))
    n = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    inside = F.col("_mid") - F.shiftleft(F.col("_part"), 33)
    return s.join(F.broadcast(n), "_part").withColumn(name, (F.col("_base") + inside).cast("bigint")).drop("_mid", "_part", "_base")


def network_nodes(members: DataFrame, reach: DataFrame, records: DataFrame, annotation: DataFrame, dark: DataFrame,
                  edges: DataFrame, community: DataFrame | None = None, spec: NetworkSpec = NetworkSpec(),
                  node: str = "node_id", entity: str = "seq_id", record: str = "plasmid_id") -> DataFrame:
    """Per node: members, items, records, brightness, dark flag and share, commonest name, degree."""
    m = members.select(node, entity)
    size = (m.join(reach.select(entity, "n_copies"), entity, "left")
            .join(dark.select(entity, F.lit(1).alias("_d")), entity, "left").groupBy(node)
            .agg(F.count(F.lit(1)).alias("n_members"), F.sum(F.coalesce("n_copies", F.lit(0))).alias("n_orfs"),
                 F.round(F.avg(F.coalesce("_d", F.lit(0))), 4).alias("dark_fraction")))
    rec = m.join(records.select(entity, record), entity).select(node, record).distinct().groupBy(node).agg(
        F.count(F.lit(1)).alias("n_plasmids"))
    names = (m.join(annotation.filter(is_informative("annot_label")).select(entity, "annot_label"), entity)
             .groupBy(node, "annot_label").agg(F.count(F.lit(1)).alias("_k")).groupBy(node)
             .agg(F.min_by("annot_label", F.struct((-F.col("_k")).alias("a"), F.col("annot_label").alias("b"))).alias("label")))
    ends = edges.select(F.col("source").alias(node)).unionByName(edges.select(F.col("target").alias(node)))
    degree = ends.groupBy(node).agg(F.count(F.lit(1)).alias("degree"))
    out = (size.join(rec, node, "left").join(node_brightness(annotation, m, node, entity), node, "left")
           .join(names, node, "left").join(degree, node, "left")
           .withColumn("dark", (F.col("brightness") <= spec.dark_brightness).cast("int"))
           .withColumn("brightness", F.round("brightness", 4))
           .withColumns({c: F.coalesce(c, F.lit(0)) for c in ("degree", "n_plasmids")}))
    return out if community is None else out.join(community, node, "left")


def network_summary(nodes: DataFrame, edges: DataFrame, spec: NetworkSpec = NetworkSpec(), node: str = "node_id") -> DataFrame:
    """(metric, value) rows with the parameters beside them; a share of an empty set is NULL, never zero.

    A dark singleton is a node of one member that is dark. With a ``community_id`` column the
    communities of two or more nodes are counted too.
    """
    flag = nodes.select(F.col(node), "dark")
    ends = edges.select(F.col("source").alias("x"), F.col("target").alias("y"))
    adj = ends.unionByName(ends.select(F.col("y").alias("x"), F.col("x").alias("y")))
    touch = adj.join(flag.select(F.col(node).alias("y"), F.col("dark").alias("_yd")), "y").groupBy("x").agg(
        F.max((F.col("_yd") == 0).cast("int")).alias("_bright"))
    n = nodes.join(touch.withColumnRenamed("x", node), node, "left")
    d, linked = F.col("dark") == 1, F.col("degree") > 0
    lone = (F.col("n_members") == 1) & (F.col("dark_fraction") == 1)
    agg = n.agg(F.count(F.lit(1)).alias("nodes"), F.count_if(F.col("dark").isNull()).alias("nodes_not_measured"),
                F.count_if(d).alias("dark_nodes"), F.count_if(d & linked).alias("dark_nodes_connected"),
                F.count_if(d & linked & (F.col("_bright") == 1)).alias("dark_connected_to_bright"),
                F.count_if(lone).alias("dark_family_singletons"),
                F.count_if(lone & linked).alias("dark_family_singletons_with_edge"))
    share = lambda p, q: F.round(F.col(p) / F.nullif(F.col(q), F.lit(0)), 4)
    extra = {"edges": edges.agg(F.count(F.lit(1))).scalar(),
             "share_dark_nodes_connected": share("dark_nodes_connected", "dark_nodes"),
             "share_dark_connected_to_bright": share("dark_connected_to_bright", "dark_nodes_connected"),
             "min_cov_either_protein": F.lit(spec.min_cov), "max_evalue": F.lit(spec.max_evalue),
             "max_out_edges": F.lit(spec.max_out_edges), "dark_brightness": F.lit(spec.dark_brightness)}
    if "community_id" in nodes.columns:
        sizes = nodes.groupBy("community_id").agg(F.count(F.lit(1)).alias("k"))
        extra["communities_2plus"] = sizes.agg(F.count_if(F.col("k") >= 2)).scalar()
    return summary_kv(agg.withColumns(extra))
