"""Steps that several reports share are taken once, and neighbours are not joined again."""

import os

import pytest
from pyspark.sql import functions as F

from umbral.operators import classify as C
from umbral.operators import context as K
from umbral.operators import graph as G
from umbral.operators import neighbours as N
from umbral.operators import synteny as S
from umbral.plans import load_catalog
from umbral.plans.bindings import hits
from umbral.plans.catalog import Tables
from umbral.session import gather, spread
from umbral.specs import ContextSpec, TierSpec

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_item_evidence_takes_flanks_units_and_synteny_once(spark, monkeypatch):
    calls = {}
    for mod, name in ((S, "scoped_conservation"), (N, "directons"), (N, "flanks"), (N, "interval_overlap_join")):
        real = getattr(mod, name)
        monkeypatch.setattr(mod, name, lambda *a, _r=real, _n=name, **k: (calls.__setitem__(_n, calls.get(_n, 0) + 1), _r(*a, **k))[1])
    load_catalog().QUERIES["item_evidence"](spark, SF)
    assert calls == {"scoped_conservation": 1, "directons": 1, "flanks": 1, "interval_overlap_join": 1}


ITEMS = [("r", "a", 1, 50, 1, "FUNCTIONAL", "f1"), ("r", "b", 60, 90, 1, "NONE", "f2"), ("r", "c", 5000, 5050, -1, None, "f1"), ("q", "z", 1, 9, 1, "NONE", "f3")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "plasmid_id string, orf_id string, start bigint, end bigint, strand int, functional_class string, family_id string").withColumns(
        {"circular": F.col("plasmid_id") == "r", "length": F.lit(6000).cast("bigint")})


def test_units_count_conditions(items):
    o = N.ordinals(items, "plasmid_id", ("start", "end"))
    got = {r.orf_id: (r.unit, r.unit_size, r.n) for tile in (1, 100) for r in
           N.directons(o, 100, F.col("circular"), F.col("length"), tile_rows=tile, counted={"n": F.col("functional_class") == "FUNCTIONAL"}).collect()}
    assert got == {"a": (0, 2, 1), "b": (0, 2, 1), "c": (2, 1, 0), "z": (0, 1, 0)}


def test_terms_travel_with_the_neighbours(spark, items, rows):
    terms = spark.createDataFrame([("a", "amr:x", "label"), ("c", "defence:y", "system"), ("c", "amr:x", "label"), ("c", "defence:y", "label")], "orf_id string, term string, how string")
    got = K.item_context(items, F.col("circular"), F.col("length"), ContextSpec(max_gap=100, window=3), terms=terms, family="family_id")
    flat = got.select("orf_id", F.inline("term_sources"))
    # a and b share a unit; c is a neighbour on both sides of the small circle and is told once
    assert rows(flat, "orf_id", "term", "source", "source_family") == [
        ("a", "defence:y", "c", "f1"), ("b", "amr:x", "a", "f1"), ("b", "defence:y", "c", "f1"), ("c", "defence:y", None, None)]
    plan = flat._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 4


def test_scopes_are_counted_in_one_pass(spark):
    schema = "family_id string, lineage string, operon boolean, left array<string>, right array<string>, small boolean"
    occ = [("f", "L1", True, ["x"], ["y"], True), ("f", "L1", None, ["x"], ["y"], False), ("f", "L2", False, ["x"], ["z"], True),
           ("f", "L2", False, ["w"], ["z"], False), ("f", "L3", None, [], [], True), ("g", "L1", True, [], [], False)]
    got = {r.family_id: r.asDict() for r in S.scoped_conservation(spark.createDataFrame(occ, schema), F.col("small"), group=["family_id"]).collect()}
    f, g = got["f"], got["g"]
    assert (f["n_occurrences"], f["context_recurrence"], f["n_lineages"], f["n_lineages_discordant"]) == (5, 4, 2, 1)
    assert (f["lineage_left_conservation"], f["modal_left"], f["lineage_operon_like_conservation"]) == (0.75, "x", 0.5)
    assert (f["small_n_occurrences"], f["small_context_recurrence"], f["small_n_lineages_discordant"], f["small_lineage_left_conservation"], f["small_modal_synteny"]) == (3, 2, 0, 1.0, "x|y")
    assert (g["status"], g["small_status"], g["small_n_occurrences"], g["small_modal_left"]) == ("NO_CONTEXT", "NO_CONTEXT", 0, None)


def test_spread_bounds_the_rows_of_a_task(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    assert max(r["count"] for r in spread(t, 10).groupBy(F.spark_partition_id()).count().collect()) <= 20
    assert spread(t).select(F.spark_partition_id()).distinct().count() <= spark.sparkContext.defaultParallelism


def test_gather_deals_a_key_to_one_partition_and_a_large_one_to_many(spark):
    t = spark.range(20000).select(F.when(F.col("id") < 8000, 7).when(F.col("id") < 8100, None).otherwise(F.col("id") % 400 + 10).alias("k"), "id")
    g = gather(t, "k", 1000).withColumn("p", F.spark_partition_id())
    parts = {r.k: (r.p, r.n) for r in g.groupBy("k").agg(F.countDistinct("p").alias("p"), F.count(F.lit(1)).alias("n")).collect()}
    assert sum(n for _, n in parts.values()) == 20000 and parts[7][1] == 8000 and parts[None][1] == 100
    assert parts[7][0] > 3 and all(p == 1 for k, (p, _) in parts.items() if k not in (7, None))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
def test_hits_are_shuffled_once_for_the_work_of_an_entity(spark):
    adm = C.admit_hits(hits(Tables(spark, SF)), (TierSpec("T1", "pfam", None), TierSpec("T2", "swissprot", 5e-6)))
    for df in (C.summarise_hits(adm), C.ordered_distinct_concat(adm)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_components_of_a_large_graph_are_dealt_by_node(spark, rows, monkeypatch):
    ids, dealt = list(range(60)), []
    edges = [(i, i + 1) for i in range(19)] + [(59, i) for i in range(30, 59)] + [(25, i) for i in range(21, 25)] * 2
    want = [(i, 0 if i < 20 else 30 if i >= 30 else 21 if 21 <= i <= 25 else i) for i in ids]
    monkeypatch.setattr(G, "TASK_ROWS", 8)
    monkeypatch.setattr(G, "gather", lambda df, key, n: (dealt.append(key), gather(df, key, n))[1])
    got = G.connected_components(spark.createDataFrame([(i,) for i in ids], "id int"), spark.createDataFrame(edges, "a int, b int"))
    assert rows(got, "id", "component") == want
    assert set(dealt) == {"u", "id"}
