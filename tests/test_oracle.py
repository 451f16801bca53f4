"""Registered queries against their SQL at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from umbral.plans import load_catalog  # noqa: E402
from verify import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"
CAT = load_catalog()
QUICK = ["dereplicate_exact", "classify_entities", "expand_to_items", "resolve_annotation", "best_tiered_hit", "curated_call", "merge_labels", "directons", "flanks_circular",
         "overlap_islands", "context_rates", "synteny_conservation", "protein_families", "dark_families", "recurrence", "rarity", "cooccurrence", "rarefaction_ranked",
         "top_k_edges", "connected_components", "communities", "network_summary", "minhash_pairs", "representatives", "parse_titles", "parse_headers", "gff3_rows", "fasta_roundtrip",
         "resolve_twins", "consensus", "consensus_label", "reality_lines", "record_class", "record_flag", "stage_status", "set_agreement", "number_elements", "item_report",
         "lineage_min_id", "pairwise_rates", "artefact_flags", "genbank_flatfile"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def check(spark, con, name):
    why, _ = compare(CAT.QUERIES[name](spark, SF), con, CAT.ORACLES[name])
    assert why is None, why


@pytest.mark.parametrize("name", QUICK)
def test_quick(spark, con, name):
    check(spark, con, name)


@pytest.mark.full
@pytest.mark.parametrize("name", sorted(CAT.QUERIES))
def test_every_query(spark, con, name):
    check(spark, con, name)


def test_catalogue_is_consistent():
    assert set(CAT.ORACLES) == set(CAT.QUERIES)
