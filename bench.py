"""Benchmark: the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and written to a no-op sink, so every column of every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from umbral.plans import load_catalog  # noqa: E402
from umbral.session import local_session  # noqa: E402

HEADLINE = ("dereplicate_exact", "classify_entities", "expand_to_items", "best_tiered_hit", "merge_labels", "directons", "flanks_circular", "overlap_islands",
            "context_rates", "synteny_conservation", "protein_families", "recurrence", "rarity", "cooccurrence", "rarefaction_expected", "top_k_edges",
            "connected_components", "lineage_min_id", "consensus", "gff3_rows", "item_report")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "umbral-bench")
    spark.sparkContext.setLogLevel("ERROR")
    catalog = load_catalog().QUERIES
    catalog["edge_filter"](spark, sf_dir).count()   # start the session before the clock does
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
