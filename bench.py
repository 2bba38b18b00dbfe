"""Times headline queries and prints one JSON line. BENCH_SF_DIR and BENCH_CPUS select data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

from fieldlens.plans.catalog import REGISTRY
from fieldlens.session import local_session

HEADLINE = (
    "duty_cycle_bins", "hotspot_regions", "candidate_penalties", "static_quarantine", "geometry_quarantine", "frame_nms", "frame_classes", "loss_windows", "surviving_candidates_and_losses",
    "tracklet_metrics", "linked_tracklets", "gap_evidence", "dense_track", "window_repairs", "override_merge", "interval_overlaps", "asof_later_on_tie", "point_components",
    "crowd_clusters", "flow_direction", "action_zone", "mode_timeline", "dense_resample", "class_comparison", "static_clusters", "frame_strata",
    "media_eligibility", "upserted_ledger", "completeness_gate", "detection_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before timing
    took = {}
    for name in names:
        t = time.perf_counter()
        # a full run of the plan; rows are thrown away on the executors
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - t, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
