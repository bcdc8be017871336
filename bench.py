"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from cutlight import registry
from cutlight.session import session

HEADLINE = [
    "flagship_event_decisions", "j01_shot_cue_overlap", "j02_shot_segments", "g02_adjacent_continuity", "g04_bounded_groups", "a06_event_rollup", "p02_event_scores", "w01_overlapping_chunks",
    "w09_latest_record", "p03_policy_v1", "g14_scarcity", "l08_stage_state", "x01_stream_latest_state", "g16_capacity_batches", "g05_rescued_groups", "p07_catalog_replay", "g10_editorial_beats", "g13_consolidation_report",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "8g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        began = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
