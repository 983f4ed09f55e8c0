"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sluice.plans.catalogue import QUERIES  # noqa: E402
from sluice.session import local_session  # noqa: E402

HEADLINE = (
    "csv_scan_infer", "csv_scan_multiline", "save_overwrite_roundtrip", "funnel_join_chain",
    "funnel_join_heavy_keys", "join_size", "drop_duplicates", "duplicate_audit",
    "column_profile", "column_profile_estimated", "target_encode", "rformula_encode",
    "string_index", "split_three_way", "threshold_sweep", "funnel_effectiveness",
    "lr_train_score", "rf_train_score", "gbt_train_score", "param_search",
    "score_leads_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    # Start-up and class loading are not what is measured.
    QUERIES["funnel_effectiveness"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The no-op sink computes every row and keeps none.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{seconds[name]:8.2f}s {name}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
