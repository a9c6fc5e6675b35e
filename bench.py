"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the local cores, BENCH_RUNS the timed runs
after one warm-up (the median counts). Every result is consumed in full by a write that
keeps nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakerisk.plans.catalog import queries  # noqa: E402
from lakerisk.session import build_session, drop_scratch  # noqa: E402

HEADLINE = [
    "contract_profile", "registry_history", "affiliation_features", "regional_summary", "feature_table",
    "keep_latest", "quality_report", "ingest_split", "split_70_30", "curated_dataset", "global_rank",
    "topk_per_run", "ranking_metrics", "segment_metrics", "gain_lift", "view_audit_ranking",
    "view_regional_panorama", "eda_amounts_by_class", "prep_winsor_log", "model_lr",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
    drop_scratch(spark)
    sf = Path(folder).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
