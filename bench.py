"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores, BENCH_RUNS the timed runs
per query (the median counts). A query is timed from its first call until every row is produced.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quaymark.session import build_session

OPERATORS = (
    "dq_valid_rows", "dq_null_profile", "dq_duplicate_count", "dq_silver_report", "join_zip_rank", "join_round_robin",
    "join_bucket_lookup", "agg_count_distinct", "agg_rollup_to_parent", "win_item_sequence", "win_keep_latest",
    "sessionize_events", "funnel_repair", "key_dense_surrogate", "key_global_row_number", "win_ntile_scores",
    "fn_text_clean", "fn_strip_diacritics", "fn_pricing", "log_assemble_records", "log_structure_lines",
    "ts_tumbling_agg", "ts_percentiles", "ts_rate_non_negative", "stream_sessions", "stream_tumbling_agg", "run_warehouse",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": False,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from workload import catalog

    names = [n for n in catalog.QUERIES if n.startswith(("gold_", "silver_"))] + list(OPERATORS)
    chosen = sys.argv[1:] or names

    def once(name: str) -> float:
        began = time.perf_counter()
        catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    once("gold_order_performance")  # start the engine before the clock
    seconds = {n: round(statistics.median(once(n) for _ in range(runs)), 3) for n in chosen}
    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
