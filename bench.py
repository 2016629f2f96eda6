"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS: data folder and local cores. BENCH_RUNS: timed runs after a
warm-up (median is reported). BENCH_QUERIES: comma-separated names, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_number", "parse_date", "map_codes", "clean_dedupe", "engineered_features", "pseudonym", "payload_json",
    "enrich_left", "scores_with_groups", "latest_per_key", "latest_ids", "purge_survivors", "risk_ranks",
    "ranked_page", "top_k_coverage", "score_history", "history_trend", "dup_count", "missing_rates", "corr_matrix",
    "class_density", "threshold_curve", "prf", "roc_auc", "avg_precision", "reg_metrics", "fairness_audit",
    "monitored_periods", "programme_stats", "group_privacy_stats", "histogram_fixed", "psi_report",
    "retrain_decision", "promotion_gate", "job_gate", "rate_limit_hits", "sliding_counts", "lockouts", "error_ratio",
    "latency_p95", "pending_alerts", "silence_gaps", "stratified_split", "class_weights", "explain_linear",
    "top_factors", "shap_linear",
]


def main() -> None:
    from riskloom.queries import REGISTRY
    from riskloom.session import get_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": cpus,
           "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        seen = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
            seen.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seen[1:]), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
