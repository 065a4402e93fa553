"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated subset; ``all`` for every registered query
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import pipeline  # noqa: E402
from ledgerlens.session import local_session, new_path  # noqa: E402
from ledgerlens.sources import csv, tables  # noqa: E402
from ledgerlens.sources.bindings import bank_raw, retail_raw  # noqa: E402
from ledgerlens.streaming import ingest  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# Timed three times after a warm-up run; the median counts.
HEADLINE = [
    "clean_retail",
    "dedupe_rows",
    "rfm",
    "retail_summary",
    "global_rank",
    "rank_in_group",
    "customer_360",
    "gold_master",
    "quantiles",
    "rfm_histogram",
    "dq_report",
    "label_share",
    "auc",
    "report_top_jobs",
    "report_credit_by_education",
    "sink_partitioned",
    "stream_append",
    "kmeans_segments",
]
# Training runs once.
TRAINING = ["lr_grid", "rf_predict", "gbt_predict"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def full_pipeline(spark, feeds: tuple[str, str]) -> None:
    """CSV feeds to layers, segments, three tuned models, reports and a drained stream."""
    from ledgerlens.operators.stats import group_shares, overview, rfm_histogram, top_groups
    from ledgerlens.plans import reports

    retail_dir, bank_dir = feeds
    store = tables.Warehouse(spark, new_path(spark, "warehouse"))
    pipeline.build_layers(store, csv.read_retail(spark, retail_dir), csv.read_bank(spark, bank_dir))
    silver, gold, segments = store.load("silver"), store.load("gold"), store.load("segments")
    for report in (
        overview(silver),
        group_shares(silver, "y"),
        top_groups(silver, "job"),
        rfm_histogram(segments),
        reports.top_jobs_by_balance(gold),
        reports.credit_risk_by_education(gold),
        reports.segment_report(segments),
        pipeline.compare_models(gold),
        ingest.stream_summary(ingest.ingest_directory(spark, retail_dir, store.path("stream"))),
    ):
        run(report)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE + TRAINING
    for name in names:
        if name in QUERIES:
            action = lambda name=name: run(QUERIES[name](spark, sf_dir))
            if name in TRAINING or name == "model_comparison":
                timings[name] = timed(action)
            else:
                action()
                timings[name] = statistics.median(timed(action) for _ in range(3))
            print(f"{name:28s} {timings[name]:8.2f}s", file=sys.stderr, flush=True)
    if not chosen or "full_pipeline" in chosen:
        feeds = new_path(spark, "retail-csv"), new_path(spark, "bank-csv")
        columns = [c for c in bank_raw(spark, sf_dir).columns if c != "c_custkey"]
        csv.write_csv(retail_raw(spark, sf_dir), feeds[0])
        csv.write_csv(bank_raw(spark, sf_dir, columns), feeds[1], sep=";")
        timings["full_pipeline"] = timed(lambda: full_pipeline(spark, feeds))
        print(f"{'full_pipeline':28s} {timings['full_pipeline']:8.2f}s", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in timings.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
