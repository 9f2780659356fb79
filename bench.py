"""Headline queries at one scale: one JSON line with the warm median of three runs of each, in seconds."""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINE = (
    "md_metrics", "noise_repeated_lines", "opening_noise", "duplicate_content", "snapshot_digest", "snapshot_stale_diff", "page_titles", "block_ids", "heading_path", "caption_binding", "figure_references",
    "render_tables", "part_files", "table_audit", "ledger_merge", "gate_status", "ir_gate", "quality_gate", "golden_score", "anchor_map", "evidence_join",
)


def main() -> None:
    from pyspark.sql import SparkSession

    cpus, sf_dir = os.environ.get("BENCH_CPUS", "4"), os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(2 * int(cpus))).config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    from blockloom import catalog

    times: dict[str, float] = {}
    for name in HEADLINE:
        took = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        times[name] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "total_warm_median", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
