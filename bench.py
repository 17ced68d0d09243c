"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs of each query, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import time

from assayer import build_session
from assayer.session import remove_written
from workloads.queries import QUERIES

HEADLINE = (
    "parse_predictions",
    "normalized_labels",
    "sft_records",
    "preference_pairs",
    "evaluation_cells",
    "evaluation_bundle",
    "baseline_comparison",
    "run_comparison",
    "supplier_comparison",
    "confusion_matrix",
    "failure_examples",
    "numbered_records",
    "seeded_permutation",
    "train_split",
    "capped_train_split",
    "first_rows",
    "dataset_train",
    "scored_records",
    "external_baseline",
    "token_sequence_confidence",
    "nested_sequence_confidence",
    "batch_envelopes",
    "ablation_grid",
    "tracked_runs",
    "jsonl_round_trip",
    "daily_metrics",
    "evaluation_report",
    "weighted_mixture",
    "balanced_sample",
    "streamed_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Not timed: starts the session's threads and compiles what all queries share.
    QUERIES["example_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        timed = []
        for _ in range(runs):
            started = time.perf_counter()
            # Every row is computed; none is sent to the driver.
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timed.append(time.perf_counter() - started)
        seconds[name] = round(min(timed), 3)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    remove_written(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "examples_evaluated_per_sec": round(rows / seconds["evaluation_bundle"]),
            }
        )
    )


if __name__ == "__main__":
    main()
