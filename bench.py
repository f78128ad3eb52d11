"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores),
``BENCH_RUNS`` (timed runs per query, the median counts), ``BENCH_QUERIES``
(comma list, overrides the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from labelgap.registry import QUERIES, load
from labelgap.session import local_session

HEADLINE = [
    "tag_filter_broad", "null_profile", "nutrient_pivot", "tags_to_text", "top_category_mapped", "allergen_flags", "flag_rates",
    "impute_group_mean", "lang_presence_array", "gap_crosstab", "gap_ratio", "left_join_nutrients", "split_exact",
    "split_stratified", "scale_standard", "label_encode", "psi", "ks_statistic", "wasserstein", "stat_validation", "corr_diff",
    "auroc", "roc_points", "class_report", "copula_marginals", "synthesize_rows", "parse_score_lines", "label_prompt",
    "label_parse", "json_flatten",
]


def run(name: str, spark, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = os.environ.get("BENCH_QUERIES")
    load()
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times, spread = {}, {}
    for name in names.split(",") if names else HEADLINE:
        run(name, spark, folder)  # warm-up: code generation, file listing
        taken = [run(name, spark, folder) for _ in range(runs)]
        times[name] = round(statistics.median(taken), 3)
        spread[name] = [round(min(taken), 3), round(max(taken), 3)]
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, warm median, summed", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "spread": spread, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
