"""Times the headline queries and prints one JSON line.

Every query is run once to warm up and then timed ``BENCH_RUNS`` times (default 1, the best counts);
all result rows are produced and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from cohortlens.queries import QUERIES  # noqa: E402
from cohortlens.session import local_session  # noqa: E402

HEADLINE = (
    "q01_cohort", "q02_first_per_group", "q03_code_flags", "q04_window_pivot", "q05_window_pivot_lines",
    "q06_assemble", "q09_outcome_rate", "q11_los", "q12_null_report", "q15_median_impute",
    "q15b_distributed_median", "q16_standard_scale", "q18_strat_split", "q20_prf", "q21b_auc_all_models",
    "q22b_roc_all_models", "q23_linear_shap", "q24_topk", "q29_feature_matrix", "q30_logreg", "q31_forest",
    "q32_gbt", "q33_tree_shap", "q34_sampled_shap", "q40_clinical_dataset", "q42_first_day_vitals",
)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session("bench", cores, partitions=int(cores) if cores.isdigit() else 8)
    times = {}
    for name in HEADLINE:
        samples = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, d).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        times[name] = round(min(samples[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(d.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
