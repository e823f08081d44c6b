"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from caresift.plans.catalog import QUERIES
from caresift.session import local_session

HEADLINE = [
    "h15_tabular_fitness",
    "h17_many_candidates",
    "h08_roc_curve",
    "h09_roc_auc_continuous",
    "i01_threshold_sweep",
    "i03_weighted_recall_threshold",
    "i05_lowest_threshold_with_recall",
    "c05_describe_continuous",
    "c07_distinct_documents",
    "c16_correlation_matrix",
    "d01_split_60_20_20",
    "d06_quantile_sample",
    "e05_fit_on_train",
    "g04_neighbors_uniform",
    "g09_row_index",
    "g01_logistic_regression",
    "g02_random_forest",
    "a04_result_documents",
    "a10_file_drop_scoring",
    "i15_early_stop",
    "j13_all_checks",
    "j14_pass_rates",
    "j22_image_tags",
    "k08_next_generation",
    "a05_epoch_history",
    "b06_lenient_target",
    "b07_codes_of_many_levels",
    "g03_whole_sample_trees",
    "h09_areas_with_gaps",
    "k05_crossover",
    "l01_joined_results",
    "l03_page",
    "i09_grid_search",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("caresift-bench", cores)
    QUERIES["h01_confusion_counts"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
