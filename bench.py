"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice: `cold` includes planning and class loading of a first
run, `queries` holds the second run. The batch of all analyses and the LSA
model run once, for both. `value` sums `queries`. Searches of the second run use
the index that the first has stored; building it is a job of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import checks.load  # noqa: E402,F401
from checks import batch, texts  # noqa: E402
from checks.compare import session  # noqa: E402
from checks.registry import QUERIES  # noqa: E402

HEADLINE = [
    "A5_weighted_percentage", "A6_count_respondents", "A7_frequency_table", "A11_state_education", "A16_group_sample_sizes",
    "T2_T3_standardized_rates", "T5_age_standardized_metric", "T6_standardized_ranking", "T7_education_by_group_cells",
    "K2_K3_education_gap_by_state", "K4_rank_correlations", "K5_rank_underserved_top10", "K8_population_profile",
    "C3_cleaning_log", "V2_code_audit", "V7_weighted_vs_unweighted", "V9_validation_rules", "S6_dataset_build",
    "R4_split_long_sections", "R9_vocabulary", "R12_dense_top_k", "R13_sparse_top_k", "R14_rank_fusion", "R15_pinned_retrieval", "R15_pinned_retrieval_by_source",
    "M1_M4_ranked_organizations", "Q1_question_tags",
]
BATCH, INDEX, MODEL = "batch_analyses_1_to_6", "R14_index_build", "R11_lsa_embedding"
ONCE = (BATCH, MODEL)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    jobs = {name: (lambda n=name: QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()) for name in HEADLINE}
    jobs[INDEX] = lambda: texts.new_index(spark, sf_dir)
    jobs[MODEL] = lambda: QUERIES[MODEL](spark, sf_dir).write.format("noop").mode("overwrite").save()
    jobs[BATCH] = lambda: batch.run(spark, sf_dir)
    cold, warm = {}, {}
    for name, job in jobs.items():
        for times in (cold,) if name in ONCE else (cold, warm):
            start = time.time()
            job()
            times[name] = round(time.time() - start, 3)
    warm |= {name: cold[name] for name in ONCE}
    print(json.dumps({
        "metric": "headline_queries_warm_total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm,
        "cold": cold, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
