"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import catalog  # noqa: E402
from tidemark.session import local_session  # noqa: E402

# Every stage of a full build: accounts, decisions, text, retrieval, models.
HEADLINE = (
    "v1_v5_contract_checks",
    "c8_clean_accounts",
    "f15_j1_features_with_reviews",
    "a1_a2_u3_kpis_with_contracts",
    "a16_request_rollup",
    "p1_j2_t3_high_risk_list",
    "j9_price_scenarios",
    "m10_threshold_policy",
    "m9_w1_lift_table",
    "m8a_m8b_w9_ranking_metrics",
    "m15_w3_j5_x14_customer_drivers",
    "m18_m19_cluster_quality",
    "n2_x3_x4_sentiment",
    "a9_n7_g3_topic_summary",
    "n3_topic_tfidf",
    "n4_n5_t6_x9_topics",
    "r6_lexical_index",
    "r8_dense_top",
    "r10_w4_u2_t9_stratified_search",
    "r14_j10_p7_cited_answers",
    "m11_m22_k4_scored_base",
    "m16_m17_segmentation",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()
    queries["a12_headline_figures"](spark, folder).collect()  # start the session
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
