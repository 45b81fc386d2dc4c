"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (full plan, no
collect to the driver), once to warm up and then ``$BENCH_RUNS`` times; the
median wall time is reported. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from glossa.plans.registry import all_queries  # noqa: E402
from glossa.session import local_session  # noqa: E402

HEADLINE = [
    "daily_metrics_rolling",
    "volume_anomalies",
    "product_metrics",
    "brand_summary",
    "category_summary",
    "top_products",
    "review_product_join",
    "filter_summary",
    "duplicates",
    "clean_text",
    "text_features",
    "keyword_category",
    "lexicon_sentiment",
    "daily_social",
    "social_pivot",
    "social_kpis",
    "hashtag_impact",
    "source_precedence",
    "platform_correlations",
    "lag_correlations",
    "spearman_matrix",
    "anova_brand",
    "welch_ttest",
    "rfm_segments",
    "tweet_stream_daily",
    "spearman_pairs",
    "validation_checks",
    "statistical_tests",
    "review_clusters",
    "rule_valence",
    "rule_polarity",
    "spearman_pairwise",
    "platform_models",
]


def run(spark, build, sf_dir):
    t0 = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    qs = all_queries()
    times = {}
    for name in names:
        build = qs[name].build
        run(spark, build, sf_dir)  # warm-up (JIT, file listing, code generation)
        times[name] = round(statistics.median(run(spark, build, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
