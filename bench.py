"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from trialcohort.plans.driver_queries import queries
from trialcohort.session import session

HEADLINE = [
    "group_max_rows",
    "baseline_rows",
    "categorised_baselines",
    "null_safe_join",
    "demographic_pivot",
    "representation",
    "shares",
    "study_frame",
    "aligned_lists",
    "keyword_flags",
    "keyword_counts",
    "trial_text",
    "intervention_flags",
    "label_requests",
    "label_table",
    "icd_chapter",
    "icd_map",
    "wide_table",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warms the JVM up

    known = queries()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
