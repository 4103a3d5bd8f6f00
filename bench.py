"""Wall time of the headline queries at one scale; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from twinledger.plans import catalog
from twinledger.session import session

HEADLINE = [
    "f1_field_diff", "f9_verdict", "f11_generic_reconcile", "j4_f4_class_diff", "m4_verdict_validation", "m7_m8_field_merge",
    "m9_class_layering", "m10_rank_resolution", "w2_a2_rank_to_date", "x1_flatten", "t3_panel_grid", "a3_roster_consolidation",
    "p3_w1_career_lines", "a7_class_accuracy", "j13_greedy_match", "a15_usage_by_phase",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # compile the JVM's hot paths once, so that the first query does not pay for all
    catalog.QUERIES["f1_field_diff"](spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        t0 = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
