"""Time the headline queries, warm, and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data folder and the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from regiostar.checks.queries import QUERIES
from regiostar.session import build_session

HEADLINE = (
    "credit_mart", "csv_extract", "macro_extract", "cleaned_cohort", "typed_columns", "inferred_types",
    "fuzzy_mapping", "part_name_mapping", "merged_macro", "surrogate_keys", "star_join",
    "year_replacement", "region_totals", "share_change", "null_report", "yearly_trend", "outlier_report", "description",
    "duplicate_rows", "quality_rules", "yearly_sector_shares",
)


def run(query, spark, folder: str) -> float:
    """Seconds to compute every row and column of the result."""
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        query = QUERIES[name]
        run(query, spark, folder)
        seconds[name] = round(statistics.median(run(query, spark, folder) for _ in range(repeats)), 3)
    result = {
        "metric": "total_warm_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
