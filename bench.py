"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` is the folder of the tables, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from siltline.catalog import REGISTRY
from siltline.session import local_session

#: Timed runs of a query after an untimed one; the median counts.
RUNS = 2
HEADLINES = [
    "f4_apportion", "a1_read_raw_csv", "a5_partition_overwrite", "a8_zip_columns", "b1_unpivot",
    "b3_split_by_prefix_table", "c2_safe_cast_decimal", "c9_surrogate_key", "d7_reject_counts",
    "e1_exact_dedup", "e2_first_per_key", "f3_share_of_total", "f5_star_lookup", "f7_orphans",
    "g1_sum_by_four_keys", "g4_profile", "h2_partition_total", "h4_top_ranked", "i1_snapshot", "j1_date_spine",
    "l5_suite", "m2_senasa_certs", "m3_weather_daily_readings", "m6_int_exports_enriched", "m10_fct_exports",
    "k1_value_by_quarter", "o1_incremental",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    timed(spark, HEADLINES[0], sf_dir)
    cold, seconds = {}, {}
    for name in HEADLINES:
        cold[name] = timed(spark, name, sf_dir)
        seconds[name] = median(timed(spark, name, sf_dir) for _ in range(RUNS))
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold": cold,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
