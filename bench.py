"""Headline-query benchmark.

Runs the headline queries over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line.  Each query is forced end to end with
the ``noop`` sink (full computation, nothing collected to the driver).

Warm-up: every headline query first runs once on the smallest scale factor next to
``$BENCH_SF_DIR`` (``sf0.001``), so JIT compilation and whole-stage code generation
are paid before timing; each query then runs three times over the benchmark scale's own
files, and the median is reported.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

RUNS = 3

HEADLINE = [
    "l4_period_change", "l1_address_clipped", "l5_flats_by_area", "l8_postcodes_in_subareas",
    "w1_add_count", "a4_multi_occupancy", "j9_flag_any", "j11_lookup_first", "r2_widen",
    "r5_tag_matrix", "w3_row_id", "w5_first_per_key", "g3_tag", "h1_links", "h4_split_names",
    "h7_kv_records", "l7_durations", "l2_building_heights", "l3_schools_update", "g4_reproject",
]


def main() -> None:
    from landframe.plans import QUERIES, load_all
    from landframe.session import build_session

    load_all()
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    folder = tempfile.mkdtemp(prefix="bench-")  # one machine: its own scratch folder
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra={"spark.checkpoint.dir": folder})
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(median(runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
