"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local cores. Each query is run to the end
(``noop`` sink) ``BENCH_RUNS`` times after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import local_session  # noqa: E402
from checks.fixtures import domain_tables  # noqa: E402
from checks.registry import REGISTRY  # noqa: E402

HEADLINE = (
    "member_months_current",
    "basic_metrics",
    "inpatient_metrics",
    "outpatient_metrics",
    "snf_metrics",
    "er_metrics",
    "pac_metrics",
    "pac_drg_summary",
    "lines_metrics",
    "eol_metrics",
    "betos_summary",
    "truncation_summary",
    "snf_readmit_cases",
    "metrics_report",
)


def seconds(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def fixture_seconds(spark, sf_dir: str) -> float:
    """How long deriving and reading all claims takes, which is part of most queries' time."""
    started = time.perf_counter()
    domain_tables(spark, sf_dir).outclaims.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, partitions=cpus)
    timings = {}
    for name in names:
        seconds(REGISTRY[name], spark, sf_dir)
        timings[name] = round(statistics.median(seconds(REGISTRY[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    fixtures = round(statistics.median(fixture_seconds(spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "deriving_claims": fixtures,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
