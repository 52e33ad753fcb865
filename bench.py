"""Time the headline queries and print one JSON line.

Every query is run to its last row through the no-op sink; ``batch_run`` is
the whole batch with all of its files written. Each figure is the median of
``BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tallylake.plans import batch
from tallylake.workspace import new_folder
from testbed import fixtures
from testbed.queries import QUERIES

HEADLINE = (
    "validity_summary",
    "quality_report",
    "distinct_business_keys",
    "interactions_per_member",
    "flat_view",
    "flat_contract_strings",
    "dim_associado",
    "fato_movimentacao",
    "brand_mart",
    "brand_mart_from_flat",
    "kpi_summary",
    "sample_rows",
    "severity_bands",
    "check_pk",
    "check_fk",
    "check_all",
    "dedup_movements",
    "idempotent_merge",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # At this size even the transactions fit under the 10 MB default and would
        # be broadcast; a lower limit keeps the joins as they are on large tables.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def to_the_end(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def whole_batch() -> None:
        batch.run(fixtures.load(spark, sf_dir), new_folder(spark, "bench"))

    jobs = {name: (lambda name=name: to_the_end(name)) for name in HEADLINE}
    jobs["batch_run"] = whole_batch

    seconds = {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)

    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
