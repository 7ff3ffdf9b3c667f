"""Headline queries, timed; prints one JSON line.

The card tables are derived from the test tables and stored as ORC before
timing, as the jobs find them in use. ``fraud_report`` and the other queries rebuild the
clearing tables from the feeds, as in earlier rounds; those named ``stored_`` read them
stored, as the report finds them. Each query then runs once to warm up and
``BENCH_RUNS`` times; the best time counts. Results go to Spark's ``noop``
sink, so all rows and columns are computed and none is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cardlake import sinks  # noqa: E402
from cardlake.plans import fraud_report  # noqa: E402
from cardlake.sources import read_table  # noqa: E402
from fixtures.adapters import store_views, view  # noqa: E402
from fixtures.queries import QUERIES  # noqa: E402
from fixtures.scratch import scratch_path  # noqa: E402

HEADLINE = [
    "fraud_report",
    "stored_report",
    "stored_report_months",
    "chargeback",
    "presentment",
    "clearing_union",
    "presentment_chargeback_left",
    "auth_trace",
    "json_parse_fields",
    "tag_pivot",
    "bin_lookup_join",
    "validity_interval_join",
    "scaled_amount_sum",
    "high_water_mark",
    "sink_append_partitioned",
    "sink_partition_replace",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cardlake-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best_of(run, times: int) -> float:
    """Best wall-clock seconds of several runs after one to warm up."""
    run()
    best = float("inf")
    for _ in range(times):
        start = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - start)
    return round(best, 4)


def stored_reports(spark: SparkSession, sf_dir: str, base: str) -> dict:
    """The report, and two months of it, from stored clearing tables."""
    paths = {n: f"{base}/{n}-table" for n in ("presentment", "chargeback")}
    rows = QUERIES["presentment"](spark, sf_dir)
    sinks.overwrite(sinks.ranged(rows, sort=["transaction_date"], files=8), paths["presentment"])
    sinks.overwrite(QUERIES["chargeback"](spark, sf_dir), paths["chargeback"])

    def report(months=None):
        tables = [read_table(spark, p) for p in paths.values()]
        names = ("issuers", "report_groups", "periods", "wallets")
        tables += [view(spark, sf_dir, n) for n in names]
        return fraud_report(*tables, months=months)

    return {
        "stored_report": lambda *_: report(),
        "stored_report_months": lambda *_: report(["199801", "199802"]),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    base = scratch_path(spark, "bench")
    store_views(spark, sf_dir, base)
    queries = QUERIES | stored_reports(spark, sf_dir, base)
    chosen = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in chosen:

        def run(name=name):
            frame = queries[name](spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()

        seconds[name] = best_of(run, runs)
        print(name, seconds[name], file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
