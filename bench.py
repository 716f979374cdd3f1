"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import tempfile
import time

from rollbook.registered import QUERIES
from rollbook.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = [
    "ag11_time_profile",
    "sl01_latest_buckets_minute",
    "jn01_join_buckets",
    "ag01_pivot_facts",
    "ag17_financial_profile",
    "jb09c_adviser_report",
    "jb09_wide_accounts",
    "jb07_account_documents_from_json",
    "jb03_load_facts",
    "mg05_upsert_largest",
    "mg02_upsert",
    "jn06_band_join",
    "jn13_relabel_all_or_none",
    "wn01_with_previous",
    "wn04_rolling_mean",
    "st06_diff_companies",
    "pf02_company_document",
]


def run(spark, name):
    """Seconds to compute all rows and columns of a query."""
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        CPUS,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            # the tables are one small file each: several tasks read it, as they would read many files
            "spark.sql.files.maxPartitionBytes": "2m",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "ag10_frequency")
    seconds = {name: run(spark, name) for name in HEADLINE}
    keys = QUERIES["ag06_key_list"](spark, FOLDER).count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "pivot_keys": keys,
                "pivot_keys_per_second": round(keys / seconds["ag01_pivot_facts"], 1),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
