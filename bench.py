"""Time the headline queries; prints one JSON line.

All queries are run once to warm up and then ``BENCH_RUNS`` times in turn into
the noop sink; the median counts. Rows per second refer to the rows a query reads.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mediacurate.plans.catalogue import ON_FILES, QUERIES  # noqa: E402

# Query and the table whose rows it goes through.
HEADLINE = {
    "metadata_enrich": "documents",
    "manifest_validated": "documents",
    "manifest_listing": "documents",
    "validate_html": "pages",
    "validate_content": "documents",
    "pending": "documents",
    "captioned_rows": "documents",
    "caption_rows_udf": "documents",
    "sidecar_caption": "events",
    "assign_keys": "documents",
    "payload_hash": "documents",
    "fetch_status": "documents",
    "key_caption_last": "documents",
    "final_dedupe": "documents",
    "unify_shards": "documents",
    "stream_ingest": "documents",
}


def run(spark: SparkSession, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds until the query is built, and in all. Files that a query is about are written before."""
    query, given = QUERIES[name], sf_dir
    if name in ON_FILES:
        write, query = ON_FILES[name]
        given = write(spark, sf_dir)
    start = time.perf_counter()
    rows = query(spark, given)
    built = time.perf_counter() - start
    rows.write.format("noop").mode("overwrite").save()
    return built, time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites for error messages cost more than these small queries.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(HEADLINE.values())}
    for name in HEADLINE:
        run(spark, name, sf_dir)
    taken = {name: [] for name in HEADLINE}
    for _ in range(runs):
        for name in HEADLINE:
            taken[name].append(run(spark, name, sf_dir))
    built, seconds = (
        {name: round(statistics.median(t[part] for t in times), 3) for name, times in taken.items()} for part in (0, 1)
    )
    rates = {name: round(rows[table] / seconds[name]) for name, table in HEADLINE.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "build_sec": built,
                "rows_per_sec": rates,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
