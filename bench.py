"""Times the headline queries; prints one JSON line.

Each query runs over its whole tables.  Results go to a sink that discards
them, so every row and column is computed and none is collected.  One warm-up
run, then the median of ``BENCH_RUNS`` (3) runs.  ``rows_per_sec`` is rows of
the result per second; ``micro_batch_sec`` the time of one more micro-batch of
a resumable run whose generator does next to nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docloom.operators.generators import register_generator  # noqa: E402
from docloom.plans.queries import queries  # noqa: E402
from docloom.session import build_session, work_dir  # noqa: E402
from docloom.streaming.generation import open_run, process_staged, stage_chunks  # noqa: E402

HEADLINE = (
    "clean_technical",
    "chunk_documents",
    "chunk_counts",
    "dedup_chunks",
    "fingerprints",
    "corpus_fingerprint",
    "adoc_clean",
    "adoc_to_markdown",
    "conversion_report",
    "merge_corpus",
    "last_per_basename",
    "generate_qa",
    "batch_plan",
    "resume_pending",
    "resumable_generation",
    "strip_traces",
    "chat_messages",
    "jsonl_round_trip",
    "side_by_side",
)


class Echo:
    """A generator that costs nothing: one row per chunk."""

    schema = T.StructType([T.StructField("chunk_id", T.StringType())])

    def generate(self, chunks, concurrency, timeout):
        return chunks.select("chunk_id")


def micro_batch_seconds(spark, sf_dir: str) -> float:
    """Two runs over the same chunks, with few and with many micro-batches;
    the difference is the cost of a micro-batch."""
    register_generator("echo", Echo())
    chunks = queries()["dedup_chunks"](spark, sf_dir).withColumn("chunk_id", F.sha2("document", 256)).coalesce(1)
    rows = chunks.count()
    seconds = {}
    for batches in (2, 12):
        run = open_run(spark, work_dir(spark, "bench"))
        stage_chunks(run, chunks, -(-rows // batches))
        start = time.perf_counter()
        process_staged(run, spark, "echo")
        seconds[batches] = time.perf_counter() - start
    return (seconds[12] - seconds[2]) / 10


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "docloom-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    rates: dict[str, int] = {}
    for name in names:
        query = queries()[name]
        seconds = []
        for _ in range(runs + 1):
            rows = Observation()
            start = time.perf_counter()
            counted = query(spark, sf_dir).observe(rows, F.count(F.lit(1)).alias("n"))
            counted.write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
        rates[name] = round(rows.get["n"] / timings[name])
        print(f"{name}: {timings[name]} s, {rates[name]} rows/s", file=sys.stderr)
    micro_batch = None if sys.argv[1:] else round(micro_batch_seconds(spark, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rows_per_sec": rates,
                "micro_batch_sec": micro_batch,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
