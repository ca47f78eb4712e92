"""Headline timings: one JSON line with the median seconds per query.

Snapshots come from the tables in ``BENCH_SF_DIR``. Operators are timed against stored layers and written
to the ``noop`` sink; the ``job_*`` entries time whole layer jobs, including their writes, on a ``Lake`` with all
defaults and on one with a bucket per core. Entries ending
in ``_xN`` run on the same snapshots with the key range repeated N times (``BENCH_REPLICAS``).
``BENCH_HISTORY=10,100`` adds the bronze job after that many batches of history.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from lakehist.functions import AsOf
from lakehist.operators import scd1_mirror, scd2_delta, top_bottom, validate_keys
from lakehist.plans import CUSTOMERS, Lake, run_all, run_bronze, run_gold, run_ranking, run_silver
from lakehist.plans.snapshots import raw_day1, raw_day2
from lakehist.sources import scratch_dir
from lakehist.sources.files import delete
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPLICAS = [int(n) for n in os.environ.get("BENCH_REPLICAS", "1,100").split(",")]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HISTORY = [int(n) for n in os.environ.get("BENCH_HISTORY", "").split(",") if n]
KEY_STEP = 100_000_000

DAY1, DAY2 = AsOf.at("2001-08-01 12:00:00"), AsOf.at("2001-08-02 12:00:00")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakehist-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def replicate(snapshot: DataFrame, n: int) -> DataFrame:
    copies = snapshot.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.withColumn("customer_id", F.col("customer_id") + F.col("_copy").cast("long") * KEY_STEP).drop("_copy")


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work: Callable[[], object]) -> float:
    work()  # warm-up
    seconds = []
    for _ in range(RUNS):
        started = time.perf_counter()
        work()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 4)


def measure(spark: SparkSession, replicas: int) -> dict[str, float]:
    base = scratch_dir(spark, f"bench-x{replicas}")
    parts = int(CPUS) * 2
    for n, day in enumerate((raw_day1, raw_day2), 1):
        replicate(day(spark, SF_DIR), replicas).repartition(parts).write.parquet(f"{base}/day{n}")
    seen = spark.read.schema(CUSTOMERS.raw).parquet(f"{base}/day2")
    plain, bucketed = Lake(f"{base}/plain"), Lake(f"{base}/bucketed", buckets=int(CPUS))
    for lake in (plain, bucketed):
        run_all(spark, lake, DAY1, raw_path=f"{base}/day1")

    def delta(lake: Lake) -> DataFrame:
        return scd2_delta(lake.bronze.read(spark, 0), seen, CUSTOMERS.history, DAY2)

    def mirror(lake: Lake) -> DataFrame:
        source = CUSTOMERS.conformed(lake.bronze.read(spark, 1), DAY2)
        return scd1_mirror(lake.silver.read(spark, 0), source, CUSTOMERS.mirror)

    def enriched() -> DataFrame:
        return CUSTOMERS.enriched(plain.silver.read(spark, 0), DAY1)

    day2 = f"{base}/day2"
    work: dict[str, Callable[[], object]] = {
        "key_check": lambda: validate_keys(seen, CUSTOMERS.history.keys),
        "scd2_merge": lambda: noop(delta(plain)),
        "scd2_merge_bucketed": lambda: noop(delta(bucketed)),
        "job_bronze": lambda: run_bronze(spark, plain, DAY2, batch=1, raw_path=day2),
        "job_bronze_bucketed": lambda: run_bronze(spark, bucketed, DAY2, batch=1, raw_path=day2),
        "scd1_mirror": lambda: noop(mirror(plain)),
        "scd1_mirror_bucketed": lambda: noop(mirror(bucketed)),
        "job_silver": lambda: run_silver(spark, plain, DAY2, batch=1),
        "job_silver_bucketed": lambda: run_silver(spark, bucketed, DAY2, batch=1),
        "gold_enriched": lambda: noop(enriched()),
        "spender_ranking": lambda: noop(top_bottom(plain.gold.read(spark, 0), CUSTOMERS.ranking, DAY1.audit())),
        "job_gold": lambda: run_gold(spark, plain, DAY2, batch=1),
        "job_ranking": lambda: run_ranking(spark, plain, DAY2).collect(),
        "end_to_end": lambda: run_all(spark, plain, DAY2, batch=1, raw_path=day2),
    }
    suffix = "" if replicas == 1 else f"_x{replicas}"
    seconds = {name + suffix: timed(job) for name, job in work.items()}
    delete(spark, base)
    return seconds


def measure_history(spark: SparkSession) -> dict[str, float]:
    """The same batch on top of a short and a long history."""
    base = scratch_dir(spark, "bench-history")
    days = [f"{base}/day1", f"{base}/day2"]
    for path, day in zip(days, (raw_day1, raw_day2)):
        replicate(day(spark, SF_DIR), 10).repartition(int(CPUS)).write.parquet(path)
    lake = Lake(f"{base}/lake", keep=2)
    seconds = {}
    for batch in range(max(HISTORY) + 1):
        def job() -> int:
            return run_bronze(spark, lake, DAY2, batch=batch, raw_path=days[batch % 2])

        if batch in HISTORY:
            seconds[f"job_bronze_x10_after_{batch}"] = timed(job)
        else:
            job()
    delete(spark, base)
    return seconds


def main() -> None:
    spark = session()
    queries: dict[str, float] = {}
    for replicas in REPLICAS:
        queries.update(measure(spark, replicas))
    if HISTORY:
        queries.update(measure_history(spark))
    total = round(sum(queries.values()), 4)
    print(json.dumps({"metric": "total_median_seconds", "value": total, "unit": "sec", "queries": queries,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
