"""Customer snapshots derived from the TPC-H-style test tables: two days of one source system.

Day 1 is all customers, whether or not they have ordered or live in a known nation, with NULLs put in where the
tables have none. Day 2 deletes, changes, blanks, fills and adds rows by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(column: str, n: int, remainder: int = 0):
    return F.col(column) % n == remainder


def raw_day1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered_on = F.col("o_orderdate")
    orders = _table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(ordered_on).cast("date").alias("first_order"),
        F.max(ordered_on).cast("date").alias("last_order"),
    )
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    joined = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(orders, customer.c_custkey == orders.o_custkey, "left")
    )
    null = F.lit(None)
    name = F.split_part("c_name", F.lit("#"), F.lit(1))
    number = F.split_part("c_name", F.lit("#"), F.lit(2))
    spent = F.col("c_acctbal") + 1000.0 * (F.col("c_custkey") % 5)
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(_every("c_custkey", 17), null).otherwise(name).alias("first_name"),
        number.alias("last_name"),
        F.concat(number, F.lit("@example.com")).alias("email"),
        F.when(_every("c_custkey", 13), null).otherwise(F.concat(F.lit("55-"), number)).alias("phone"),
        F.col("n_name").alias("city"),
        F.lower("c_mktsegment").alias("state"),
        F.when(_every("c_custkey", 6), F.col("last_order")).otherwise(F.col("first_order")).alias("signup_date"),
        F.when(_every("c_custkey", 11), null).otherwise(F.col("last_order")).alias("last_purchase_date"),
        F.when(_every("c_custkey", 300, 29), null).otherwise(spent).alias("total_spent"),
        (F.col("c_custkey") % 7 != 0).alias("is_active"),
    )


def next_day(day1: DataFrame) -> DataFrame:
    """Day 2 by the last digit of the key: 0 is deleted, 1-4 change, 5 is also added under a new key."""
    key = "customer_id"
    # One pass: a key ending in 5 comes out twice, as itself and shifted.
    shifts = F.when(_every(key, 10, 5), F.array(F.lit(0), F.lit(10_000_000))).otherwise(F.array(F.lit(0)))
    changes = {
        "first_name": F.when(_every(key, 10, 4), F.coalesce("first_name", F.lit("Recovered"))).otherwise(F.col("first_name")),
        "phone": F.when(_every(key, 10, 3), F.lit(None)).otherwise(F.col("phone")),
        "city": F.when(_every(key, 10, 1), F.lit("MOVED")).otherwise(F.col("city")),
        "total_spent": F.when(_every(key, 10, 2), F.col("total_spent") + 500.0).otherwise(F.col("total_spent")),
    }
    kept = day1.where(F.col(key) % 10 != 0).withColumns(changes).withColumn("_shift", F.explode(shifts))
    return kept.withColumn(key, F.col(key) + F.col("_shift")).drop("_shift")


def raw_day2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_day(raw_day1(spark, sf_dir))
