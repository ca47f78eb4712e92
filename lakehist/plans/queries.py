"""Every operator as a query over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

All of them run on fixed days, never on the live clock, so that results can be compared. What a query
stores goes to fresh folders under ``spark.checkpoint.dir``; its result reads them, so they are left there.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehist import operators as ops
from lakehist.functions import AsOf
from lakehist.operators.scd2 import ACTION, CURRENT, UPDATED
from lakehist.plans.customers import CUSTOMERS
from lakehist.plans.layers import Lake, run_all, run_bronze, run_gold, run_silver
from lakehist.plans.snapshots import next_day, raw_day1
from lakehist.sources import BatchTable, SinkSpec, read_snapshot, scratch_dir, superset

Query = Callable[[SparkSession, str], DataFrame]

DAY1 = AsOf.at("2001-08-01 12:00:00")
DAY2 = AsOf.at("2001-08-02 12:00:00")
DAY3 = AsOf.at("2001-08-03 12:00:00")

HISTORY, MIRROR, RANKING = CUSTOMERS.history, CUSTOMERS.mirror, CUSTOMERS.ranking


def _comparable(history: DataFrame) -> DataFrame:
    """``updated_at`` as epoch seconds, which read the same in every session zone."""
    return history.withColumn("updated_epoch", F.unix_seconds(UPDATED)).drop(UPDATED)


def _without_some_keys(snapshot: DataFrame) -> DataFrame:
    """The snapshot with every third key missing."""
    key = F.col("customer_id")
    return snapshot.withColumn("customer_id", F.when(key % 3 != 0, key))


def _two_days(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    day1 = raw_day1(spark, sf)
    return day1, next_day(day1)


# -- history ---------------------------------------------------------------------------------------


def _bronze1_and_day2(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    day1, day2 = _two_days(spark, sf)
    return ops.scd2_bootstrap(day1, DAY1), day2


def _stored_history(spark: SparkSession, *days: tuple[AsOf, DataFrame]) -> DataFrame:
    """Apply snapshots one after the other, each batch to the stored state of the one before."""
    table = BatchTable(scratch_dir(spark, "history"), CUSTOMERS.bronze, HISTORY.keys, CURRENT)
    for batch, (as_of, rows) in enumerate(days):
        if batch:
            rows = ops.scd2_delta(table.read(spark, batch - 1), rows, HISTORY, as_of)
        else:
            rows = ops.scd2_bootstrap(rows, as_of)
        table.write(rows, batch)
    return table.read_history(spark)


def bronze_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    return _comparable(ops.scd2_bootstrap(raw_day1(spark, sf), DAY1))


def current_versions(spark: SparkSession, sf: str) -> DataFrame:
    day1, day2 = _two_days(spark, sf)
    history = _stored_history(spark, (DAY1, day1), (DAY2, day2))
    return _comparable(ops.current_versions(history))


def _changed(null_safe: bool) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        spec = replace(HISTORY, null_safe=null_safe)
        return ops.changed_keys(*_two_days(spark, sf), spec)

    return query


def silver_changed_keys(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _mirror_sides(spark, sf)
    return ops.changed_keys(target, source, ops.HistorySpec(MIRROR.keys, MIRROR.tracked))


def _history_action(action: str, keeps_flag: bool) -> Query:
    """The rows one clause of the history merge writes: versions it closes, or versions it opens."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        delta = ops.scd2_delta(*_bronze1_and_day2(spark, sf), HISTORY, DAY2, actions=True)
        return _comparable(delta.where((F.col(ACTION) == action) & (F.col(CURRENT) == keeps_flag)).drop(ACTION))

    return query


def _merge(null_safe: bool = False) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        spec = replace(HISTORY, null_safe=null_safe)
        return _comparable(ops.scd2_merge(*_bronze1_and_day2(spark, sf), spec, DAY2))

    return query


def scd2_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    day1, day2 = map(_without_some_keys, _two_days(spark, sf))
    return _comparable(ops.scd2_merge(ops.scd2_bootstrap(day1, DAY1), day2, HISTORY, DAY2))


def scd2_replay(spark: SparkSession, sf: str) -> DataFrame:
    day1, day2 = _two_days(spark, sf)
    return _comparable(_stored_history(spark, (DAY1, day1), (DAY2, day2), (DAY3, day1)))


def scd2_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    day1, day2 = _two_days(spark, sf)
    return _comparable(_stored_history(spark, (DAY1, day1), (DAY2, day2), (DAY3, day2)))


def key_violations(spark: SparkSession, sf: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    customer = F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey"))
    return ops.key_violations(orders.select(customer.alias("customer_id")), ["customer_id"])


# -- mirror ----------------------------------------------------------------------------------------


def silver_conform(spark: SparkSession, sf: str) -> DataFrame:
    return CUSTOMERS.conformed(raw_day1(spark, sf), DAY1)


def _mirror_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    day1, day2 = _two_days(spark, sf)
    return CUSTOMERS.conformed(day1, DAY1), CUSTOMERS.conformed(day2, DAY2)


def _mirror_action(action: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        target, source = _mirror_sides(spark, sf)
        return ops.scd1_delta(target, source, MIRROR).where(F.col(ACTION) == action).drop(ACTION)

    return query


def scd1_mirror(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _mirror_sides(spark, sf)
    return ops.scd1_mirror(target, source, MIRROR)


def scd1_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    day1, day2 = map(_without_some_keys, _two_days(spark, sf))
    target, source = CUSTOMERS.conformed(day1, DAY1), CUSTOMERS.conformed(day2, DAY2)
    return ops.scd1_mirror(target, source, MIRROR)


# -- attributes and report -------------------------------------------------------------------------


def gold_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return CUSTOMERS.enriched(silver_conform(spark, sf), DAY1)


def _attribute(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return gold_enriched(spark, sf).select("id_cliente", name)

    return query


def top_spenders(spark: SparkSession, sf: str) -> DataFrame:
    return ops.top(gold_enriched(spark, sf), RANKING, DAY1.audit())


def bottom_spenders(spark: SparkSession, sf: str) -> DataFrame:
    return ops.bottom(gold_enriched(spark, sf), RANKING, DAY1.audit())


def bottom_known_spenders(spark: SparkSession, sf: str) -> DataFrame:
    return ops.bottom(gold_enriched(spark, sf), RANKING, DAY1.audit(), skip_null=True)


def spender_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Both halves read the attributes, so they are stored once and read back, as the jobs do."""
    gold = BatchTable(scratch_dir(spark, "gold"), None)
    gold.write(gold_enriched(spark, sf), 0)
    return ops.top_bottom(gold.read(spark), RANKING, DAY1.audit())


# -- stored layers: day 1, day 2, then day 1 again -------------------------------------------------


def _lake(spark: SparkSession, sf: str, **settings) -> Lake:
    """A new lake with the first day's snapshot in its raw layer."""
    base = scratch_dir(spark, "lake")
    sinks = {name: (SinkSpec("parquet", path=f"{base}/served/{name}"),) for name in ("gold", "ranking")}
    lake = Lake(base, gold_sinks=sinks["gold"], ranking_sinks=sinks["ranking"], **settings)
    raw_day1(spark, sf).write.parquet(lake.raw)
    return lake


def _three_days(spark: SparkSession, sf: str, job: Callable, **settings) -> Lake:
    lake = _lake(spark, sf, **settings)
    day2 = f"{lake.path('raw')}/day2.parquet"
    next_day(read_snapshot(spark, lake.raw, CUSTOMERS.raw)).write.parquet(day2)
    for as_of, path in [(DAY1, lake.raw), (DAY2, day2), (DAY3, lake.raw)]:
        job(spark, lake, as_of, path)
    return lake


def _bronze_job(spark: SparkSession, lake: Lake, as_of: AsOf, path: str) -> None:
    run_bronze(spark, lake, as_of, raw_path=path)


def _silver_job(spark: SparkSession, lake: Lake, as_of: AsOf, path: str) -> None:
    run_bronze(spark, lake, as_of, raw_path=path)
    run_silver(spark, lake, as_of)


def _all_jobs(spark: SparkSession, lake: Lake, as_of: AsOf, path: str) -> None:
    run_all(spark, lake, as_of, raw_path=path)


#: Of the queries that store their layers in buckets.
BUCKETS = 8


def _stored_bronze(bucketed: bool = False) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        lake = _three_days(spark, sf, _bronze_job, buckets=BUCKETS if bucketed else None)
        return _comparable(lake.bronze.read_history(spark))

    return query


def _stored_silver(bucketed: bool = False) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _three_days(spark, sf, _silver_job, buckets=BUCKETS if bucketed else None).silver.read(spark)

    return query


def stored_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _three_days(spark, sf, _all_jobs).gold.read(spark)


def served_gold(spark: SparkSession, sf: str) -> DataFrame:
    """What the gold sink received on day 1."""
    lake = _lake(spark, sf)
    _silver_job(spark, lake, DAY1, lake.raw)
    run_gold(spark, lake, DAY1)
    return spark.read.parquet(lake.gold_sinks[0].path)


def end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """The report the ranking sink received after three days."""
    return spark.read.parquet(_three_days(spark, sf, _all_jobs).ranking_sinks[0].path)


def gold_new_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Gold after the attributes were introduced and a column was dropped: the newest state, with the columns of both."""
    gold = BatchTable(scratch_dir(spark, "gold"), None)
    silver = silver_conform(spark, sf)
    gold.write(silver.select(*CUSTOMERS.gold_columns), 0)
    rows = CUSTOMERS.enriched(silver, DAY1).drop("cidade")
    gold.write(superset(rows, gold.read(spark, 0).schema), 1)
    return gold.read(spark)


def raw_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The first snapshot, stored as a source system would and read under its declared schema."""
    path = f"{scratch_dir(spark, 'raw')}/customers.parquet"
    raw_day1(spark, sf).write.parquet(path)
    return read_snapshot(spark, path, CUSTOMERS.raw)


QUERIES: dict[str, Query] = {
    "raw_snapshot": raw_snapshot,
    "key_violations": key_violations,
    "bronze_bootstrap": bronze_bootstrap,
    "current_versions": current_versions,
    "changed_keys_sql_nulls": _changed(null_safe=False),
    "changed_keys_null_safe": _changed(null_safe=True),
    "silver_changed_keys": silver_changed_keys,
    "scd2_close_changed": _history_action("close_changed", keeps_flag=False),
    "scd2_new_versions": _history_action("insert", keeps_flag=True),
    "scd2_close_missing": _history_action("close_missing", keeps_flag=False),
    "scd2_merge": _merge(),
    "scd2_merge_null_safe": _merge(null_safe=True),
    "scd2_null_keys": scd2_null_keys,
    "scd2_replay": scd2_replay,
    "scd2_idempotent": scd2_idempotent,
    "silver_conform": silver_conform,
    "scd1_update": _mirror_action("update"),
    "scd1_insert": _mirror_action("insert"),
    "scd1_delete": _mirror_action("delete"),
    "scd1_mirror": scd1_mirror,
    "scd1_null_keys": scd1_null_keys,
    "customer_tier": _attribute("nivel_cliente"),
    "new_customer_flag": _attribute("cliente_novo"),
    "recent_purchase_flag": _attribute("compra_recente"),
    "days_since_purchase": _attribute("dias_sem_comprar"),
    "churn_risk": _attribute("risco_churn"),
    "gold_enriched": gold_enriched,
    "gold_new_columns": gold_new_columns,
    "top_spenders": top_spenders,
    "bottom_spenders": bottom_spenders,
    "bottom_known_spenders": bottom_known_spenders,
    "spender_ranking": spender_ranking,
    "stored_bronze": _stored_bronze(),
    "stored_bronze_bucketed": _stored_bronze(bucketed=True),
    "stored_silver": _stored_silver(),
    "stored_silver_bucketed": _stored_silver(bucketed=True),
    "stored_gold": stored_gold,
    "served_gold": served_gold,
    "end_to_end": end_to_end,
}
