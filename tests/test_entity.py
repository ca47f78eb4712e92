"""The jobs on a table that is nothing like customers: two keys, other columns, other rules."""

from collections import Counter
from datetime import date

import pytest
from lakehist.functions import AsOf, first_above
from lakehist.operators import HistorySpec, MirrorSpec, Ranking
from lakehist.plans import Entity, Lake, run_all, run_ranking
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

RAW = StructType([
    StructField("shop", StringType()), StructField("sku", StringType()),
    StructField("price", DoubleType()), StructField("sale.on?", BooleanType()), StructField("note", StringType()),
])
STOCK = Entity(
    name="stock",
    raw=RAW,
    history=HistorySpec(keys=("shop", "sku"), tracked=("price", "sale.on?")),
    silver=StructType([
        StructField("shop", StringType()), StructField("sku", StringType()), StructField("price", DoubleType()),
        StructField("sale", BooleanType()), StructField("seen_at", StringType()),
    ]),
    mapping={"shop": "shop", "sku": "upper(sku)", "price": "price", "sale": "`sale.on?`"},
    mirror=MirrorSpec(keys=("shop", "sku"), tracked=("price", "sale"), audit="seen_at"),
    gold_columns=("shop", "sku", "price", "sale"),
    attributes=lambda as_of: {"band": first_above(F.col("price"), ((10, "dear"),), "cheap")},
    ranking=Ranking(
        metric="price", keys=("shop", "sku"), active="sale", columns=("shop", "sku"), label_column="list",
        top_label="dear", bottom_label="cheap", stamp_column="at", k=1,
    ),
)


@pytest.mark.parametrize("buckets", [0, 3])
def test_another_entity(spark, tmp_path, buckets):
    lake = Lake(str(tmp_path / "lake"), entity=STOCK, buckets=buckets)
    days = [
        (AsOf.at("2024-05-01"), [("n", "a", 5.0, True, "x"), ("n", "b", 50.0, True, "x"), ("s", "a", 5.0, False, "x")]),
        (AsOf.at("2024-05-02"), [("n", "a", 6.0, True, "y"), ("n", "b", 50.0, True, "y"), ("s", "c", 7.0, True, "y")]),
    ]
    for n, (as_of, rows) in enumerate(days):
        path = str(tmp_path / f"day{n}")
        spark.createDataFrame(rows, RAW).write.parquet(path)
        run_all(spark, lake, as_of, raw_path=path)
    history = Counter((r.shop, r.sku, r.price, r.note, r.end_date) for r in lake.bronze.read_history(spark).collect())
    closed, still_open = date(2024, 5, 2), date(9999, 12, 31)
    assert history == Counter([
        ("n", "a", 5.0, "x", closed), ("n", "a", 6.0, "y", still_open), ("n", "b", 50.0, "x", still_open),
        ("s", "a", 5.0, "x", closed), ("s", "c", 7.0, "y", still_open),
    ])
    gold = {(r.shop, r.sku, r.band) for r in lake.gold.read(spark).collect()}
    assert gold == {("n", "A", "cheap"), ("n", "B", "dear"), ("s", "C", "cheap")}
    report = run_ranking(spark, lake, days[1][0]).collect()
    assert {(r.shop, r.sku, r.list) for r in report} == {("n", "B", "dear"), ("n", "A", "cheap")}
