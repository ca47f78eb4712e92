from datetime import date, timedelta

import pytest
from lakehist.functions import AsOf, at_most, days_since, first_above, first_at_least
from lakehist.plans.customers import (
    CHURN_BOUNDS,
    CHURN_DEFAULT,
    CUSTOMERS,
    NEW_CUSTOMER_DAYS,
    RECENT_PURCHASE_DAYS,
    TIER_DEFAULT,
    TIER_FLOORS,
)
from pyspark.sql import functions as F

TODAY = date(2024, 5, 1)
AS_OF = AsOf.at("2024-05-01 10:00:00")


def evaluate(spark, column, values, ddl):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r.y for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


def ago(days):
    return None if days is None else TODAY - timedelta(days=days)


def test_tier_floors_are_inclusive_and_null_falls_through(spark):
    cases = {
        10000.0: "Ouro", 9999.99: "Prata", 5000.0: "Prata", 4999.99: "Bronze", 1000.0: "Bronze",
        999.99: "Novo", -1.0: "Novo", None: "Novo", float("nan"): "Ouro",
    }
    got = evaluate(spark, first_at_least(F.col("x"), TIER_FLOORS, TIER_DEFAULT), list(cases), "double")
    assert got == list(cases.values())


@pytest.mark.parametrize(
    ("limit", "cases"),
    [
        (NEW_CUSTOMER_DAYS, {90: True, 91: False, -3: True, None: False}),
        (RECENT_PURCHASE_DAYS, {15: True, 16: False, -1: True, None: False}),
    ],
)
def test_day_limits_are_inclusive_and_null_is_false(spark, limit, cases):
    got = evaluate(spark, at_most(days_since("x", AS_OF), limit), [ago(d) for d in cases], "date")
    assert got == list(cases.values())


def test_days_since_is_negative_for_the_future_and_null_for_null(spark):
    assert evaluate(spark, days_since("x", AS_OF), [ago(7), ago(0), ago(-2), None], "date") == [7, 0, -2, None]


def test_churn_bounds_are_exclusive_and_null_is_low(spark):
    cases = {181: "Alto", 180: "Médio", 91: "Médio", 90: "Baixo", 0: "Baixo", None: "Baixo"}
    column = first_above(days_since("x", AS_OF), CHURN_BOUNDS, CHURN_DEFAULT)
    assert evaluate(spark, column, [ago(d) for d in cases], "date") == list(cases.values())


def test_conform_keeps_null_names_and_formats(spark):
    raw = spark.createDataFrame(
        [
            (1, "Ana", "Lima", "a@x", "1", "Rio", "rj", date(2024, 1, 2), None, 5.0, True),
            (2, None, "Sá", "b@x", None, "Rio", None, None, None, None, None),
            (3, "Rui", None, None, None, None, "sp", date(1999, 12, 31), None, None, False),
        ],
        CUSTOMERS.raw,
    )
    rows = {r.id_cliente: r for r in CUSTOMERS.conformed(raw, AS_OF).collect()}
    assert [rows[i].nome_completo for i in (1, 2, 3)] == ["Ana Lima", None, None]
    assert [rows[i].ano_mes for i in (1, 2, 3)] == ["202401", None, "199912"]
    assert [rows[i].estado for i in (1, 2, 3)] == ["RJ", None, "SP"]
    assert {r.data_atualizacao for r in rows.values()} == {"2024-05-01 10:00:00"}
    assert CUSTOMERS.conformed(raw, AS_OF).columns == CUSTOMERS.silver.names
