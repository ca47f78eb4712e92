"""The customer table: schemas, mapping, rules and report.

The output names, labels, thresholds and expressions in this file are fixed values: results are only
right when they equal these.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from lakehist.functions import AsOf, at_most, days_since, first_above, first_at_least
from lakehist.operators import HistorySpec, MirrorSpec, Ranking
from lakehist.plans.entity import Entity

RAW = StructType([
    StructField("customer_id", LongType(), False),
    StructField("first_name", StringType()),
    StructField("last_name", StringType()),
    StructField("email", StringType()),
    StructField("phone", StringType()),
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("signup_date", DateType()),
    StructField("last_purchase_date", DateType()),
    StructField("total_spent", DoubleType()),
    StructField("is_active", BooleanType()),
])

SILVER = StructType([
    StructField("id_cliente", LongType(), False),
    StructField("ano_mes", StringType()),
    StructField("nome", StringType()),
    StructField("sobrenome", StringType()),
    StructField("nome_completo", StringType()),
    StructField("email", StringType()),
    StructField("telefone", StringType()),
    StructField("cidade", StringType()),
    StructField("estado", StringType()),
    StructField("data_entrada", DateType()),
    StructField("data_ultima_compra", DateType()),
    StructField("total_gasto", DoubleType()),
    StructField("status", BooleanType()),
    StructField("data_atualizacao", StringType(), False),
])

# Silver column -> expression over the raw columns. The full name is NULL if either part is.
SILVER_MAPPING = {
    "id_cliente": "customer_id",
    "ano_mes": "date_format(signup_date, 'yyyyMM')",
    "nome": "first_name",
    "sobrenome": "last_name",
    "nome_completo": "concat(first_name, ' ', last_name)",
    "email": "email",
    "telefone": "phone",
    "cidade": "city",
    "estado": "upper(state)",
    "data_entrada": "signup_date",
    "data_ultima_compra": "last_purchase_date",
    "total_gasto": "total_spent",
    "status": "is_active",
}

# Spend floors (inclusive), day limits (inclusive) and churn bounds (exclusive).
TIER_FLOORS = ((10000, "Ouro"), (5000, "Prata"), (1000, "Bronze"))
TIER_DEFAULT = "Novo"
NEW_CUSTOMER_DAYS = 90
RECENT_PURCHASE_DAYS = 15
CHURN_BOUNDS = ((180, "Alto"), (90, "Médio"))
CHURN_DEFAULT = "Baixo"

GOLD_COLUMNS = tuple(name for name in SILVER.names if name != "data_atualizacao")


def gold_attributes(as_of: AsOf) -> Mapping[str, Column]:
    """A customer who never bought has no days to count: not recent, and at low risk by default."""
    idle = days_since("data_ultima_compra", as_of)
    return {
        "nivel_cliente": first_at_least(F.col("total_gasto"), TIER_FLOORS, TIER_DEFAULT),
        "cliente_novo": at_most(days_since("data_entrada", as_of), NEW_CUSTOMER_DAYS),
        "compra_recente": at_most(idle, RECENT_PURCHASE_DAYS),
        "dias_sem_comprar": idle,
        "risco_churn": first_above(idle, CHURN_BOUNDS, CHURN_DEFAULT),
    }


CUSTOMERS = Entity(
    name="customers",
    raw=RAW,
    history=HistorySpec(keys=("customer_id",), tracked=tuple(RAW.names[1:])),
    silver=SILVER,
    mapping=SILVER_MAPPING,
    # The year-month follows data_entrada, so it need not be compared as well.
    mirror=MirrorSpec(
        keys=("id_cliente",),
        tracked=tuple(n for n in SILVER.names if n not in ("id_cliente", "ano_mes", "data_atualizacao")),
        audit="data_atualizacao",
    ),
    gold_columns=GOLD_COLUMNS,
    attributes=gold_attributes,
    ranking=Ranking(
        metric="total_gasto",
        keys=("id_cliente",),
        active="status",
        columns=("id_cliente", "nome_completo", "total_gasto", "status", "nivel_cliente", "dias_sem_comprar"),
        label_column="categoria",
        top_label="Melhores clientes",
        bottom_label="Clientes a serem trabalhados",
        stamp_column="data_hora_analise",
    ),
)
