"""The same results as plain SQL over the test tables, written as the textbook procedure.

History is computed here as two merges in a row: first close what changed, then insert what has no current
version and close what is missing. The operators do it in one join, so the two are independent of each
other. The mirror is written as its three clauses. ``concat`` skips NULLs in some databases, so ``||``
it is.
"""

from __future__ import annotations

BUSINESS = (
    "customer_id", "first_name", "last_name", "email", "phone", "city", "state",
    "signup_date", "last_purchase_date", "total_spent", "is_active",
)
TRACKED = BUSINESS[1:]

SILVER = (
    "id_cliente", "ano_mes", "nome", "sobrenome", "nome_completo", "email", "telefone", "cidade", "estado",
    "data_entrada", "data_ultima_compra", "total_gasto", "status", "data_atualizacao",
)
SILVER_TRACKED = tuple(c for c in SILVER if c not in ("id_cliente", "ano_mes", "data_atualizacao"))

# Noon in the business zone on the three days, as date, audit text and epoch seconds (UTC-3).
DAYS = ("2001-08-01", "2001-08-02", "2001-08-03")


def _stamp(n: int) -> str:
    return f"'{DAYS[n]} 12:00:00'"


def _epoch(n: int) -> str:
    return f"CAST(epoch(TIMESTAMP '{DAYS[n]} 15:00:00') AS BIGINT)"


RAW_DAYS = """
o AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS f, CAST(max(o_orderdate) AS DATE) AS l
  FROM orders GROUP BY o_custkey),
day1 AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE split_part(c_name,'#',1) END AS first_name,
    split_part(c_name,'#',2) AS last_name,
    split_part(c_name,'#',2) || '@example.com' AS email,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE '55-' || split_part(c_name,'#',2) END AS phone,
    n_name AS city,
    lower(c_mktsegment) AS state,
    CASE WHEN c_custkey % 6 = 0 THEN l ELSE f END AS signup_date,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE l END AS last_purchase_date,
    CASE WHEN c_custkey % 300 = 29 THEN NULL ELSE c_acctbal + 1000.0 * (c_custkey % 5) END AS total_spent,
    c_custkey % 7 <> 0 AS is_active
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN o ON o_custkey = c_custkey),
day2 AS (
  SELECT customer_id,
    CASE WHEN customer_id % 10 = 4 THEN coalesce(first_name,'Recovered') ELSE first_name END AS first_name,
    last_name, email,
    CASE WHEN customer_id % 10 = 3 THEN NULL ELSE phone END AS phone,
    CASE WHEN customer_id % 10 = 1 THEN 'MOVED' ELSE city END AS city,
    state, signup_date, last_purchase_date,
    CASE WHEN customer_id % 10 = 2 THEN total_spent + 500.0 ELSE total_spent END AS total_spent,
    is_active
  FROM day1 WHERE customer_id % 10 <> 0
  UNION ALL
  SELECT customer_id + 10000000, first_name, last_name, email, phone, city, state,
    signup_date, last_purchase_date, total_spent, is_active
  FROM day1 WHERE customer_id % 10 = 5)"""

# The same days with every third key missing.
KEYLESS_DAYS = ",\n".join(
    f"keyless{n} AS (SELECT CASE WHEN customer_id % 3 <> 0 THEN customer_id END AS customer_id, "
    f"{', '.join(TRACKED)} FROM day{n})"
    for n in (1, 2)
)


def _differs(left: str, right: str, columns: tuple[str, ...], null_safe: bool = False) -> str:
    operator = "IS DISTINCT FROM" if null_safe else "<>"
    return " OR ".join(f"{left}.{c} {operator} {right}.{c}" for c in columns)


def _list(alias: str, columns: tuple[str, ...]) -> str:
    return ", ".join(f"{alias}.{c}" for c in columns)


def _bootstrap(name: str, snapshot: str) -> str:
    return f"""
{name} AS (
  SELECT {_list('s', BUSINESS)}, DATE '{DAYS[0]}' AS start_date, DATE '9999-12-31' AS end_date,
    TRUE AS current_flag, {_epoch(0)} AS updated_epoch
  FROM {snapshot} s)"""


def _two_merges(before: str, after: str, snapshot: str, day: int, null_safe: bool = False) -> str:
    """CTEs that take history ``before`` to ``after``; ``after`` also names the clause that wrote a row."""
    today, now = f"DATE '{DAYS[day]}'", _epoch(day)
    history = "start_date, end_date, current_flag, updated_epoch"
    return f"""
{after}_merge1 AS (
  SELECT {_list('b', BUSINESS)}, b.start_date,
    CASE WHEN h.customer_id IS NOT NULL THEN {today} ELSE b.end_date END AS end_date,
    b.current_flag AND h.customer_id IS NULL AS current_flag,
    CASE WHEN h.customer_id IS NOT NULL THEN {now} ELSE b.updated_epoch END AS updated_epoch,
    CASE WHEN h.customer_id IS NOT NULL THEN 'close_changed' END AS clause
  FROM {before} b LEFT JOIN (
    SELECT b.customer_id FROM {before} b JOIN {snapshot} s ON s.customer_id = b.customer_id AND b.current_flag
    WHERE {_differs('s', 'b', TRACKED, null_safe)}) h ON h.customer_id = b.customer_id AND b.current_flag),
{after} AS (
  SELECT {', '.join(BUSINESS)}, {history}, clause FROM {after}_merge1 b
  WHERE NOT current_flag OR EXISTS (SELECT 1 FROM {snapshot} s WHERE s.customer_id = b.customer_id)
  UNION ALL
  SELECT {', '.join(BUSINESS)}, start_date, {today}, FALSE, {now}, 'close_missing' FROM {after}_merge1 b
  WHERE current_flag AND NOT EXISTS (SELECT 1 FROM {snapshot} s WHERE s.customer_id = b.customer_id)
  UNION ALL
  SELECT {_list('s', BUSINESS)}, {today}, DATE '9999-12-31', TRUE, {now}, 'insert' FROM {snapshot} s
  WHERE NOT EXISTS (SELECT 1 FROM {after}_merge1 b WHERE b.customer_id = s.customer_id AND b.current_flag))"""


def _conform(name: str, source: str, day: int) -> str:
    return f"""
{name} AS (
  SELECT customer_id AS id_cliente, strftime(signup_date,'%Y%m') AS ano_mes, first_name AS nome,
    last_name AS sobrenome, first_name || ' ' || last_name AS nome_completo, email, phone AS telefone,
    city AS cidade, upper(state) AS estado, signup_date AS data_entrada,
    last_purchase_date AS data_ultima_compra, total_spent AS total_gasto, is_active AS status,
    {_stamp(day)} AS data_atualizacao
  FROM {source})"""


def _mirror(target: str, source: str, after: str) -> str:
    keep = "coalesce(" + _differs("t", "s", SILVER_TRACKED) + ", FALSE)"
    return f"""
{after} AS (
  SELECT {_list('t', SILVER)}, 'keep' AS clause FROM {target} t JOIN {source} s USING (id_cliente) WHERE NOT {keep}
  UNION ALL
  SELECT {_list('s', SILVER)}, 'update' FROM {target} t JOIN {source} s USING (id_cliente) WHERE {keep}
  UNION ALL
  SELECT {_list('s', SILVER)}, 'insert' FROM {source} s
  WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE t.id_cliente = s.id_cliente)
  UNION ALL
  SELECT {_list('t', SILVER)}, 'delete' FROM {target} t
  WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.id_cliente = t.id_cliente))"""


GOLD_COLUMNS = SILVER[:-1]
ATTRIBUTES = ("nivel_cliente", "cliente_novo", "compra_recente", "dias_sem_comprar", "risco_churn")


def _gold(name: str, silver: str, day: int) -> str:
    entered = f"date_diff('day', data_entrada, DATE '{DAYS[day]}')"
    bought = f"date_diff('day', data_ultima_compra, DATE '{DAYS[day]}')"
    return f"""
{name} AS (
  SELECT {', '.join(GOLD_COLUMNS)},
    CASE WHEN total_gasto >= 10000 THEN 'Ouro' WHEN total_gasto >= 5000 THEN 'Prata'
      WHEN total_gasto >= 1000 THEN 'Bronze' ELSE 'Novo' END AS nivel_cliente,
    CASE WHEN {entered} <= 90 THEN TRUE ELSE FALSE END AS cliente_novo,
    CASE WHEN {bought} <= 15 THEN TRUE ELSE FALSE END AS compra_recente,
    CAST({bought} AS INTEGER) AS dias_sem_comprar,
    CASE WHEN {bought} > 180 THEN 'Alto' WHEN {bought} > 90 THEN 'Médio' ELSE 'Baixo' END AS risco_churn
  FROM {silver})"""


def _half(gold: str, order: str, label: str, day: int, only: str = "status") -> str:
    return f"""(
  SELECT id_cliente, nome_completo, total_gasto, status, nivel_cliente, dias_sem_comprar,
    '{label}' AS categoria, {_stamp(day)} AS data_hora_analise
  FROM {gold} WHERE {only} ORDER BY total_gasto {order}, id_cliente LIMIT 10)"""


def _top(gold: str, day: int) -> str:
    return _half(gold, "DESC NULLS LAST", "Melhores clientes", day)


def _bottom(gold: str, day: int, only: str = "status") -> str:
    return _half(gold, "ASC NULLS FIRST", "Clientes a serem trabalhados", day, only)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


HISTORY = ", ".join(BUSINESS) + ", start_date, end_date, current_flag, updated_epoch"
MIRRORED = ", ".join(SILVER)

_BRONZE1 = (RAW_DAYS, _bootstrap("bronze1", "day1"))
_BRONZE2 = (*_BRONZE1, _two_merges("bronze1", "bronze2", "day2", 1))
_REPLAYED = (*_BRONZE2, _two_merges("bronze2", "bronze3", "day1", 2))
_SILVER1 = (RAW_DAYS, _conform("silver1", "day1", 0))
_SILVER2 = (*_SILVER1, _conform("source2", "day2", 1), _mirror("silver1", "source2", "actions2"))
_GOLD1 = (*_SILVER1, _gold("gold1", "silver1", 0))
_BRONZE_CURRENT = tuple(
    f"\nlive{n} AS (SELECT {', '.join(BUSINESS)} FROM bronze{n} WHERE current_flag)" for n in (1, 2, 3)
)
_SILVER3 = (
    *_REPLAYED, *_BRONZE_CURRENT,
    _conform("silver1", "live1", 0),
    _conform("source2", "live2", 1), _mirror("silver1", "source2", "actions2"),
    f"\nsilver2 AS (SELECT {MIRRORED} FROM actions2 WHERE clause <> 'delete')",
    _conform("source3", "live3", 2), _mirror("silver2", "source3", "actions3"),
    f"\nsilver3 AS (SELECT {MIRRORED} FROM actions3 WHERE clause <> 'delete')",
)
_GOLD3 = (*_SILVER3, _gold("gold3", "silver3", 2))


def _history_clause(clause: str) -> str:
    return _with(*_BRONZE2) + f"SELECT {HISTORY} FROM bronze2 WHERE clause = '{clause}'"


def _mirror_clause(clause: str) -> str:
    return _with(*_SILVER2) + f"SELECT {MIRRORED} FROM actions2 WHERE clause = '{clause}'"


def _changed(null_safe: bool) -> str:
    return _with(RAW_DAYS) + (
        "SELECT a.customer_id FROM day1 a JOIN day2 b ON a.customer_id = b.customer_id "
        f"WHERE {_differs('a', 'b', TRACKED, null_safe)}"
    )


def _attribute(name: str) -> str:
    return _with(*_GOLD1) + f"SELECT id_cliente, {name} FROM gold1"


_STORED_BRONZE = _with(*_REPLAYED) + f"SELECT {HISTORY} FROM bronze3"
_STORED_SILVER = _with(*_SILVER3) + f"SELECT {MIRRORED} FROM silver3"

ORACLE: dict[str, str] = {
    "raw_snapshot": _with(RAW_DAYS) + "SELECT * FROM day1",
    "key_violations": """
        SELECT customer_id, count(*) AS n_rows
        FROM (SELECT CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS customer_id FROM orders)
        GROUP BY customer_id HAVING count(*) > 1 OR customer_id IS NULL""",
    "bronze_bootstrap": _with(*_BRONZE1) + f"SELECT {HISTORY} FROM bronze1",
    "current_versions": _with(*_BRONZE2) + f"SELECT {HISTORY} FROM bronze2 WHERE current_flag",
    "changed_keys_sql_nulls": _changed(null_safe=False),
    "changed_keys_null_safe": _changed(null_safe=True),
    "silver_changed_keys": _with(*_SILVER2) + "SELECT id_cliente FROM actions2 WHERE clause = 'update'",
    "scd2_close_changed": _history_clause("close_changed"),
    "scd2_new_versions": _history_clause("insert"),
    "scd2_close_missing": _history_clause("close_missing"),
    "scd2_merge": _with(*_BRONZE2) + f"SELECT {HISTORY} FROM bronze2",
    "scd2_merge_null_safe": _with(*_BRONZE1, _two_merges("bronze1", "bronze2", "day2", 1, null_safe=True))
    + f"SELECT {HISTORY} FROM bronze2",
    "scd2_null_keys": _with(
        RAW_DAYS, KEYLESS_DAYS, _bootstrap("bronze1", "keyless1"), _two_merges("bronze1", "bronze2", "keyless2", 1)
    )
    + f"SELECT {HISTORY} FROM bronze2",
    "scd2_replay": _STORED_BRONZE,
    "scd2_idempotent": _with(*_BRONZE2, _two_merges("bronze2", "bronze3", "day2", 2)) + f"SELECT {HISTORY} FROM bronze3",
    "silver_conform": _with(*_SILVER1) + f"SELECT {MIRRORED} FROM silver1",
    "scd1_update": _mirror_clause("update"),
    "scd1_insert": _mirror_clause("insert"),
    "scd1_delete": _mirror_clause("delete"),
    "scd1_mirror": _with(*_SILVER2) + f"SELECT {MIRRORED} FROM actions2 WHERE clause <> 'delete'",
    "scd1_null_keys": _with(
        RAW_DAYS, KEYLESS_DAYS, _conform("silver1", "keyless1", 0), _conform("source2", "keyless2", 1),
        _mirror("silver1", "source2", "actions2"),
    )
    + f"SELECT {MIRRORED} FROM actions2 WHERE clause <> 'delete'",
    "customer_tier": _attribute("nivel_cliente"),
    "new_customer_flag": _attribute("cliente_novo"),
    "recent_purchase_flag": _attribute("compra_recente"),
    "days_since_purchase": _attribute("dias_sem_comprar"),
    "churn_risk": _attribute("risco_churn"),
    "gold_enriched": _with(*_GOLD1) + "SELECT * FROM gold1",
    "gold_new_columns": _with(*_GOLD1) + f"""
        SELECT {', '.join(c for c in GOLD_COLUMNS if c != 'cidade')}, CAST(NULL AS VARCHAR) AS cidade,
          {', '.join(ATTRIBUTES)} FROM gold1""",
    "top_spenders": _with(*_GOLD1) + "SELECT * FROM " + _top("gold1", 0),
    "bottom_spenders": _with(*_GOLD1) + "SELECT * FROM " + _bottom("gold1", 0),
    "bottom_known_spenders": _with(*_GOLD1)
    + "SELECT * FROM " + _bottom("gold1", 0, only="status AND total_gasto IS NOT NULL"),
    "spender_ranking": _with(*_GOLD1) + "SELECT * FROM " + _top("gold1", 0) + " UNION ALL SELECT * FROM " + _bottom("gold1", 0),
    "stored_bronze": _STORED_BRONZE,
    "stored_bronze_bucketed": _STORED_BRONZE,
    "stored_silver": _STORED_SILVER,
    "stored_silver_bucketed": _STORED_SILVER,
    "stored_gold": _with(*_GOLD3) + "SELECT * FROM gold3",
    "served_gold": _with(*_GOLD1) + "SELECT * FROM gold1",
    "end_to_end": _with(*_GOLD3) + "SELECT * FROM " + _top("gold3", 2) + " UNION ALL SELECT * FROM " + _bottom("gold3", 2),
}
