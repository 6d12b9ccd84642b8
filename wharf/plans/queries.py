"""Registered queries over the driver's tables (stand-ins of SURVEY §7.3).

Each function reads whole tables from ``sf_dir``; the SQL beside it is the
DuckDB oracle over the same tables. Column names match on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wharf.plans import payments as pay
from wharf.plans import standins as si
from wharf.plans.registry import query

# --- fixed values of the registered queries ---------------------------------
RUN_TS = "2024-02-01 06:00:00"        # pinned load time of the payment model
# ------------------------------------------------------------------------------


def payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full build of the payment fact from the stand-in seeds (ids are unique
    by construction: one seed row per order, chargebacks grouped by order)."""
    acc = pay.stage(pay.clean_acceptance(si.acceptance_seed(spark, sf_dir)), RUN_TS,
                    check_unique=False)
    cb = pay.stage(pay.clean_chargeback(si.chargeback_seed(spark, sf_dir)), RUN_TS,
                   check_unique=False)
    return pay.build_fact(acc, cb, RUN_TS)


def _with_fact(select_sql: str) -> str:
    return "WITH " + si.PAYMENT_FACT_CTE.replace("{run_ts}", RUN_TS) + select_sql


_DAILY_SQL = _with_fact("""
SELECT transaction_date,
       CAST(count_if(is_accepted) AS BIGINT) AS accepted_count,
       CAST(count(*) AS BIGINT) AS total_count,
       CAST(count_if(is_accepted) AS DOUBLE) / nullif(CAST(count(*) AS DOUBLE), 0) AS acceptance_rate,
       max(dw_modified_at) AS dw_modified_at
FROM fact GROUP BY transaction_date
""")


@query("acceptance_daily", sql=_DAILY_SQL, covers=(
    "A16", "J4", "P1", "P10", "P12", "P13", "F2", "F4", "F5", "F14", "F17", "F18", "F24",
    "I4", "I9", "I10"))
def q_acceptance_daily(spark, sf_dir):
    return pay.acceptance_daily(payment_fact(spark, sf_dir))


@query("acceptance_monthly", covers=("A18", "F16"), sql=_with_fact("""
, daily AS (
  SELECT transaction_date, count_if(is_accepted) AS accepted_count, count(*) AS total_count
  FROM fact GROUP BY transaction_date)
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS transaction_month,
       CAST(sum(accepted_count) AS BIGINT) AS accepted_count,
       CAST(sum(total_count) AS BIGINT) AS total_count,
       CAST(sum(accepted_count) AS DOUBLE) / nullif(CAST(sum(total_count) AS DOUBLE), 0) AS acceptance_rate
FROM daily GROUP BY 1
"""))
def q_acceptance_monthly(spark, sf_dir):
    return pay.acceptance_monthly(pay.acceptance_daily(payment_fact(spark, sf_dir)))


@query("declined_by_country", covers=("A17", "P11"), sql=_with_fact("""
SELECT country_code,
       CAST(count(*) AS BIGINT) AS declined_transaction_count,
       CAST(round(sum(CAST(amount_usd AS DECIMAL(38, 10))), 6) AS DOUBLE) AS declined_amount_usd,
       max(dw_modified_at) AS dw_modified_at
FROM fact WHERE is_declined GROUP BY country_code
HAVING round(sum(CAST(amount_usd AS DECIMAL(38, 10))), 6) > 25000000
"""))
def q_declined_by_country(spark, sf_dir):
    return pay.declined_by_country(payment_fact(spark, sf_dir))


@query("missing_chargeback", covers=("P10", "P11", "J4"), sql=_with_fact("""
SELECT transaction_id, provider_event_id, transaction_at, transaction_state, country_code,
       currency_code, amount_usd, has_chargeback, is_missing_chargeback, dw_modified_at
FROM fact WHERE is_missing_chargeback
"""))
def q_missing_chargeback(spark, sf_dir):
    return pay.missing_chargeback(payment_fact(spark, sf_dir))


@query("fx_usd", covers=("P12", "P13", "F6", "F17"), sql=_with_fact("""
SELECT transaction_id, currency_code, amount, amount_usd FROM acc3
"""))
def q_fx_usd(spark, sf_dir):
    acc = pay.clean_acceptance(si.acceptance_seed(spark, sf_dir))
    return acc.select("transaction_id", "currency_code", "amount", "amount_usd")


# Other query families register themselves on import.
from wharf.plans import game_kpis  # noqa: E402,F401
from wharf.plans import reports  # noqa: E402,F401
from wharf.plans import ingest  # noqa: E402,F401
from wharf.plans import loads  # noqa: E402,F401


@query("acceptance_daily_sql", sql=_DAILY_SQL, covers=("S14", "A16", "F24"))
def q_acceptance_daily_sql(spark, sf_dir):
    """The daily report as Spark SQL over a temporary view of the fact."""
    from wharf.sources.tables import register_view
    register_view(payment_fact(spark, sf_dir), "fct_payments")
    return spark.sql("""
        WITH per_day AS (
          SELECT transaction_date AS day, sum(if(is_accepted, 1, 0)) AS good, sum(1) AS n, max(dw_modified_at) AS newest
          FROM fct_payments GROUP BY ALL)
        SELECT day AS transaction_date, good AS accepted_count, n AS total_count, good / n AS acceptance_rate,
               newest AS dw_modified_at
        FROM per_day""")
