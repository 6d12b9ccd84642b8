"""KPI reports over the game-event stand-in (profile, frequencies,
conversions, revenue, control totals)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wharf.functions.columns import null_safe_text, paid_flag
from wharf.operators import aggregates as agg
from wharf.plans import standins as si
from wharf.plans.registry import query
from wharf.session import work_dir

PROFILE_COLS = ["client_version", "event_name", "is_premium", "platform", "player_name",
                "product_name", "server_version", "real_currency_type", "session_id",
                "user_device_country", "user_id", "user_ip", "user_is_spender",
                "user_server_region", "user_type"]


def _sql(body: str) -> str:
    return "WITH " + si.GAME_EVENTS_CTE + body


def paid_events(spark, sf_dir):
    return si.game_events(spark, sf_dir).withColumn(
        "paid_session", paid_flag("real_currency_amount_centum"))


_PROFILE_SQL = ",\n".join(
    f"CAST(count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'NULL')) AS BIGINT) AS {c}_distinct_count"
    for c in PROFILE_COLS)


@query("kpi_profile", covers=("A1", "F1"), sql=_sql(f"""
SELECT CAST(count(*) AS BIGINT) AS rows_count,
{_PROFILE_SQL}
FROM ge
"""))
def q_profile(spark, sf_dir):
    return agg.profile(si.game_events(spark, sf_dir, with_spender=True), PROFILE_COLS)


@query("kpi_constant_columns", covers=("A2",), sql=_sql("""
, prof AS (SELECT """ + _PROFILE_SQL + """ FROM ge)
SELECT column_name FROM (
  UNPIVOT prof ON COLUMNS(*) INTO NAME column_name VALUE distinct_count)
WHERE distinct_count = 1
""").replace("SELECT column_name FROM (\n  UNPIVOT", "SELECT replace(column_name, '_distinct_count', '') AS column_name FROM (\n  UNPIVOT"))
def q_constant_columns(spark, sf_dir):
    return agg.constant_columns(agg.profile(si.game_events(spark, sf_dir, with_spender=True),
                                            PROFILE_COLS))


SKETCHED_COLS = ["session_id", "user_id", "user_ip", "player_name", "platform"]


@query("kpi_profile_sketches", stateful=True, covers=("A1",), sql=_sql("""
, counts AS (SELECT """ + ",\n".join(
    f"CAST(count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'NULL')) AS BIGINT) AS {c}" for c in SKETCHED_COLS) + """ FROM ge),
n AS (SELECT CAST(count(*) AS BIGINT) AS rows_count,
             CAST(count(DISTINCT coalesce(CAST(event_timestamp AS DATE), DATE '1900-01-01')) AS BIGINT) AS days FROM ge)
SELECT column_name, exact_count, rows_count, days, true AS within_bound
FROM (UNPIVOT counts ON COLUMNS(*) INTO NAME column_name VALUE exact_count), n
"""))
def q_profile_sketches(spark, sf_dir):
    """Distinct counts of the whole span from one stored sketch a day, held against the exact ones:
    within three standard errors (2.5 %)."""
    events = si.game_events(spark, sf_dir).select("event_timestamp", *SKETCHED_COLS)
    path = work_dir(spark, "sketches")
    agg.daily_sketches(events, F.to_date("event_timestamp"), SKETCHED_COLS).write.parquet(path)
    estimate = agg.profile_of_sketches(spark.read.parquet(path), SKETCHED_COLS)
    exact = agg.profile(events, SKETCHED_COLS).withColumn("days", F.lit(0))

    def long(df, value):
        pairs = ", ".join(f"'{c}', CAST(`{c}_distinct_count` AS BIGINT)" for c in SKETCHED_COLS)
        return df.selectExpr("rows_count", "days", f"stack({len(SKETCHED_COLS)}, {pairs}) AS (column_name, {value})")

    both = long(estimate, "estimate").join(long(exact, "exact_count").drop("rows_count", "days"), "column_name")
    off = F.abs(F.col("estimate") - F.col("exact_count"))
    return both.select("column_name", "exact_count", "rows_count", "days",
                       (off <= 3 * agg.SKETCH_ERROR * F.col("exact_count")).alias("within_bound"))


@query("kpi_product_frequency", covers=("A3", "O1"), sql=_sql("""
SELECT product_name, CAST(count(*) AS BIGINT) AS cnt FROM ge GROUP BY product_name
"""))
def q_product_frequency(spark, sf_dir):
    return agg.frequency(si.game_events(spark, sf_dir), "product_name")


@query("kpi_currency", covers=("A4", "F1"), sql=_sql("""
SELECT coalesce(real_currency_type, 'NULL') AS real_currency_type, CAST(count(*) AS BIGINT) AS cnt,
       CAST(sum(real_currency_amount_centum) AS BIGINT) AS real_currency_amount_centum_sum
FROM ge GROUP BY 1
"""))
def q_currency(spark, sf_dir):
    return agg.frequency(si.game_events(spark, sf_dir), "real_currency_type", null_as_text=True,
                         sum_col="real_currency_amount_centum")


@query("kpi_amounts_differ", covers=("P4", "C8"), sql=_sql("""
SELECT event_id, real_currency_type, real_currency_amount_centum, usd_cost_centum
FROM ge WHERE real_currency_amount_centum != usd_cost_centum
"""))
def q_amounts_differ(spark, sf_dir):
    ev = si.game_events(spark, sf_dir)
    return (ev.where(F.col("real_currency_amount_centum") != F.col("usd_cost_centum"))
            .select("event_id", "real_currency_type", "real_currency_amount_centum",
                    "usd_cost_centum"))


@query("kpi_multi_platform_users", covers=("A5",), sql=_sql("""
SELECT user_id, CAST(count(DISTINCT platform) AS BIGINT) AS platforms_cnt
FROM ge GROUP BY user_id HAVING count(DISTINCT platform) > 1
"""))
def q_multi_platform(spark, sf_dir):
    return agg.keys_with_many(si.game_events(spark, sf_dir), "user_id", "platform")


@query("kpi_user_footprint", covers=("A6",), sql=_sql("""
SELECT platform, user_id, user_is_spender,
       CAST(count(DISTINCT user_ip) AS BIGINT) AS distinct_user_ip,
       CAST(count(DISTINCT session_id) AS BIGINT) AS distinct_session_id
FROM ge GROUP BY platform, user_id, user_is_spender
"""))
def q_user_footprint(spark, sf_dir):
    return agg.distinct_counts(si.game_events(spark, sf_dir, with_spender=True),
                               ["platform", "user_id", "user_is_spender"], ["user_ip", "session_id"]) \
        .orderBy(F.desc("distinct_user_ip"), F.desc("distinct_session_id"))


@query("kpi_paid_by_platform", covers=("A7", "P3", "F21"), sql=_sql("""
SELECT coalesce(platform, 'NULL') AS platform, CAST(count(*) AS BIGINT) AS sessions_cnt,
       CAST(sum(paid_session) AS BIGINT) AS paid_session,
       CAST(sum(paid_session) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS paid_sessions_conversion
FROM gp GROUP BY 1
"""))
def q_paid_by_platform(spark, sf_dir):
    return agg.paid_conversion(paid_events(spark, sf_dir), [null_safe_text("platform").alias("platform")]) \
        .orderBy(F.desc("paid_sessions_conversion"))


@query("kpi_spender_conversion", covers=("A8",), sql=_sql("""
, d AS (SELECT platform, user_id, user_is_spender FROM ge GROUP BY 1, 2, 3)
SELECT platform, CAST(count(DISTINCT user_id) AS BIGINT) AS user_id_count,
       CAST(sum(CAST(user_is_spender AS INTEGER)) AS BIGINT) AS spender_users_count,
       CAST(sum(CAST(user_is_spender AS INTEGER)) AS DOUBLE)
         / nullif(CAST(count(DISTINCT user_id) AS DOUBLE), 0) AS spender_users_conversion
FROM d GROUP BY platform
"""))
def q_spender_conversion(spark, sf_dir):
    return agg.spender_conversion(si.game_events(spark, sf_dir, with_spender=True),
                                  "platform", "user_id", "user_is_spender") \
        .orderBy(F.desc("spender_users_conversion"))


@query("kpi_revenue", covers=("A10",), sql=_sql("""
SELECT coalesce(real_currency_type, 'NULL') AS real_currency_type,
       coalesce(platform, 'NULL') AS platform,
       CAST(count(*) AS BIGINT) AS cnt,
       CAST(sum(real_currency_amount_centum) AS DOUBLE) / 100.0 AS sum_amount,
       CAST(max(real_currency_amount_centum) AS DOUBLE) / 100.0 AS max_amount,
       CAST(min(real_currency_amount_centum) AS DOUBLE) / 100.0 AS min_amount,
       CAST(sum(real_currency_amount_centum) AS DOUBLE)
         / CAST(count(real_currency_amount_centum) AS DOUBLE) / 100.0 AS avg_amount
FROM ge GROUP BY 1, 2
"""))
def q_revenue(spark, sf_dir):
    return agg.revenue_by(si.game_events(spark, sf_dir), ["real_currency_type", "platform"],
                          "real_currency_amount_centum") \
        .orderBy("real_currency_type", F.desc("sum_amount"))


@query("kpi_paid_by_month", covers=("A11", "F12"), sql=_sql("""
SELECT strftime(event_timestamp, '%Y') AS session_year, strftime(event_timestamp, '%m') AS session_month,
       coalesce(platform, 'NULL') AS platform, CAST(count(*) AS BIGINT) AS sessions_cnt,
       CAST(sum(paid_session) AS BIGINT) AS paid_session,
       CAST(sum(paid_session) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS paid_sessions_conversion
FROM gp GROUP BY 1, 2, 3
"""))
def q_paid_by_month(spark, sf_dir):
    return agg.paid_conversion(paid_events(spark, sf_dir), [
        F.date_format("event_timestamp", "yyyy").alias("session_year"),
        F.date_format("event_timestamp", "MM").alias("session_month"),
        null_safe_text("platform").alias("platform")]) \
        .orderBy("platform", F.col("session_year").asc_nulls_first(), F.col("session_month").asc_nulls_first())


@query("kpi_paid_by_hour", covers=("A12", "F12"), sql=_sql("""
SELECT strftime(event_timestamp, '%H') AS session_hour, CAST(count(*) AS BIGINT) AS sessions_cnt,
       CAST(sum(paid_session) AS BIGINT) AS paid_session,
       CAST(sum(paid_session) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS paid_sessions_conversion
FROM gp GROUP BY 1
"""))
def q_paid_by_hour(spark, sf_dir):
    return agg.paid_conversion(paid_events(spark, sf_dir),
                               [F.date_format("event_timestamp", "HH").alias("session_hour")]) \
        .orderBy(F.col("session_hour").asc_nulls_first())


@query("kpi_control_totals", covers=("A19", "C6"), sql=_sql("""
SELECT CAST(count(*) AS BIGINT) AS rows_count,
       CAST(sum(real_currency_amount_centum) AS BIGINT) AS real_currency_amount_centum_sum,
       CAST(sum(usd_cost_centum) AS BIGINT) AS usd_cost_centum_sum
FROM ge
"""))
def q_control_totals(spark, sf_dir):
    return agg.control_totals(si.game_events(spark, sf_dir),
                              ["real_currency_amount_centum", "usd_cost_centum"])
