"""Stand-in inputs derived from the driver's tables.

The reference's own inputs (payment seeds, game events, goods/sales, users
and transactions, agreements, occupations) are not available at scale, so
each report runs on a deterministic derivation of the TPC-H-like tables.
Every derivation is a Spark plan over the whole table, so the work grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.session import read_table

# --- fixed values of the stand-ins (mirrored by the oracle SQL) --------------
# Spellings rotate by key so that every accepted seed spelling is exercised.
STATUS_SPELLINGS = ["TRUE", "true", " T", "1", "Yes"]
CVV_SPELLINGS = ["yes", "N", "0", "true", "maybe"]
# Currency by order priority.
CURRENCY_BY_PRIORITY = {
    "1-URGENT": "usd",
    "2-HIGH": "EUR",
    "3-MEDIUM": " gbp",
    "4-NOT SPECIFIED": "JPY",
    "5-LOW": "BRL",
}
# Rates (units per USD) by day of month: day 1 carries broken JSON, day 15 a
# non-numeric EUR rate; JPY is zero and BRL missing on every day.
RATES_BROKEN = '{"EUR": 0.9, "GBP": 0.8'
RATES_BAD_EUR = '{"EUR": "n/a", "GBP": 0.8, "JPY": 0, "USD": 1}'
RATES_NORMAL = '{"EUR": 0.9, "GBP": 0.8, "JPY": 0, "USD": 1}'
# ------------------------------------------------------------------------------


def _rotate(values, key_col) -> F.Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(key_col, F.lit(len(values))) + 1).cast("int"))


def acceptance_seed(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Acceptance report as text columns, one row per order.

    accepted ⇔ o_orderstatus = 'F'; country = the customer's nation.
    """
    o = orders if orders is not None else read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cur = F.lit(None).cast("string")
    for k, v in CURRENCY_BY_PRIORITY.items():
        cur = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(cur)
    dom = F.dayofmonth("o_orderdate")
    rates = (F.when(dom == 1, F.lit(RATES_BROKEN))
             .when(dom == 15, F.lit(RATES_BAD_EUR)).otherwise(F.lit(RATES_NORMAL)))
    state = (F.when(F.col("o_orderstatus") == "F", F.lit("ACCEPTED"))
             .when(F.col("o_orderstatus") == "O", F.lit(" declined"))
             .otherwise(F.lit("Declined ")))
    return (o.join(c, o.o_custkey == c.c_custkey, "left")
            .join(n, F.col("c_nationkey") == n.n_nationkey, "left")
            .select(
                F.col("o_orderkey").cast("string").alias("external_ref"),
                _rotate(STATUS_SPELLINGS, F.col("o_custkey")).alias("status"),
                F.lit("orders").alias("source"),
                F.concat(F.lit("evt-"), F.col("o_orderkey").cast("string")).alias("ref"),
                F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
                state.alias("state"),
                _rotate(CVV_SPELLINGS, F.col("o_orderkey")).alias("cvv_provided"),
                F.col("o_totalprice").cast("string").alias("amount"),
                F.lower("n_name").alias("country"),
                cur.alias("currency"),
                rates.alias("rates"),
            ))


def chargeback_seed(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Chargeback report as text, one row per order that has line items:
    'true' if any line was returned ('R'), 'FALSE' if any was accepted
    ('A'), else 'unknown' (→ NULL flag → missing chargeback)."""
    li = lineitem if lineitem is not None else read_table(spark, sf_dir, "lineitem")
    g = (li.groupBy(F.col("l_orderkey").cast("string").alias("external_ref"))
         .agg(F.bool_or(F.col("l_returnflag") == "R").alias("_r"),
              F.bool_or(F.col("l_returnflag") == "A").alias("_a")))
    return g.select(
        "external_ref",
        F.lit("TRUE").alias("status"),
        F.lit("lineitem").alias("source"),
        F.when(F.col("_r"), F.lit("true")).when(F.col("_a"), F.lit("FALSE"))
        .otherwise(F.lit("unknown")).alias("chargeback"),
    )


# Oracle (DuckDB) form of the two cleaned seeds and the full-build fact.
PAYMENT_FACT_CTE = """
acc AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id,
         true AS report_status,
         'evt-' || CAST(o.o_orderkey AS VARCHAR) AS provider_event_id,
         CAST(o.o_orderdate AS TIMESTAMP) AS transaction_at,
         CAST(o.o_orderdate AS DATE) AS transaction_date,
         CASE WHEN o.o_orderstatus = 'F' THEN 'ACCEPTED' ELSE 'DECLINED' END AS transaction_state,
         o.o_totalprice AS amount,
         upper(n.n_name) AS country_code,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'USD' WHEN '2-HIGH' THEN 'EUR'
              WHEN '3-MEDIUM' THEN 'GBP' WHEN '4-NOT SPECIFIED' THEN 'JPY' ELSE 'BRL' END AS currency_code,
         CASE WHEN dayofmonth(o.o_orderdate) = 1 THEN NULL
              WHEN dayofmonth(o.o_orderdate) = 15 THEN '{"EUR": "n/a", "GBP": 0.8, "JPY": 0, "USD": 1}'
              ELSE '{"EUR": 0.9, "GBP": 0.8, "JPY": 0, "USD": 1}' END AS rates_json
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
acc2 AS (
  SELECT *, json_extract_string(rates_json, '$.' || currency_code) AS rate_text FROM acc
),
acc3 AS (
  SELECT *,
         CASE WHEN currency_code = 'USD' THEN amount
              WHEN rates_json IS NULL OR rate_text IS NULL THEN NULL
              WHEN TRY_CAST(rate_text AS DOUBLE) = 0 THEN NULL
              ELSE amount / TRY_CAST(rate_text AS DOUBLE) END AS amount_usd
  FROM acc2
),
cb AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CASE WHEN bool_or(l_returnflag = 'R') THEN true
              WHEN bool_or(l_returnflag = 'A') THEN false ELSE NULL END AS has_chargeback
  FROM lineitem GROUP BY 1
),
fact AS (
  SELECT a.transaction_id, a.provider_event_id, a.transaction_at, a.transaction_date,
         a.transaction_state,
         a.transaction_state = 'ACCEPTED' AS is_accepted,
         a.transaction_state = 'DECLINED' AS is_declined,
         a.country_code, a.currency_code, a.amount, a.amount_usd, c.has_chargeback,
         (c.transaction_id IS NULL OR c.has_chargeback IS NULL) AS is_missing_chargeback,
         TIMESTAMP '{run_ts}' AS dw_modified_at
  FROM acc3 a LEFT JOIN cb c ON a.transaction_id = c.transaction_id
)
"""


# --- game events (stand-in of the repaired event table) ----------------------
# fixed values of this stand-in (mirrored by GAME_EVENTS_CTE)
GAME_CURRENCIES = ["EUR", "USD", "GBP", ""]     # by k mod 4 for paid events
GAME_CONSTANTS = {"client_version": "2.0.1", "event_name": "login",
                  "server_version": "5.4", "user_device_country": "DE",
                  "user_server_region": "EU", "user_type": "PLAYER"}
PAID_ABOVE = 100.0


def game_events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with amounts as text (comma decimals for odd k), the way a
    repaired raw event file looks before typing."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    paid = F.col("value") > F.lit(PAID_ABOVE)
    vtext = F.col("value").cast("string")
    amount_text = F.when(paid, F.when(F.pmod(k, F.lit(2)) == 1, F.regexp_replace(vtext, r"\.", ","))
                         .otherwise(vtext))
    uid = F.col("user_id")
    return e.select(
        "event_id",
        F.when(k == 0, F.lit(None)).otherwise(F.col("ts")).alias("event_timestamp"),
        F.upper("event_type").alias("platform"),
        F.when(uid == 0, F.lit(None)).otherwise(uid.cast("string")).alias("user_id"),
        F.concat(F.lit("p"), uid.cast("string")).alias("player_name"),
        F.concat_ws(".", F.lit("10.0"), F.pmod(uid, F.lit(256)).cast("string"),
                    F.floor(uid / 256).cast("string")).alias("user_ip"),
        F.when(k == 1, F.lit(None)).otherwise(F.col("event_id").cast("string")).alias("session_id"),
        F.when(paid, _rotate(GAME_CURRENCIES, k)).alias("real_currency_type"),
        amount_text.alias("real_currency_amount"),
        F.when(F.col("value") > 300, F.lit("coins_large"))
        .when(F.col("value") > 200, F.lit("coins_medium"))
        .when(paid, F.lit("coins_small")).alias("product_name"),
        F.lit(False).alias("is_premium"),
        *[F.lit(v).alias(c) for c, v in GAME_CONSTANTS.items()],
    )


def game_events(spark: SparkSession, sf_dir: str, with_spender: bool = False) -> DataFrame:
    """Typed game events: amounts in cents, USD cost; with ``with_spender``
    also the per-user spender flag (an extra aggregate and join, so only
    the reports that use it ask for it)."""
    from wharf.functions.columns import cents
    t = game_events_text(spark, sf_dir)
    base = (t.withColumn("real_currency_amount_centum", cents("real_currency_amount"))
            .drop("real_currency_amount"))
    base = base.withColumn(
        "usd_cost_centum",
        F.when(F.col("real_currency_type") == "GBP",
               F.floor(F.col("real_currency_amount_centum") / 100).cast("bigint"))
        .otherwise(F.col("real_currency_amount_centum")))
    return with_spender_flag(base) if with_spender else base


def with_spender_flag(ev: DataFrame, user: str = "user_id",
                      amount: str = "real_currency_amount_centum") -> DataFrame:
    """``user_is_spender``: the user paid at least once. Per-user aggregate
    joined back null-safely (NULL users form one group, as in SQL), rather
    than a window whose hot user would sit in one task."""
    sp = ev.groupBy(F.col(user).alias("_u")).agg(F.bool_or(F.col(amount) > 0).alias("user_is_spender"))
    return ev.join(sp, ev[user].eqNullSafe(sp["_u"]), "inner").drop("_u")


GAME_EVENTS_CTE = """
ge0 AS (
  SELECT event_id, ts, user_id AS uid, event_type, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
ge1 AS (
  SELECT event_id,
         CASE WHEN k = 0 THEN NULL ELSE ts END AS event_timestamp,
         upper(event_type) AS platform,
         CASE WHEN uid = 0 THEN NULL ELSE CAST(uid AS VARCHAR) END AS user_id,
         'p' || CAST(uid AS VARCHAR) AS player_name,
         '10.0.' || CAST(uid % 256 AS VARCHAR) || '.' || CAST(uid // 256 AS VARCHAR) AS user_ip,
         CASE WHEN k = 1 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS session_id,
         CASE WHEN value > 100 THEN ['EUR', 'USD', 'GBP', ''][k % 4 + 1] END AS real_currency_type,
         CASE WHEN value > 100 THEN CAST(round(value * 100) AS BIGINT) ELSE 0 END
           AS real_currency_amount_centum,
         CASE WHEN value > 300 THEN 'coins_large' WHEN value > 200 THEN 'coins_medium'
              WHEN value > 100 THEN 'coins_small' END AS product_name,
         false AS is_premium, '2.0.1' AS client_version, 'login' AS event_name,
         '5.4' AS server_version, 'DE' AS user_device_country, 'EU' AS user_server_region,
         'PLAYER' AS user_type
  FROM ge0),
ge2 AS (
  SELECT *, CASE WHEN real_currency_type = 'GBP' THEN real_currency_amount_centum // 100
                 ELSE real_currency_amount_centum END AS usd_cost_centum
  FROM ge1),
ge AS (
  SELECT g.*, s.user_is_spender
  FROM ge2 g JOIN (SELECT user_id, bool_or(real_currency_amount_centum > 0) AS user_is_spender
                   FROM ge2 GROUP BY user_id) s
    ON g.user_id IS NOT DISTINCT FROM s.user_id),
gp AS (
  SELECT *, CASE WHEN real_currency_amount_centum > 0 THEN 1 ELSE 0 END AS paid_session FROM ge)
"""
