"""Goods/sales, transactions, agreements and occupations reports over
stand-ins of the driver's tables. Each oracle SQL is an independent
formulation of the same result (date-range FILTER aggregates, a range join
to a VALUES table, a self join, a tuple comparison with the previous
version), so it checks the Spark
plans rather than repeating them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wharf.functions.columns import (count_sentence, is_text_false, is_text_true, name_initial,
                                     week_bucket)
from wharf.operators import aggregates as agg
from wharf.operators import windows as win
from wharf.operators.pivot import pivot_days
from wharf.plans.registry import query
from wharf.session import read_table

# --- fixed values of these reports --------------------------------------------
AS_OF = "1998-08-15"                         # pinned report date (period totals)
WEEK_EDGES = [("2024-01-01", "2024-01-08"), ("2024-01-09", "2024-01-15"),
              ("2024-01-16", "2024-01-22"), ("2024-01-23", "2024-01-31")]
PIVOT_BEGIN, PIVOT_END = "2024-01-28", "2024-01-31"
# --------------------------------------------------------------------------------


def cents_of(c):
    return F.floor(F.col(c) * 100 + 0.5).cast("bigint")


def goods_sales(spark, sf_dir):
    """goods = part (id, good_name); sales = lineitem (id_good, s_date, cents)."""
    goods = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("good_name"))
    sales = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("id_good"), F.col("l_shipdate").alias("s_date"),
        cents_of("l_extendedprice").alias("amount_cents"))
    return goods, sales


_PERIOD_RANGES = [("YTD", "1998-01-01", "1998-08-15"), ("MTD", "1998-08-01", "1998-08-15"),
                  ("QTD", "1998-07-01", "1998-08-15"), ("PYTD", "1997-01-01", "1997-08-15"),
                  ("PMTD", "1997-08-01", "1997-08-15"), ("PQTD", "1997-07-01", "1997-08-15")]
# oracle: each period as an explicit date range, FILTER aggregates, left join
_PERIOD_SQL = """
WITH s AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS d,
                  CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS c FROM lineitem),
t AS (SELECT l_partkey,
""" + ",\n".join(f"  sum(c) FILTER (WHERE d BETWEEN DATE '{lo}' AND DATE '{hi}') AS {n}"
                 for n, lo, hi in _PERIOD_RANGES) + """
      FROM s GROUP BY l_partkey)
SELECT DISTINCT p.p_name AS good_name,
""" + ",\n".join(f"  coalesce(t.{n}, 0) / 100.0 AS {n}" for n, _, _ in _PERIOD_RANGES) + """
FROM part p LEFT JOIN t ON t.l_partkey = p.p_partkey
"""


@query("period_totals", sql=_PERIOD_SQL, covers=("A9", "J7", "P5", "P7", "F1", "F13", "F15"))
def q_period_totals(spark, sf_dir):
    goods, sales = goods_sales(spark, sf_dir)
    return agg.period_totals(goods, sales, AS_OF)


def docs_standin(spark, sf_dir):
    """docs = events (id, id_good = user, s_date, amount, rate = props.k)."""
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("id_good"),
        F.col("ts").alias("s_date"), F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").try_cast("int").alias("rate"))


@query("top1_week", covers=("W1", "P8", "J2", "P6", "F23"), sql="""
WITH wk(WeekNum, lo, hi) AS (VALUES (1, DATE '2024-01-01', DATE '2024-01-08'),
                                    (2, DATE '2024-01-09', DATE '2024-01-15'),
                                    (3, DATE '2024-01-16', DATE '2024-01-22'),
                                    (4, DATE '2024-01-23', DATE '2024-01-31')),
d AS (SELECT e.event_id, e.user_id, e.ts, e.value,
             TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, w.WeekNum
      FROM events e JOIN wk w ON CAST(e.ts AS DATE) BETWEEN w.lo AND w.hi),
best AS (SELECT * FROM d
         QUALIFY row_number() OVER (PARTITION BY WeekNum, user_id
                                    ORDER BY CAST(ts AS DATE) DESC, k, ts DESC, event_id) = 1)
SELECT b.WeekNum, b.event_id AS id, c.c_name AS good_name, n.n_name AS good_group_name,
       b.ts AS s_date, b.value AS amount, b.k AS rate
FROM best b JOIN customer c ON c.c_custkey = b.user_id JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q_top1_week(spark, sf_dir):
    docs = docs_standin(spark, sf_dir)
    docs = docs.where((F.col("s_date") >= F.lit("2024-01-01").cast("timestamp_ntz"))
                      & (F.col("s_date") < F.lit("2024-02-01").cast("timestamp_ntz")))
    docs = docs.withColumn("WeekNum", week_bucket("s_date", WEEK_EDGES))
    top = win.top1_per_group(docs, ["WeekNum", "id_good"], [
        F.to_date("s_date").desc(), F.col("rate").asc(), F.col("s_date").desc(), F.col("id").asc()])
    goods = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id_good"), F.col("c_name").alias("good_name"),
        F.col("c_nationkey").alias("id_good_group"))
    groups = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id_good_group"), F.col("n_name").alias("good_group_name"))
    return (top.join(goods, "id_good").join(groups, "id_good_group")
            .select("WeekNum", "id", "good_name", "good_group_name", "s_date", "amount", "rate"))


@query("prev_7d", covers=("W2", "J8", "F15"), sql="""
SELECT a.event_id AS transaction_id, a.user_id, CAST(a.ts AS DATE) AS date,
       count(b.event_id) AS trans_prev_7d
FROM events a
LEFT JOIN events b
  ON b.user_id = a.user_id
 AND CAST(b.ts AS DATE) >= CAST(a.ts AS DATE) - 7
 AND CAST(b.ts AS DATE) <= CAST(a.ts AS DATE) - 1
GROUP BY a.event_id, a.user_id, CAST(a.ts AS DATE)
""")
def q_prev_7d(spark, sf_dir):
    tx = read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"), "user_id", F.to_date("ts").alias("date"))
    return win.prev_days_count(tx, "user_id", "date").select(
        "transaction_id", "user_id", "date", "trans_prev_7d")


def agreement_standin(spark, sf_dir):
    """One version per (user, day): the day's last event gives the attributes."""
    ev = read_table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", "value", F.to_date("ts").alias("day"))
    last = win.latest_per_group(ev, ["user_id", "day"], ["ts", "event_id"], ["event_type", "value"])
    return last.select(
        F.col("user_id").alias("agrmnt_id"), F.col("day").alias("actual_from_dt"),
        F.col("event_type").alias("client_id"),
        F.when(F.col("value") > 300, F.lit("big")).when(F.col("value") > 100, F.lit(""))
        .alias("product_id"))


@query("compact_dim", covers=("W3", "W4", "W5"), sql="""
WITH last AS (
  SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS event_type,
         arg_max(value, (ts, event_id)) AS value
  FROM events GROUP BY 1, 2),
v AS (
  SELECT user_id AS agrmnt_id, day AS actual_from_dt, event_type AS client_id,
         CASE WHEN value > 300 THEN 'big' WHEN value > 100 THEN '' END AS product_id
  FROM last),
flagged AS (
  SELECT *, CASE WHEN (coalesce(client_id, ''), coalesce(product_id, '')) IS NOT DISTINCT FROM
                      lag((coalesce(client_id, ''), coalesce(product_id, '')))
                        OVER (PARTITION BY agrmnt_id ORDER BY actual_from_dt)
                 THEN 0 ELSE 1 END AS starts
  FROM v),
runs AS (SELECT * FROM flagged WHERE starts = 1)
SELECT agrmnt_id, actual_from_dt,
       coalesce(CAST(lead(actual_from_dt) OVER (PARTITION BY agrmnt_id ORDER BY actual_from_dt)
                     - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS actual_to_dt,
       client_id, product_id
FROM runs
""")
def q_compact_dim(spark, sf_dir):
    return win.compact_dim(agreement_standin(spark, sf_dir), "agrmnt_id",
                           ["client_id", "product_id"], "actual_from_dt")


def pivot_inputs(spark, sf_dir):
    """sales = events (id_good = user, cents of value); goods = customer."""
    sales = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id_good"), F.col("ts").alias("s_date"),
        cents_of("value").alias("amount_cents"))
    goods = read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("good_name"))
    return sales, goods


@query("daily_sales", covers=("A15", "J3"), sql=f"""
SELECT g.c_name AS good_name, CAST(s.ts AS DATE) AS dat,
       CAST(sum(CAST(floor(s.value * 100 + 0.5) AS BIGINT)) AS BIGINT) AS sum_amount
FROM events s JOIN customer g ON s.user_id = g.c_custkey
WHERE CAST(s.ts AS DATE) BETWEEN DATE '{PIVOT_BEGIN}' AND DATE '{PIVOT_END}'
GROUP BY 1, 2
""")
def q_daily_sales(spark, sf_dir):
    sales, goods = pivot_inputs(spark, sf_dir)
    return agg.daily_totals(sales, goods, PIVOT_BEGIN, PIVOT_END)


@query("pivot_days", covers=("V1", "F22"), sql=f"""
WITH t AS (
  SELECT g.c_name AS good_name, CAST(CAST(s.ts AS DATE) AS VARCHAR) AS dat,
         CAST(floor(s.value * 100 + 0.5) AS BIGINT) AS c
  FROM events s JOIN customer g ON s.user_id = g.c_custkey
  WHERE CAST(s.ts AS DATE) BETWEEN DATE '{PIVOT_BEGIN}' AND DATE '{PIVOT_END}')
PIVOT t ON dat IN ('2024-01-28', '2024-01-29', '2024-01-30') USING CAST(coalesce(sum(c), 0) AS BIGINT) GROUP BY good_name
""")
def q_pivot_days(spark, sf_dir):
    sales, goods = pivot_inputs(spark, sf_dir)
    daily = agg.daily_totals(sales, goods, PIVOT_BEGIN, PIVOT_END)
    days = sales.select(F.to_date("s_date").alias("dat"))
    return pivot_days(daily, "good_name", "dat", "sum_amount", PIVOT_BEGIN, PIVOT_END, days=days)


def users_transactions(spark, sf_dir):
    """users = customer (+ a duplicate of every BUILDING customer), active ⇔
    c_acctbal > 0; transactions = orders, blocked ⇔ status 'P', category =
    order priority. Booleans as 'True'/'False' text, as in the CSV files."""
    c = read_table(spark, sf_dir, "customer")
    users = c.unionByName(c.where(F.col("c_mktsegment") == "BUILDING")).select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") > 0, F.lit("True")).otherwise(F.lit("False")).alias("is_active"))
    tx = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("True")).otherwise(F.lit("False"))
        .alias("is_blocked"),
        cents_of("o_totalprice").alias("transaction_amount"),
        F.col("o_orderpriority").alias("transaction_category_id"))
    return users, tx


@query("category_totals", covers=("J1", "A13", "O2", "P9"), sql="""
SELECT t.o_orderpriority AS transaction_category_id,
       CAST(sum(CAST(floor(t.o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0 AS sum_amount,
       CAST(count(DISTINCT t.o_custkey) AS BIGINT) AS num_users
FROM orders t
WHERE t.o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0
                      UNION ALL
                      SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0)
  AND NOT (t.o_orderstatus = 'P')
GROUP BY t.o_orderpriority
""")
def q_category_totals(spark, sf_dir):
    users, tx = users_transactions(spark, sf_dir)
    active = users.where(is_text_true("is_active"))
    open_tx = tx.where(is_text_false("is_blocked"))
    out = agg.category_totals(open_tx, active)
    return out.select("transaction_category_id",
                      (F.col("sum_amount").cast("double") / 100.0).alias("sum_amount"), "num_users")


def occupations(spark, sf_dir):
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("occupation"))


@query("occupation_names", covers=("P14", "F8", "F9", "O1"), sql="""
SELECT concat(c_name, '(', substring(coalesce(c_mktsegment, ''), 1, 1), ')') AS result
FROM customer
""")
def q_occupation_names(spark, sf_dir):
    return occupations(spark, sf_dir).select(name_initial("name", "occupation").alias("result")) \
        .orderBy(F.col("result").asc_nulls_last())


@query("occupation_counts", covers=("A14", "P15", "F7"), sql="""
WITH c AS (SELECT c_mktsegment AS occupation, count(*) AS cnt FROM customer GROUP BY 1)
SELECT concat('There are a total of ', cnt, ' ', lower(occupation), 's.') AS result FROM c
""")
def q_occupation_counts(spark, sf_dir):
    counts = agg.occupation_counts(occupations(spark, sf_dir))
    return counts.select(count_sentence("cnt", "occupation").alias("result"))


@query("names_then_counts", covers=("W6", "O4"), sql="""
WITH c AS (SELECT c_mktsegment AS occupation, count(*) AS cnt FROM customer GROUP BY 1)
SELECT concat(c_name, '(', substring(coalesce(c_mktsegment, ''), 1, 1), ')') AS result FROM customer
UNION ALL
SELECT concat('There are a total of ', cnt, ' ', lower(occupation), 's.') AS result FROM c
""")
def q_names_then_counts(spark, sf_dir):
    """Both lists in one result, names first: a global sort on (list, key)
    instead of an unpartitioned ROW_NUMBER (which would run in one task)."""
    return names_then_counts(occupations(spark, sf_dir))


def names_then_counts(occ):
    names = occ.select(name_initial("name", "occupation").alias("result"), F.lit(1).alias("_list"),
                       F.lit(0).cast("bigint").alias("_count"), F.lit(None).cast("string").alias("_key"))
    counts = agg.occupation_counts(occ).select(
        count_sentence("cnt", "occupation").alias("result"), F.lit(2).alias("_list"),
        F.col("cnt").alias("_count"), F.col("occupation").alias("_key"))
    return (names.unionByName(counts)
            .orderBy("_list", "_count", F.col("_key").asc_nulls_last(), F.col("result").asc_nulls_last())
            .select("result"))
