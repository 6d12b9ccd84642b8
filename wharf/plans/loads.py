"""Incremental jobs, run twice with pinned run dates on stand-in snapshots,
and the checks over the loaded tables.

State between runs lives in parquet folders under the session's shared
``spark.checkpoint.dir`` (see ``wharf.session.work_dir``); each run reads
the previous state and writes the next one beside it or restates its
partitions, which also cuts lineage.
The oracle SQL computes the final tables directly from the base tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators import checks as chk
from wharf.operators.incremental import changed_ids, extract_since, insert_new, last_import
from wharf.plans import payments as pay
from wharf.plans import standins as si
from wharf.plans.registry import query
from wharf.session import merge_buckets, read_table, table_path, tasks_for, work_dir
from wharf.sources.catalog import CatalogTable, open_database
from wharf.sources.tables import append, ensure_table, path_bytes, replace_window_partitions

# --- fixed values of the two-run stand-ins --------------------------------------
COPY_RUN1, COPY_RUN2 = dt.date(1998, 1, 1), dt.date(2002, 1, 1)
COPY_DEFAULT_MARK = dt.date(1990, 1, 1)
STAGE_TS1, STAGE_TS2, STAGE_TS3 = "2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00"
SNAPSHOT_CUT = "2000-01-01"
NO_ID_EVERY, UNKNOWN_EVERY, TWICE_EVERY, VANISHED_EVERY = 101, 97, 103, 107      # damaged seeds, by order key
RESTATE_RUN, RESTATE_DAYS, RESTATE_EMPTY_DAY = dt.date(2024, 1, 25), 14, dt.date(2024, 1, 20)
# ---------------------------------------------------------------------------------


# -- insert-only copy (I1, I2, S8, S9, S10, S11, C5) ---------------------------------

def sync_tables(spark: SparkSession, targets: Mapping[str, tuple[str, T.StructType]],
                sources: Mapping[str, DataFrame], keys: Mapping[str, str], run_date,
                default_mark=COPY_DEFAULT_MARK, created_col: str = "created_at") -> dict[str, DataFrame]:
    """One run of the insert-only copy: one mark over all targets (newest
    ``import_date`` of earlier runs, else ``default_mark``), extract
    ``created_col >= mark`` from every source, insert rows whose key is new,
    append by name. Rerunning the same ``run_date`` after a failure is
    idempotent. Returns the rejected rows per table (NULL keys)."""
    tdfs = {n: ensure_table(spark, p, s) for n, (p, s) in targets.items()}
    mark = last_import(list(tdfs.values()), default=default_mark, before=run_date)
    rejected = {}
    for n, src in sources.items():
        path, schema = targets[n]
        batch = extract_since(src, created_col, mark)
        fresh, rej = insert_new(tdfs[n], batch, keys[n], run_date, order_cols=[created_col])
        append(fresh, path, columns=schema.fieldNames())
        rejected[n] = rej
    return rejected


ORDERS_COPY_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("created_at", T.DateType()), T.StructField("o_orderpriority", T.StringType()),
    T.StructField("import_date", T.DateType())])
CUSTOMER_COPY_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("created_at", T.DateType()), T.StructField("import_date", T.DateType())])


def copy_sources(spark, sf_dir):
    """Run-1 and run-2 snapshots of two source tables.

    orders: run 1 sees orders before 1998 except status 'P' (those arrive
    late and, being older than the mark, are missed by run 2); run 2 sees
    all orders plus a second row for 1999+ URGENT orders (key twice in a
    batch) and a NULL-key copy of open orders from 2001-06 on.
    customer: created_at = 1997-12-20 + (custkey mod 30) days.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.to_date("o_orderdate").alias("created_at"), "o_orderpriority")
    o1 = o.where((F.col("created_at") < F.lit("1998-01-01").cast("date"))
                 & (F.col("o_orderstatus") != "P"))
    dup = (o.where((F.col("created_at") >= F.lit("1999-01-01").cast("date"))
                   & (F.col("o_orderpriority") == "1-URGENT"))
           .withColumn("o_orderpriority", F.lit("0-DUP")))
    nullkey = (o.where((F.col("created_at") >= F.lit("2001-06-01").cast("date"))
                       & (F.col("o_orderstatus") == "O"))
               .withColumn("o_orderkey", F.lit(None).cast("bigint")))
    o2 = o.unionByName(dup).unionByName(nullkey)
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.date_add(F.lit("1997-12-20").cast("date"), F.pmod("c_custkey", F.lit(30)).cast("int"))
        .alias("created_at"))
    c1 = c.where(F.col("created_at") < F.lit("1998-01-01").cast("date"))
    return (o1, c1), (o2, c)


def run_copy(spark, sf_dir):
    root = work_dir(spark, "copy")
    targets = {"orders": (f"{root}/orders", ORDERS_COPY_SCHEMA),
               "customer": (f"{root}/customer", CUSTOMER_COPY_SCHEMA)}
    keys = {"orders": "o_orderkey", "customer": "c_custkey"}
    (o1, c1), (o2, c2) = copy_sources(spark, sf_dir)
    sync_tables(spark, targets, {"orders": o1, "customer": c1}, keys, COPY_RUN1)
    rejected = sync_tables(spark, targets, {"orders": o2, "customer": c2}, keys, COPY_RUN2)
    final = {n: spark.read.parquet(p) for n, (p, _) in targets.items()}
    return final, (o2, c2), rejected


_COPY_CTE = """
src AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(o_orderdate AS DATE) AS created_at, o_orderpriority FROM orders),
run1 AS (SELECT *, DATE '1998-01-01' AS import_date FROM src
         WHERE created_at < DATE '1998-01-01' AND o_orderstatus <> 'P'),
csrc AS (SELECT c_custkey, c_name, CAST(DATE '1997-12-20' + CAST(c_custkey % 30 AS INTEGER) AS DATE) AS created_at
         FROM customer),
crun1 AS (SELECT *, DATE '1998-01-01' AS import_date FROM csrc WHERE created_at < DATE '1998-01-01'),
mark AS (SELECT max(import_date) AS m FROM (SELECT import_date FROM run1 UNION ALL SELECT import_date FROM crun1)),
batch2 AS (
  SELECT * FROM src
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, created_at, '0-DUP'
            FROM src WHERE created_at >= DATE '1999-01-01' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT NULL, o_custkey, o_orderstatus, o_totalprice, created_at, o_orderpriority
            FROM src WHERE created_at >= DATE '2001-06-01' AND o_orderstatus = 'O'),
ext2 AS (SELECT * FROM batch2 WHERE created_at >= (SELECT m FROM mark) AND o_orderkey IS NOT NULL),
pick AS (SELECT * FROM ext2 QUALIFY row_number() OVER (
           PARTITION BY o_orderkey
           ORDER BY created_at, o_custkey, o_orderstatus, o_totalprice, o_orderpriority) = 1),
run2 AS (SELECT *, DATE '2002-01-01' AS import_date FROM pick
         WHERE o_orderkey NOT IN (SELECT o_orderkey FROM run1)),
crun2 AS (SELECT *, DATE '2002-01-01' AS import_date FROM csrc
          WHERE created_at >= (SELECT m FROM mark) AND c_custkey NOT IN (SELECT c_custkey FROM crun1)),
final_orders AS (SELECT * FROM run1 UNION ALL SELECT * FROM run2),
final_customer AS (SELECT * FROM crun1 UNION ALL SELECT * FROM crun2)
"""


@query("insert_new", stateful=True, covers=("I1", "I2", "S8", "S9", "S10", "S11", "J9", "O3", "P16"), sql="WITH " + _COPY_CTE + """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, created_at, o_orderpriority, import_date
FROM final_orders
""")
def q_insert_new(spark, sf_dir):
    final, _, _ = run_copy(spark, sf_dir)
    return final["orders"]


@query("copy_rejects", stateful=True, covers=("I1",), sql="WITH " + _COPY_CTE + """
SELECT o_custkey, o_orderstatus, o_totalprice, created_at, o_orderpriority, 'null key' AS reject_reason
FROM batch2 WHERE o_orderkey IS NULL AND created_at >= (SELECT m FROM mark)
""")
def q_copy_rejects(spark, sf_dir):
    """Rows of the second run that have no key: reported, never inserted."""
    _, _, rejected = run_copy(spark, sf_dir)
    return rejected["orders"].drop("o_orderkey")


@query("recreate_table", stateful=True, covers=("S12", "S13"), sql="""
SELECT o_custkey, CAST(count(*) AS BIGINT) * 2 AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
""")
def q_recreate_table(spark, sf_dir):
    """A table dropped, created empty, filled, replaced by a plan that reads it,
    emptied and filled again: each replace is one write and one swap."""
    root = work_dir(spark, "recreate")
    db = open_database(spark, f"wharf_{root.rsplit('-', 1)[1]}", root)
    table = CatalogTable(spark, f"{db}.totals", f"{root}/totals")
    totals = (read_table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
              .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")))
    table.drop()
    table.replace(totals.limit(0))
    table.replace(totals)
    doubled = table.replace(table.read().withColumn("n", F.col("n") * 2))
    table.replace(doubled.limit(0))
    return table.replace(doubled)              # the version before the empty one is still there for its readers


@query("reconcile_copy", stateful=True, covers=("C5", "O4"), sql="WITH " + _COPY_CTE + """
SELECT 'orders' AS table_name, CAST((SELECT count(*) FROM batch2) AS BIGINT) AS source_count,
       CAST((SELECT count(*) FROM final_orders) AS BIGINT) AS target_count,
       (SELECT count(*) FROM batch2) = (SELECT count(*) FROM final_orders) AS counts_match
UNION ALL
SELECT 'customer', CAST((SELECT count(*) FROM csrc) AS BIGINT),
       CAST((SELECT count(*) FROM final_customer) AS BIGINT),
       (SELECT count(*) FROM csrc) = (SELECT count(*) FROM final_customer)
""")
def q_reconcile_copy(spark, sf_dir):
    final, (o2, c2), _ = run_copy(spark, sf_dir)
    return chk.reconcile([("orders", o2, final["orders"]), ("customer", c2, final["customer"])])


# -- hash-stamped staging and incremental fact (I3–I9, I10) -----------------------

def order_snapshots(spark, sf_dir):
    """Acceptance snapshot 1: orders before 2000. Snapshot 2: all orders but
    the LOW-priority ones before 2000 (vanished ids), open HIGH-priority
    orders now accepted (hash changes), MEDIUM amounts + 1 (outside the hash)."""
    o = read_table(spark, sf_dir, "orders")
    cut = F.lit(SNAPSHOT_CUT).cast("timestamp_ntz")
    o1 = o.where(F.col("o_orderdate") < cut)
    o2 = (o.where(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderdate") < cut)))
          .withColumn("o_orderstatus",
                      F.when((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "2-HIGH"),
                             F.lit("F")).otherwise(F.col("o_orderstatus")))
          .withColumn("o_totalprice",
                      F.when(F.col("o_orderpriority") == "3-MEDIUM", F.col("o_totalprice") + 1)
                      .otherwise(F.col("o_totalprice"))))
    li = read_table(spark, sf_dir, "lineitem")
    li1 = li.where(F.col("l_shipdate") < cut)
    return (o1, li1), (o, o2, li)


PAYMENT_TABLES = ("acceptance", "chargeback", "fact")
LINES_PER_ROW = 4           # a chargeback, of one or more line items, is narrower than an acceptance row by this much


def payment_tables(spark, sf_dir, buckets: int | None = None) -> tuple[CatalogTable, ...]:
    """Staging and fact as catalog tables, all in the same buckets of ``transaction_id`` (by the rows of the seeds'
    source unless given; a table that exists keeps its own count until it is rebucketed)."""
    root = work_dir(spark, "payments")
    db = open_database(spark, f"wharf_{root.rsplit('-', 1)[1]}", root)
    if not buckets:
        rows, lines = (read_table(spark, sf_dir, n).count() for n in ("orders", "lineitem"))       # from the footers
        buckets = merge_buckets(max(rows, lines // LINES_PER_ROW), path_bytes(spark, table_path(sf_dir, "orders")))
    return tuple(CatalogTable(spark, f"{db}.{n}", f"{root}/{n}", "transaction_id", buckets) for n in PAYMENT_TABLES)


def stage_seeds(spark, sf_dir, acc_t: CatalogTable, cb_t: CatalogTable, ts: str, orders, lineitem,
                full: bool = False) -> tuple[DataFrame, DataFrame]:
    """Merge both seeds into staging; ``full`` rebuilds staging from them alone. A seed is read and shuffled in as
    many tasks as the table has buckets, so that their rows are bounded like a bucket's."""
    out = []
    for table, cleaned in ((acc_t, pay.clean_acceptance(si.acceptance_seed(spark, sf_dir, orders))),
                           (cb_t, pay.clean_chargeback(si.chargeback_seed(spark, sf_dir, lineitem)))):
        with tasks_for(spark, table.buckets):
            out.append(table.merge(cleaned, lambda src, cur: pay.stage(
                src, ts, None if full else cur, check_unique=False)))
    return tuple(out)


def merge_changes(fact_t: CatalogTable, acc: DataFrame, cb: DataFrame, ts: str, backfill_days: int = 0) -> DataFrame:
    """Changed rows of staging into the fact. All three tables have the same buckets, so nothing is shuffled;
    ids are unique by construction (staging ids, left join to unique ids)."""
    now = fact_t.read()
    mark = fact_t.watermark("source_dw_modified_at") if now is not None else None
    changed = pay.fact_changes(acc, cb, ts, now, backfill_days=backfill_days, mark=mark or pay.DEFAULT_SOURCE_MARK)
    return fact_t.merge(changed, pay.merge_fact, dealt=True, track_max="source_dw_modified_at")


def run_payment_model(spark, sf_dir, backfill_days: int = 0, buckets: int | None = None, with_fact: bool = True,
                      tables: tuple[CatalogTable, ...] | None = None):
    """Two runs of staging (acceptance, chargeback) and fact. Staging batches must hold each id once and no row
    without one; that is checked inside the write job."""
    acc_t, cb_t, fact_t = tables or payment_tables(spark, sf_dir, buckets)
    (o1, li1), (_, o2, li2) = order_snapshots(spark, sf_dir)
    for ts, orders, lineitem in ((STAGE_TS1, o1, li1), (STAGE_TS2, o2, li2)):
        acc, cb = stage_seeds(spark, sf_dir, acc_t, cb_t, ts, orders, lineitem)
        if with_fact:
            merge_changes(fact_t, acc, cb, ts, backfill_days)
    return acc_t.read(), cb_t.read(), fact_t.read()


def rebuild_payments(spark, sf_dir, tables: tuple[CatalogTable, ...], ts: str, orders, lineitem) -> DataFrame:
    """Full refresh of staging and fact from the seeds alone: ids that vanished from the seeds go, all stamps are
    the run's. Each table is written beside the old one and swapped in at once."""
    acc_t, cb_t, fact_t = tables
    acc, cb = stage_seeds(spark, sf_dir, acc_t, cb_t, ts, orders, lineitem, full=True)
    return fact_t.merge(pay.build_fact(acc, cb, ts), lambda src, cur: src, dealt=True, track_max="source_dw_modified_at")


_STAGE_CTE = """
a1 AS (SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
              CASE WHEN o_orderstatus = 'F' THEN 'ACCEPTED' ELSE 'DECLINED' END AS transaction_state,
              o_totalprice AS amount, CAST(o_orderdate AS DATE) AS transaction_date
       FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
a2 AS (SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
              CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')
                   THEN 'ACCEPTED' ELSE 'DECLINED' END AS transaction_state,
              CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice + 1 ELSE o_totalprice END AS amount,
              CAST(o_orderdate AS DATE) AS transaction_date
       FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '2000-01-01')),
acc_final AS (
  SELECT a2.transaction_id, a2.transaction_state, a2.amount, a2.transaction_date,
         CASE WHEN a1.transaction_id IS NULL THEN TIMESTAMP '2024-01-02 06:00:00'
              ELSE TIMESTAMP '2024-01-01 06:00:00' END AS dw_created_at,
         CASE WHEN a1.transaction_id IS NULL THEN TIMESTAMP '2024-01-02 06:00:00'
              WHEN a1.transaction_state IS DISTINCT FROM a2.transaction_state THEN TIMESTAMP '2024-01-02 06:00:00'
              ELSE TIMESTAMP '2024-01-01 06:00:00' END AS dw_modified_at
  FROM a2 LEFT JOIN a1 ON a1.transaction_id = a2.transaction_id
  UNION ALL
  SELECT transaction_id, transaction_state, amount, transaction_date,
         TIMESTAMP '2024-01-01 06:00:00', TIMESTAMP '2024-01-01 06:00:00'
  FROM a1 WHERE transaction_id NOT IN (SELECT transaction_id FROM a2)),
c1 AS (SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
              CASE WHEN bool_or(l_returnflag = 'R') THEN true
                   WHEN bool_or(l_returnflag = 'A') THEN false END AS has_chargeback
       FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01' GROUP BY 1),
c2 AS (SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
              CASE WHEN bool_or(l_returnflag = 'R') THEN true
                   WHEN bool_or(l_returnflag = 'A') THEN false END AS has_chargeback
       FROM lineitem GROUP BY 1),
cb_final AS (
  SELECT c2.transaction_id, c2.has_chargeback,
         CASE WHEN c1.transaction_id IS NULL THEN TIMESTAMP '2024-01-02 06:00:00'
              WHEN c1.has_chargeback IS DISTINCT FROM c2.has_chargeback THEN TIMESTAMP '2024-01-02 06:00:00'
              ELSE TIMESTAMP '2024-01-01 06:00:00' END AS dw_modified_at
  FROM c2 LEFT JOIN c1 ON c1.transaction_id = c2.transaction_id),
fact1 AS (
  SELECT a.transaction_id, a.transaction_state, a.amount, c.has_chargeback,
         (c.transaction_id IS NULL OR c.has_chargeback IS NULL) AS is_missing_chargeback,
         TIMESTAMP '2024-01-01 06:00:00' AS source_dw_modified_at,
         TIMESTAMP '2024-01-01 06:00:00' AS dw_created_at,
         TIMESTAMP '2024-01-01 06:00:00' AS dw_modified_at
  FROM a1 a LEFT JOIN c1 c ON a.transaction_id = c.transaction_id),
changed AS (
  SELECT transaction_id FROM acc_final WHERE dw_modified_at > TIMESTAMP '2024-01-01 06:00:00'{backfill}
  UNION
  SELECT transaction_id FROM cb_final WHERE dw_modified_at > TIMESTAMP '2024-01-01 06:00:00'),
fact2_new AS (
  SELECT a.transaction_id, a.transaction_state, a.amount, c.has_chargeback,
         (c.transaction_id IS NULL OR c.has_chargeback IS NULL) AS is_missing_chargeback,
         CASE WHEN c.dw_modified_at IS NULL THEN a.dw_modified_at
              ELSE greatest(a.dw_modified_at, c.dw_modified_at) END AS source_dw_modified_at
  FROM acc_final a LEFT JOIN cb_final c ON a.transaction_id = c.transaction_id
  WHERE a.transaction_id IN (SELECT transaction_id FROM changed)),
fact_final AS (
  SELECT n.transaction_id, n.transaction_state, n.amount, n.has_chargeback, n.is_missing_chargeback,
         n.source_dw_modified_at,
         coalesce(f.dw_created_at, TIMESTAMP '2024-01-02 06:00:00') AS dw_created_at,
         TIMESTAMP '2024-01-02 06:00:00' AS dw_modified_at
  FROM fact2_new n LEFT JOIN fact1 f ON f.transaction_id = n.transaction_id
  UNION ALL
  SELECT * FROM fact1 WHERE transaction_id NOT IN (SELECT transaction_id FROM fact2_new))
"""


@query("upsert_staging", stateful=True, covers=("I3", "I4", "I5", "P13"), sql="WITH " + _STAGE_CTE.format(backfill="") + """
SELECT transaction_id, transaction_state, amount, dw_created_at, dw_modified_at FROM acc_final
""")
def q_upsert_staging(spark, sf_dir):
    acc, _, _ = run_payment_model(spark, sf_dir, with_fact=False)
    return acc.select("transaction_id", "transaction_state", "amount", "dw_created_at",
                      "dw_modified_at")


@query("payment_changed_rows", stateful=True, covers=("I6", "J5", "O5"), sql="WITH " + _STAGE_CTE.format(backfill="") + """
SELECT 'acceptance' AS side, transaction_id, dw_modified_at FROM acc_final
WHERE transaction_id IN (SELECT transaction_id FROM changed)
UNION ALL
SELECT 'chargeback', transaction_id, dw_modified_at FROM cb_final
WHERE transaction_id IN (SELECT transaction_id FROM changed)
""")
def q_changed_rows(spark, sf_dir):
    """Staged rows, on both sides, of the ids that changed on either side since the first run."""
    acc, cb, _ = run_payment_model(spark, sf_dir, with_fact=False)
    ids = changed_ids(acc, cb, STAGE_TS1)
    return reduce(DataFrame.unionByName, [
        pay.changed_rows(df, ids).select(F.lit(side).alias("side"), "transaction_id", "dw_modified_at")
        for side, df in (("acceptance", acc), ("chargeback", cb))])


_REBUILT_CTE = _STAGE_CTE.format(backfill="") + """, rebuilt AS (
  SELECT a.transaction_id, a.transaction_state, a.amount, c.has_chargeback,
         (c.transaction_id IS NULL OR c.has_chargeback IS NULL) AS is_missing_chargeback,
         TIMESTAMP '2024-01-03 06:00:00' AS source_dw_modified_at, TIMESTAMP '2024-01-03 06:00:00' AS dw_created_at,
         TIMESTAMP '2024-01-03 06:00:00' AS dw_modified_at
  FROM a2 a LEFT JOIN c2 c ON a.transaction_id = c.transaction_id)
"""


def rebuilt_fact(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The fact after two incremental runs (kept on disk by the swap), and after a full refresh over it."""
    tables = payment_tables(spark, sf_dir)
    _, _, before = run_payment_model(spark, sf_dir, tables=tables)
    _, (_, o2, li2) = order_snapshots(spark, sf_dir)
    return before, rebuild_payments(spark, sf_dir, tables, STAGE_TS3, o2, li2)


@query("payment_fact_rebuild", stateful=True, covers=("I10",), sql="WITH " + _REBUILT_CTE + "SELECT * FROM rebuilt")
def q_fact_rebuild(spark, sf_dir):
    _, fact = rebuilt_fact(spark, sf_dir)
    return fact.select("transaction_id", "transaction_state", "amount", "has_chargeback", "is_missing_chargeback",
                       "source_dw_modified_at", "dw_created_at", "dw_modified_at")


@query("payment_rebuild_vanished", stateful=True, covers=("I10",), sql="WITH " + _REBUILT_CTE + """
SELECT transaction_id, dw_created_at, dw_modified_at FROM fact_final
WHERE transaction_id NOT IN (SELECT transaction_id FROM rebuilt)
""")
def q_rebuild_vanished(spark, sf_dir):
    """Ids that the full refresh removed: in the old version of the fact, no longer in the seeds."""
    before, fact = rebuilt_fact(spark, sf_dir)
    return before.join(fact, "transaction_id", "left_anti").select("transaction_id", "dw_created_at", "dw_modified_at")


@query("payment_fact_incremental", stateful=True, covers=("I6", "I7", "I8", "I9", "J6", "F3", "F19"),
       sql="WITH " + _STAGE_CTE.format(backfill="") + """
SELECT * FROM fact_final
""")
def q_fact_incremental(spark, sf_dir):
    _, _, fact = run_payment_model(spark, sf_dir)
    return fact.select("transaction_id", "transaction_state", "amount", "has_chargeback",
                       "is_missing_chargeback", "source_dw_modified_at", "dw_created_at",
                       "dw_modified_at")


# -- rolling restatement (I11, I12) ---------------------------------------------------

def restate_inputs(spark, sf_dir):
    """Initial load: events before the run date. Settled data for the window:
    the window's events without 'error' rows, and nothing for one day."""
    e = read_table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("day"), "event_type", "value")
    run = F.lit(RESTATE_RUN.isoformat()).cast("date")
    initial = e.where(F.col("day") < run)
    settled = e.where((F.col("event_type") != "error")
                      & (F.col("day") != F.lit(RESTATE_EMPTY_DAY.isoformat()).cast("date")))
    return initial, settled


@query("replace_window", stateful=True, covers=("I11", "I12", "P6"), sql="""
SELECT event_id, CAST(ts AS DATE) AS day, event_type, value FROM events
WHERE CAST(ts AS DATE) < DATE '2024-01-11'
UNION ALL
SELECT event_id, CAST(ts AS DATE) AS day, event_type, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-24'
  AND event_type <> 'error' AND CAST(ts AS DATE) <> DATE '2024-01-20'
""")
def q_replace_window(spark, sf_dir):
    root = work_dir(spark, "restate")
    initial, settled = restate_inputs(spark, sf_dir)
    initial.write.mode("overwrite").partitionBy("day").parquet(root)
    replace_window_partitions(spark, root, settled, "day", RESTATE_RUN, RESTATE_DAYS)
    return spark.read.parquet(root).select("event_id", "day", "event_type", "value")


# -- checks (C1–C4, C7, C8, J10, J11) --------------------------------------------------

@query("checks_orders", covers=("C1", "C2", "C3", "C4", "C7", "C8", "J10"), sql="""
SELECT 'not_null' AS rule, 'o_orderkey' AS column, CAST(count_if(o_orderkey IS NULL) AS BIGINT) AS failing_rows FROM orders
UNION ALL SELECT 'not_null', 'o_custkey', CAST(count_if(o_custkey IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'not_null', 'o_orderdate', CAST(count_if(o_orderdate IS NULL) AS BIGINT) FROM orders
UNION ALL SELECT 'accepted_values', 'o_orderstatus',
                 CAST(count_if(o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) AS BIGINT) FROM orders
UNION ALL SELECT 'expect', 'totalprice_positive', CAST(count_if(NOT coalesce(o_totalprice > 0, false)) AS BIGINT) FROM orders
UNION ALL SELECT 'unique', 'o_orderkey', CAST(count(*) AS BIGINT) FROM
          (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'o_custkey,o_orderdate', CAST(count(*) AS BIGINT) FROM
          (SELECT o_custkey, o_orderdate FROM orders WHERE o_custkey IS NOT NULL OR o_orderdate IS NOT NULL
           GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'relationships', 'o_custkey', CAST(count(*) AS BIGINT) FROM orders o
          WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
""")
def q_checks_orders(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    rules = [chk.NotNull(["o_orderkey", "o_custkey", "o_orderdate"]),
             chk.AcceptedValues("o_orderstatus", ["F", "O"]),
             chk.Expect("totalprice_positive", F.col("o_totalprice") > 0),
             chk.Unique(["o_orderkey"]),
             chk.Unique(["o_custkey", "o_orderdate"]),
             chk.Relationship("o_custkey", customer, "c_custkey")]
    return chk.run_checks(spark, orders, rules)


@query("checks_lineitem", covers=("C2", "C4", "C7", "J10"), sql="""
SELECT 'unique' AS rule, 'l_orderkey,l_linenumber' AS column, CAST(count(*) AS BIGINT) AS failing_rows FROM
  (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'relationships', 'l_orderkey', CAST(count(*) AS BIGINT) FROM lineitem l
  WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'relationships', 'l_partkey', CAST(count(*) AS BIGINT) FROM lineitem l
  WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
""")
def q_checks_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return chk.run_checks(spark, li, [
        chk.Unique(["l_orderkey", "l_linenumber"]),
        chk.Relationship("l_orderkey", read_table(spark, sf_dir, "orders"), "o_orderkey"),
        chk.Relationship("l_partkey", read_table(spark, sf_dir, "part"), "p_partkey")])


def damaged_seeds(spark, sf_dir):
    """Both payment seeds with the faults that the checks look for: acceptance
    rows without id, with an unknown state, twice, or missing for a chargeback."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    seed = si.acceptance_seed(spark, sf_dir, o.where(F.coalesce(k % VANISHED_EVERY != 0, F.lit(True))))
    ref = F.col("external_ref").cast("bigint")
    seed = seed.withColumn("state", F.when(ref % UNKNOWN_EVERY == 0, " pending").otherwise(F.col("state")))
    seed = seed.unionByName(seed.where(ref % TWICE_EVERY == 0))
    seed = seed.withColumn("external_ref", F.when(ref % NO_ID_EVERY == 0, None).otherwise(F.col("external_ref")))
    return seed, si.chargeback_seed(spark, sf_dir)


def _failing(table: str, rule: str, column: str, count: str, source: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column, "
            f"CAST({count} AS BIGINT) AS failing_rows FROM {source}")


def _null_and_unique(table: str, nulls: tuple[str, ...], key: str) -> list[str]:
    twice = f"(SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    return ([_failing(table, "not_null", c, f"count_if({c} IS NULL)", table) for c in nulls]
            + [_failing(table, "unique", key, "count(*)", twice)])


_CHECKS_PAYMENTS_SQL = f"""WITH kept AS (
  SELECT *, CASE WHEN o_orderkey % {NO_ID_EVERY} = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS transaction_id,
         CASE WHEN o_orderkey % {UNKNOWN_EVERY} = 0 THEN 'PENDING' WHEN o_orderstatus = 'F' THEN 'ACCEPTED'
              ELSE 'DECLINED' END AS transaction_state, CAST(o_orderdate AS DATE) AS transaction_date
  FROM orders WHERE coalesce(o_orderkey % {VANISHED_EVERY} <> 0, true)),
acceptance AS (SELECT * FROM kept UNION ALL SELECT * FROM kept WHERE o_orderkey % {TWICE_EVERY} = 0),
chargeback AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS transaction_id FROM lineitem),
fact AS (SELECT a.* FROM acceptance a LEFT JOIN chargeback c ON a.transaction_id = c.transaction_id
         WHERE a.transaction_id IS NOT NULL),
daily AS (SELECT transaction_date, count_if(transaction_state = 'ACCEPTED') AS accepted_count,
                 count(*) AS total_count FROM fact GROUP BY 1)
""" + "\nUNION ALL ".join([
    *_null_and_unique("acceptance", ("transaction_id", "transaction_state", "transaction_date"), "transaction_id"),
    _failing("acceptance", "accepted_values", "transaction_state",
             "count_if(transaction_state NOT IN ('ACCEPTED', 'DECLINED'))", "acceptance"),
    _failing("acceptance", "expect", "amount_positive", "count_if(NOT coalesce(o_totalprice > 0, false))", "acceptance"),
    *_null_and_unique("chargeback", ("transaction_id",), "transaction_id"),
    _failing("chargeback", "relationships", "transaction_id", "count(*)",
             "chargeback c WHERE transaction_id IS NOT NULL AND NOT EXISTS "
             "(SELECT 1 FROM acceptance a WHERE a.transaction_id = c.transaction_id)"),
    *_null_and_unique("fact", ("transaction_id", "transaction_date"), "transaction_id"),
    _failing("fact", "accepted_values", "transaction_state",
             "count_if(transaction_state NOT IN ('ACCEPTED', 'DECLINED'))", "fact"),
    *_null_and_unique("daily", ("transaction_date",), "transaction_date"),
    _failing("daily", "expect", "rate_between_0_and_1",
             "count_if(NOT coalesce(accepted_count / total_count BETWEEN 0 AND 1, false))", "daily")])


@query("checks_payments", stateful=True, covers=("C1", "C2", "C3", "C4", "C8", "J10"), sql=_CHECKS_PAYMENTS_SQL)
def q_checks_payments(spark, sf_dir):
    """Checks over staging, fact and daily report of damaged seeds. Rows without an
    id are counted in staging, since the merge into the fact leaves them out. The
    tables are written once, as a warehouse would check them."""
    def stored(df, name):
        path = work_dir(spark, f"checks-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    acc_seed, cb_seed = damaged_seeds(spark, sf_dir)
    acc = stored(pay.clean_acceptance(acc_seed), "acceptance")
    cb = stored(pay.clean_chargeback(cb_seed), "chargeback")
    fact = stored(pay.build_fact(pay.stage(acc, STAGE_TS1, check_unique=False),
                                 pay.stage(cb, STAGE_TS1, check_unique=False), STAGE_TS1), "fact")
    states = chk.AcceptedValues("transaction_state", [pay.ACCEPTED, pay.DECLINED])
    rules = {
        "acceptance": (acc, [chk.NotNull(["transaction_id", "transaction_state", "transaction_date"]), states,
                             chk.Expect("amount_positive", F.col("amount") > 0), chk.Unique(["transaction_id"])]),
        "chargeback": (cb, [chk.NotNull(["transaction_id"]), chk.Unique(["transaction_id"]),
                            chk.Relationship("transaction_id", acc)]),
        "fact": (fact, [chk.NotNull(["transaction_id", "transaction_date"]), states, chk.Unique(["transaction_id"])]),
        "daily": (pay.acceptance_daily(fact), [chk.NotNull(["transaction_date"]), chk.Unique(["transaction_date"]),
                                               chk.Expect("rate_between_0_and_1",
                                                          F.col("acceptance_rate").between(0, 1))])}
    found = [chk.run_checks(spark, df, r).select(F.lit(name).alias("table_name"), "*")
             for name, (df, r) in rules.items()]
    return reduce(DataFrame.unionByName, found)


@query("join_match_counts", covers=("J11",), sql="""
SELECT CAST(count(*) AS BIGINT) AS total_rows, CAST(count(c.k) AS BIGINT) AS matched_rows
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) c ON o.o_orderkey = c.k
""")
def q_join_match_counts(spark, sf_dir):
    return chk.match_counts(read_table(spark, sf_dir, "orders"),
                            read_table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


BACKFILL_FROM = dt.date(1999, 7, 1)


@query("payment_fact_backfill", stateful=True, covers=("I7", "I8"), sql="WITH " + _STAGE_CTE.format(
    backfill=f"\n     OR transaction_date >= DATE '{BACKFILL_FROM.isoformat()}'") + """
SELECT * FROM fact_final
""")
def q_fact_backfill(spark, sf_dir):
    """Second run replays acceptance rows dated from 1999-07-01 on: their
    amount changes (outside the change hash) reach the fact."""
    run_date = dt.date.fromisoformat(STAGE_TS2[:10])
    _, _, fact = run_payment_model(spark, sf_dir, backfill_days=(run_date - BACKFILL_FROM).days)
    return fact.select("transaction_id", "transaction_state", "amount", "has_chargeback",
                       "is_missing_chargeback", "source_dw_modified_at", "dw_created_at",
                       "dw_modified_at")
