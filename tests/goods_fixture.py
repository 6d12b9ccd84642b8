"""Rule-made test tables: periodic sales and documents, small dimensions.

A row's values follow from its index alone (start + step·k, cycles by
``k mod n``, an amount that grows by a step and restarts once it has passed
a limit), so ``spark.range`` builds any number of rows in parallel.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the generators -------------------------------------------
AMOUNT_START = Decimal("15.12")
AMOUNT_STEP = Decimal("21.14")
AMOUNT_LIMIT = Decimal("100000")
SALES_FROM, SALES_TO, SALES_STEP_MIN = dt.datetime(2012, 1, 1), dt.datetime(2017, 1, 30), 240
DOCS_FROM, DOCS_TO, DOCS_STEP_MIN = dt.datetime(2012, 12, 1), dt.datetime(2017, 1, 30), 30
N_GOODS, N_DOC_TYPES = 7, 3
# -------------------------------------------------------------------------------


def amount_period(start=AMOUNT_START, step=AMOUNT_STEP, limit=AMOUNT_LIMIT) -> int:
    """Rows per amount cycle: values start + step·j while the previous value
    had not passed ``limit``; the first value above it is still emitted."""
    j = int((limit - start) // step) + 1     # first j with start + step·j > limit
    if start + step * (j - 1) > limit:
        j -= 1
    return j + 1


def _count(t0: dt.datetime, t1: dt.datetime, step_min: int) -> int:
    total = int((t1 - t0).total_seconds() // 60)
    return (total + step_min - 1) // step_min


def _amount(k) -> F.Column:
    p = amount_period()
    return (F.lit(AMOUNT_START) + F.lit(AMOUNT_STEP) * F.pmod(k, F.lit(p))).cast("decimal(18,2)")


def gen_sales(spark: SparkSession) -> DataFrame:
    """Sales every 4 hours over [2012-01-01, 2017-01-30), goods 1..7 in turn."""
    n = _count(SALES_FROM, SALES_TO, SALES_STEP_MIN)
    k = F.col("id")
    return spark.range(n).select(
        (k + 1).cast("int").alias("id"),
        (F.pmod(k, F.lit(N_GOODS)) + 1).cast("int").alias("id_good"),
        (F.lit(SALES_FROM).cast("timestamp_ntz")
         + F.make_dt_interval(mins=k * SALES_STEP_MIN)).alias("s_date"),
        _amount(k).alias("amount"))


def gen_docs(spark: SparkSession) -> DataFrame:
    """Documents every 30 minutes from 2012-12-01; goods cycle 1..7, doc type
    and rate cycle 1..3 together."""
    n = _count(DOCS_FROM, DOCS_TO, DOCS_STEP_MIN)
    k = F.col("id")
    cyc3 = (F.pmod(k, F.lit(N_DOC_TYPES)) + 1).cast("int")
    return spark.range(n).select(
        (k + 1).cast("int").alias("id"),
        (F.pmod(k, F.lit(N_GOODS)) + 1).cast("int").alias("id_good"),
        cyc3.alias("id_doc_type"),
        (F.lit(DOCS_FROM).cast("timestamp_ntz")
         + F.make_dt_interval(mins=k * DOCS_STEP_MIN)).alias("s_date"),
        _amount(k).alias("amount"),
        cyc3.alias("rate"))


# small dimensions; two goods share a name and one group has no goods
DOC_TYPES = ["Order", "Delivery", "Credit note"]
GOOD_GROUPS = ["Tea", "Coffee", "Cups"]
GOODS = [(1, "Assam"), (2, "Mocha"), (1, "Sencha"), (2, "Espresso"), (1, "Assam"), (2, "Filter"), (1, "Rooibos")]


def dims(spark: SparkSession) -> dict[str, DataFrame]:
    """The goods dimensions with 1-based identity keys."""
    return {
        "ref_doc_types": spark.createDataFrame(
            [(i + 1, n) for i, n in enumerate(DOC_TYPES)], "id int, doc_type_name string"),
        "ref_good_groups": spark.createDataFrame(
            [(i + 1, n) for i, n in enumerate(GOOD_GROUPS)], "id int, good_group_name string"),
        "ref_goods": spark.createDataFrame(
            [(i + 1, g, n) for i, (g, n) in enumerate(GOODS)],
            "id int, id_good_group int, good_name string"),
    }
