"""Aggregations: profiles, frequencies, conversions, period totals,
category totals and control totals.

All are ``groupBy``/``agg`` plans, so Spark combines partial aggregates
map-side before the shuffle; a key holding a large share of the rows costs
one partial row per map task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.functions.columns import NULL_TEXT, lit_date, null_safe_text, ratio


def money_sum(c, name: str | None = None) -> Column:
    """Money sum over decimals of ten places, the same in any order; only the
    total is rounded, to millionths of a unit, and returned as double units."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(F.sum(col.cast("decimal(38,10)")), 6).cast("double")
    return out.alias(name) if name else out


# -- profile ------------------------------------------------------------------------

def profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row: ``rows_count`` and ``<c>_distinct_count`` for each column,
    NULL counted as one value. ``approx=True`` takes HyperLogLog sketches.

    The exact counts group (column number, value) pairs, so what the map side
    cannot combine is shuffled as narrow pairs and a column of few values as a
    few rows a task; several distinct counts in one ``agg`` would shuffle rows
    as wide as all the columns. One pass over ``df``."""
    if approx:
        return df.agg(F.count(F.lit(1)).alias("rows_count"),
                      *[F.approx_count_distinct(null_safe_text(c)).alias(f"{c}_distinct_count") for c in cols])
    if not cols:
        return df.agg(F.count(F.lit(1)).alias("rows_count"))
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), null_safe_text(c).alias("v"))
                                for i, c in enumerate(cols)]))
    values = (df.select(pairs.alias("p")).groupBy(F.col("p.i").alias("i"), F.col("p.v").alias("v"))
              .agg(F.count(F.lit(1)).alias("n")))
    return values.agg(F.coalesce(F.sum(F.when(F.col("i") == 0, F.col("n"))), F.lit(0)).alias("rows_count"),
                      *[F.count_if(F.col("i") == i).alias(f"{c}_distinct_count") for i, c in enumerate(cols)])


#: Relative standard error of a distinct count's sketch with 2 ** SKETCH_LG_K slots (bound of the estimator: 1.04).
SKETCH_LG_K = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG_K / 2)


def daily_sketches(df: DataFrame, day: Column, cols: Sequence[str], lg_k: int = SKETCH_LG_K) -> DataFrame:
    """One row a day: its row count and a mergeable HyperLogLog sketch of each column's values (NULL is one
    value, as in ``profile``). Kept beside the data, a new day costs only its own rows."""
    return df.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("rows_count"),
        *[F.hll_sketch_agg(null_safe_text(c), F.lit(lg_k)).alias(f"{c}_sketch") for c in cols])


def profile_of_sketches(sketches: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``profile`` of all days together, from their sketches alone, and the number of days; the counts are
    estimates with a relative standard error of ``SKETCH_ERROR``."""
    return sketches.agg(F.sum("rows_count").alias("rows_count"), F.count(F.lit(1)).alias("days"),
                        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_distinct_count")
                          for c in cols])


def constant_columns(profile_row: DataFrame) -> DataFrame:
    """Columns whose distinct count is 1, from a ``profile`` result."""
    dcols = [c for c in profile_row.columns if c.endswith("_distinct_count")]
    pairs = ", ".join(f"'{c[: -len('_distinct_count')]}', `{c}`" for c in dcols)
    long = profile_row.selectExpr(f"stack({len(dcols)}, {pairs}) AS (column_name, distinct_count)")
    return long.where(F.col("distinct_count") == 1).select("column_name")


# -- frequencies ------------------------------------------------------------------------

def frequency(df: DataFrame, col: str, null_as_text: bool = False,
              sum_col: str | None = None) -> DataFrame:
    """Count per value (optionally NULL shown as 'NULL', plus a sum),
    largest count first."""
    key = null_safe_text(col).alias(col) if null_as_text else F.col(col)
    aggs = [F.count(F.lit(1)).alias("cnt")]
    if sum_col:
        aggs.append(F.sum(sum_col).alias(f"{sum_col}_sum"))
    return df.groupBy(key).agg(*aggs).orderBy(F.desc("cnt"))


def keys_with_many(df: DataFrame, key: str, col: str, min_distinct: int = 2) -> DataFrame:
    """Keys with at least ``min_distinct`` distinct values of ``col`` (HAVING)."""
    name = f"{col}s_cnt"
    return (df.groupBy(key).agg(F.count_distinct(col).alias(name))
            .where(F.col(name) >= min_distinct).orderBy(F.desc(name)))


def distinct_counts(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Distinct count of each of ``cols`` per ``keys``."""
    return df.groupBy(*keys).agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in cols])


# -- conversions ---------------------------------------------------------------------------

def paid_conversion(df: DataFrame, by: Sequence[Column | str], flag: str = "paid_session") -> DataFrame:
    """Sessions, paid sessions and their ratio per group."""
    return (df.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("sessions_cnt"), F.sum(flag).cast("bigint").alias(flag))
            .withColumn("paid_sessions_conversion", ratio(flag, "sessions_cnt")))


def spender_conversion(df: DataFrame, group: str, user: str, spender: str) -> DataFrame:
    """Two-level: dedupe to (group, user, spender), then per group
    ``sum(spender) / count(distinct user)``. A NULL user adds to the sum but
    not to the distinct count, as in SQL."""
    dedup = df.select(group, user, spender).distinct()
    return (dedup.groupBy(group)
            .agg(F.count_distinct(user).alias("user_id_count"),
                 F.sum(F.col(spender).cast("int")).cast("bigint").alias("spender_users_count"))
            .withColumn("spender_users_conversion", ratio("spender_users_count", "user_id_count")))


def revenue_by(df: DataFrame, keys: Sequence[str], cents_col: str) -> DataFrame:
    """Count, sum, max, min, avg of an amount kept in cents, shown in whole units.
    NULL keys shown as 'NULL'. The average is sum/count of exact integers."""
    c = F.col(cents_col)
    g = df.groupBy(*[null_safe_text(k).alias(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(c).alias("_s"), F.count(c).alias("_n"), F.max(c).alias("_mx"), F.min(c).alias("_mn"))
    unit = F.lit(100.0)
    return g.select(*keys, "cnt",
                    (F.col("_s").cast("double") / unit).alias("sum_amount"),
                    (F.col("_mx").cast("double") / unit).alias("max_amount"),
                    (F.col("_mn").cast("double") / unit).alias("min_amount"),
                    (ratio("_s", "_n") / unit).alias("avg_amount"))


# -- totals -----------------------------------------------------------------------------------

def control_totals(df: DataFrame, sum_cols: Sequence[str]) -> DataFrame:
    """One row: row count and the sum of each column."""
    return df.agg(F.count(F.lit(1)).alias("rows_count"),
                  *[F.sum(c).alias(f"{c}_sum") for c in sum_cols])


def category_totals(tx: DataFrame, users: DataFrame, user_key: str = "user_id",
                    category: str = "transaction_category_id",
                    amount: str = "transaction_amount") -> DataFrame:
    """Sum and distinct users per category over the transactions of the
    given (active) users, largest sum first.

    Transactions are first summed per (user, category) — a map-side
    combined aggregate, so a user holding a large share of the rows becomes
    one row per category before any join. The membership test is then a
    left semi join (duplicate user rows never multiply sums), and since each
    (user, category) is one row, distinct users are a plain count.
    """
    per_user = tx.groupBy(user_key, category).agg(F.sum(amount).alias("_s"))
    kept = per_user.join(users.select(user_key), on=user_key, how="left_semi")
    return (kept.groupBy(category)
            .agg(F.sum("_s").alias("sum_amount"), F.count(user_key).alias("num_users"))
            .orderBy(F.desc("sum_amount")))


def occupation_counts(df: DataFrame, col: str = "occupation") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("cnt")).orderBy("cnt", F.col(col).asc_nulls_last())


def period_totals(goods: DataFrame, sales: DataFrame, as_of, good_key: str = "id",
                  name: str = "good_name", sale_good: str = "id_good",
                  sale_ts: str = "s_date", amount_cents: str = "amount_cents") -> DataFrame:
    """YTD, MTD, QTD and the same periods a year earlier, per good, at ``as_of``.

    One scan of ``sales`` restricted to the two calendar years involved (the
    range reaches the parquet scan), one aggregate with six conditional sums,
    a left join to the goods (0 where none), then DISTINCT rows by name and
    totals. Amounts are integer cents; results in units.
    """
    a = lit_date(as_of)
    prev = F.add_months(a, -12)          # 29 Feb → 28 Feb
    d = F.to_date(F.col(sale_ts))
    y, m, q = F.year(d), F.month(d), F.quarter(d)
    cur_y = (y == F.year(a)) & (d <= a)
    prev_y = (y == F.year(prev)) & (d <= prev)
    conds = {
        "YTD": cur_y,
        "MTD": cur_y & (m == F.month(a)),
        "QTD": cur_y & (q == F.quarter(a)),
        "PYTD": prev_y,
        "PMTD": prev_y & (m == F.month(a)),
        "PQTD": prev_y & (q == F.quarter(a)),
    }
    start = F.make_date(F.year(prev), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    end = F.date_add(a, 1).cast("timestamp_ntz")
    s = sales.where((F.col(sale_ts) >= start) & (F.col(sale_ts) < end))
    sums = s.groupBy(sale_good).agg(*[
        F.sum(F.when(cond, F.col(amount_cents)).otherwise(F.lit(0))).alias(k)
        for k, cond in conds.items()])
    g = goods.select(F.col(good_key).alias(sale_good), F.col(name))
    out = g.join(sums, on=sale_good, how="left").select(
        name, *[(F.coalesce(F.col(k), F.lit(0)).cast("double") / 100.0).alias(k) for k in conds])
    return out.distinct()


def daily_totals(sales: DataFrame, goods: DataFrame, begin, end, good_key: str = "id",
                 name: str = "good_name", sale_good: str = "id_good", sale_ts: str = "s_date",
                 amount_cents: str = "amount_cents") -> DataFrame:
    """Sum by good name and day for days in [begin, end] (pivot input).

    Sales are summed per (good, day) before the join to the goods, so a hot
    good reaches the join as one row per day; goods sharing a name are
    summed together afterwards."""
    d = F.to_date(F.col(sale_ts))
    s = sales.where((F.col(sale_ts) >= lit_date(begin).cast("timestamp_ntz"))
                    & (F.col(sale_ts) < F.date_add(lit_date(end), 1).cast("timestamp_ntz")))
    per_good = s.groupBy(sale_good, d.alias("dat")).agg(F.sum(amount_cents).alias("_s"))
    g = goods.select(F.col(good_key).alias(sale_good), F.col(name))
    return (per_good.join(g, on=sale_good, how="inner")
            .groupBy(name, "dat").agg(F.sum("_s").alias("sum_amount")))


__all__ = ["NULL_TEXT", "profile", "constant_columns", "frequency", "keys_with_many",
           "distinct_counts", "paid_conversion", "spender_conversion", "revenue_by",
           "control_totals", "category_totals", "occupation_counts", "period_totals",
           "daily_totals", "money_sum", "daily_sketches", "profile_of_sketches"]
