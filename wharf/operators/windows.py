"""Window operators: top-1 per group, previous-N-day counts, and compaction
of validity intervals.

Spark does not split a window partition across tasks, so each operator is
shaped so that the rows one window partition holds are bounded:
* top-1 uses ``row_number() ... = 1``, which Spark plans as a partial
  ``WindowGroupLimit`` before the shuffle (at most one row per group and
  map task reaches the reducer);
* the previous-days count windows over (key, day) counts, at most one row
  per calendar day and key, then joins back (AQE splits a skewed join);
* compaction windows over the versions of a key within a date range, and
  over one row for each range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.functions.columns import OPEN_END


def top1_per_group(df: DataFrame, partition_by: Sequence[Column | str],
                   order_by: Sequence[Column], rank_col: str = "rnk") -> DataFrame:
    """Rows ranked first in each group. ``order_by`` should end with a
    unique key so that ties repeat."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def prev_days_count(tx: DataFrame, key: str, day: str, lo: int = 7, hi: int = 1,
                    out: str = "trans_prev_7d") -> DataFrame:
    """For every row, the number of rows of the same ``key`` dated within
    [day - lo, day - hi] (the row's own day excluded when ``hi`` ≥ 1).

    Rows with a NULL key or day get 0 (an equality or BETWEEN with NULL
    never matches). Plan: count per (key, day) with map-side combine, a
    RANGE window over those day counts, and an equi-join back on (key, day).
    Rows without key or day are kept out of the join, where they would all
    fall into one partition.
    """
    dated = F.col(key).isNotNull() & F.col(day).isNotNull()
    valid = tx.where(dated)
    per_day = (valid.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_dn", F.unix_date(F.col(day))))
    w = (Window.partitionBy(key).orderBy("_dn").rangeBetween(-lo, -hi))
    prev = per_day.select(key, day, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias(out))
    undated = tx.where(~dated).withColumn(out, F.lit(0).cast("bigint"))
    return valid.join(prev, on=[key, day]).withColumn(out, F.col(out).cast("bigint")).unionByName(undated)


def _same(a: Column, b: Column) -> Column:
    """Attribute equality with NULL ≡ '' (as the reference's text key does)."""
    return F.coalesce(a.cast("string"), F.lit("")) == F.coalesce(b.cast("string"), F.lit(""))


def compact_dim(df: DataFrame, key: str, attrs: Sequence[str], from_col: str,
                to_col: str = "actual_to_dt", tiebreak: Sequence[str] = (), span: str = "month") -> DataFrame:
    """Merge consecutive versions with equal attributes into one interval.

    Step 1: compare each row with the previous version of its key (lag) and
    keep the first row and rows whose attributes changed. Step 2: over the
    kept rows, the end date is the next kept start minus one day, or
    9999-12-31. The input's own end dates are not used, so gaps close.

    Both steps have two levels, so that a key with a third of all versions
    does not meet in one task: rows are compared within date ranges of a key
    (``span``: any unit of ``trunc``), and only each range's last version and
    first kept start, one row a range, go over its edge to the next range.

    Attributes are compared column by column (NULL ≡ ''), which avoids the
    collisions of a '/'-joined text key. Equal start dates are ordered by
    ``tiebreak``, then by the attributes.
    """
    order = [F.col(from_col), *[F.col(c) for c in tiebreak], *[F.col(c) for c in attrs if c not in tiebreak]]
    span_of = F.trunc(F.col(from_col).cast("date"), span)
    own = Window.partitionBy(key, "_span").orderBy(*order)
    over_spans = Window.partitionBy("_key").orderBy("_at")
    here = F.col(key).eqNullSafe(F.col("_key")) & F.col("_span").eqNullSafe(F.col("_at"))

    rows = df.withColumn("_span", span_of).withColumn("_attrs", F.struct(*attrs))
    rows = rows.withColumns({"_before": F.lag("_attrs").over(own), "_no": F.row_number().over(own),
                             "_last": F.lead(F.lit(1)).over(own).isNull()})
    carried = (rows.where("_last").select(F.col(key).alias("_key"), F.col("_span").alias("_at"), "_attrs")
               .select("_key", "_at", F.lag("_attrs").over(over_spans).alias("_carried")))
    before = F.when(F.col("_no") == 1, F.col("_carried")).otherwise(F.col("_before"))
    unchanged = reduce(Column.__and__, [_same(F.col(f"_attrs.{a}"), F.col(f"_prev.{a}")) for a in attrs])
    kept = (rows.join(carried, here).withColumn("_prev", before).drop("_key", "_at")
            .where(F.col("_prev").isNull() | ~unchanged))

    starts = (kept.groupBy(F.col(key).alias("_key"), F.col("_span").alias("_at")).agg(F.min(from_col).alias("_start"))
              .select("_key", "_at", F.lead("_start").over(over_spans).alias("_next_span")))
    end = F.coalesce(F.lead(from_col).over(own), F.col("_next_span"))
    return kept.join(starts, here).select(
        key, from_col, F.coalesce(F.date_sub(end, 1), F.lit(OPEN_END)).alias(to_col), *attrs)


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     payload: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per ``keys``, as an aggregate
    (max of a struct) so a hot key is combined map-side."""
    s = F.max(F.struct(*[F.col(c) for c in list(order) + list(payload)])).alias("_m")
    return df.groupBy(*keys).agg(s).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in
                                                     list(order) + list(payload)])
