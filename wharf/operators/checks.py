"""Data checks: not-null, unique, accepted values, relationships, row
expectations and source/target reconciliation.

``run_checks`` evaluates all rules of one table in one scan: every row turns
into (rule, key) pairs, one for each uniqueness rule and relationship it takes
part in and one for each row rule it breaks; the pairs are counted, combined
before the shuffle, and joined once to the keys of all parents. The result is
a DataFrame ``(rule, column, failing_rows)`` — 0 means the check passed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RESULT_SCHEMA = "rule string, column string, failing_rows bigint"


@dataclass(frozen=True)
class NotNull:
    cols: Sequence[str]


@dataclass(frozen=True)
class Unique:
    """Keys occurring more than once (NULL keys ignored); failing_rows counts
    duplicated key values."""
    cols: Sequence[str]


@dataclass(frozen=True)
class AcceptedValues:
    """Rows whose value is outside ``values`` (NULL passes)."""
    col: str
    values: Sequence


@dataclass(frozen=True)
class Relationship:
    """Child rows whose key has no parent (NULL passes)."""
    col: str
    parent: DataFrame = field(compare=False)
    parent_col: str = ""


@dataclass(frozen=True)
class Expect:
    """Rows where ``condition`` is false (NULL counts as failing)."""
    name: str
    condition: Column = field(compare=False)


def _key(*cols: Column) -> Column:
    """A key of any columns in one type: their texts, null kept apart from every text."""
    return F.array(*[c.cast("string") for c in cols])


def _plain(df: DataFrame, name: str) -> Column:
    """The column, with the two zeros of a floating type as one."""
    c = F.col(name)
    return F.when(c == 0, F.lit(0.0)).otherwise(c) if df.schema[name].dataType.simpleString() in ("float", "double") else c


def run_checks(spark: SparkSession, df: DataFrame, rules: Sequence) -> DataFrame:
    """Failing rows (of a uniqueness rule: failing keys) of every rule, one row each."""
    names: list[tuple[str, str, str]] = []          # kind of count, rule, column
    pairs: list[Column] = []
    parents: list[DataFrame] = []

    def add(kind: str, rule: str, column: str, when: Column, key: Column) -> None:
        pairs.append(F.when(when, F.struct(F.lit(len(names)).alias("id"), key.alias("key"))))
        names.append((kind, rule, column))

    broken = F.lit(None).cast("array<string>")
    for r in rules:
        if isinstance(r, NotNull):
            for c in r.cols:
                add("rows", "not_null", c, F.col(c).isNull(), broken)
        elif isinstance(r, AcceptedValues):
            add("rows", "accepted_values", r.col, F.col(r.col).isNotNull() & ~F.col(r.col).isin(list(r.values)), broken)
        elif isinstance(r, Expect):
            add("rows", "expect", r.name, ~F.coalesce(r.condition, F.lit(False)), broken)
        elif isinstance(r, Unique):
            add("unique", "unique", ",".join(r.cols), F.coalesce(*[F.col(c) for c in r.cols]).isNotNull()
                if len(r.cols) == 1 else F.greatest(*[F.col(c).isNotNull() for c in r.cols]),
                _key(*[_plain(df, c) for c in r.cols]))
        elif isinstance(r, Relationship):
            there = r.parent.select(F.col(r.parent_col or r.col).try_cast(df.schema[r.col].dataType).alias("k"))
            parents.append(there.where("k IS NOT NULL").select(
                F.lit(len(names)).alias("_id"), _key(_plain(there, "k")).alias("_key")).distinct())
            add("orphans", "relationships", r.col, F.col(r.col).isNotNull(), _key(_plain(df, r.col)))
        else:
            raise TypeError(f"unknown rule {r!r}")
    if not names:
        return spark.createDataFrame([], RESULT_SCHEMA)
    counted = (df.select(F.explode(F.filter(F.array(*pairs), lambda p: p.isNotNull())).alias("p"))
               .groupBy(F.col("p.id").alias("id"), F.col("p.key").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    found = F.lit(False)
    if parents:
        counted = counted.join(reduce(DataFrame.unionByName, parents),
                               (F.col("id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left")
        found = F.col("_id").isNotNull()
    of = lambda kind: F.col("id").isin([i for i, n in enumerate(names) if n[0] == kind])
    failing = (F.when(of("unique"), (F.col("n") > 1).cast("long")).when(of("orphans") & found, F.lit(0))
               .otherwise(F.col("n")))
    per_rule = counted.groupBy("id").agg(F.sum(failing).alias("failing"))
    listed = F.explode(F.array(*[F.struct(F.lit(i).alias("_no"), F.lit(rule).alias("rule"), F.lit(column).alias("column"))
                                 for i, (_, rule, column) in enumerate(names)]))
    every = spark.range(1).select(listed.alias("r")).select("r.*")
    return every.join(per_rule, F.col("_no") == F.col("id"), "left").select(
        "rule", "column", F.coalesce("failing", F.lit(0)).cast("bigint").alias("failing_rows"))


def match_counts(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` and how many of them found a partner in ``right``
    (``right`` deduplicated on the key first, so partners never multiply;
    ``left`` counted per key first, so a hot key is one row in the join)."""
    rk = right_key or key
    r = right.select(F.col(rk).alias("_rk")).distinct()
    per_key = left.groupBy(F.col(key).alias("_lk")).agg(F.count(F.lit(1)).alias("_n"))
    j = per_key.join(r, F.col("_lk") == F.col("_rk"), "left")
    return j.agg(F.sum("_n").cast("bigint").alias("total_rows"),
                 F.coalesce(F.sum(F.when(F.col("_rk").isNotNull(), F.col("_n"))), F.lit(0))
                 .cast("bigint").alias("matched_rows"))


def reconcile(pairs: Sequence[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """Row counts of source and target per table name, and whether they agree."""
    out = None
    for name, src, tgt in pairs:
        s = src.agg(F.count(F.lit(1)).alias("n")).select(F.lit("source").alias("side"), "n")
        t = tgt.agg(F.count(F.lit(1)).alias("n")).select(F.lit("target").alias("side"), "n")
        one = s.unionByName(t).agg(
            F.max(F.when(F.col("side") == "source", F.col("n"))).alias("source_count"),
            F.max(F.when(F.col("side") == "target", F.col("n"))).alias("target_count"))
        one = one.select(F.lit(name).alias("table_name"), "source_count", "target_count",
                         (F.col("source_count") == F.col("target_count")).alias("counts_match"))
        out = one if out is None else out.unionByName(one)
    return out


def _totals_long(df: DataFrame, sum_cols, side: str) -> DataFrame:
    from wharf.operators.aggregates import control_totals
    metrics = ["rows_count"] + [f"{c}_sum" for c in sum_cols]
    pairs = ", ".join(f"'{m}', CAST(`{m}` AS BIGINT)" for m in metrics)
    return (control_totals(df, sum_cols)
            .selectExpr(f"stack({len(metrics)}, {pairs}) AS (metric, value)")
            .withColumn("side", F.lit(side)))


def _compare(both: DataFrame) -> DataFrame:
    out = both.groupBy("metric").agg(
        F.max(F.when(F.col("side") == "before", F.col("value"))).alias("before_value"),
        F.max(F.when(F.col("side") == "after", F.col("value"))).alias("after_value"))
    return out.withColumn("matches", F.col("before_value").eqNullSafe(F.col("after_value")))


def control_diff(before: DataFrame, after: DataFrame, sum_cols) -> DataFrame:
    """Control totals (row count and column sums) of the same data before
    and after a load, one row per metric with both values and whether they
    agree. Each side is one aggregation pass; the comparison is on two rows."""
    return _compare(_totals_long(before, sum_cols, "before")
                    .unionByName(_totals_long(after, sum_cols, "after")))


def load_with_totals(df: DataFrame, path: str, sum_cols, name: str = "load_totals") -> dict:
    """Append ``df`` to the parquet table at ``path`` and return its control
    totals, measured by ``DataFrame.observe`` while the rows are written: no
    second pass over the source."""
    from pyspark.sql import Observation
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_count"),
                          *[F.sum(c).alias(f"{c}_sum") for c in sum_cols])
    observed.write.mode("append").parquet(path)
    return obs.get


def control_diff_loaded(spark, before: dict, after: DataFrame, sum_cols) -> DataFrame:
    """``control_diff`` with the before-side totals already measured (see
    ``load_with_totals``); they are a handful of values."""
    metrics = ["rows_count"] + [f"{c}_sum" for c in sum_cols]
    rows = [(m, None if before.get(m) is None else int(before[m]), "before") for m in metrics]
    b = spark.createDataFrame(rows, "metric string, value bigint, side string")
    return _compare(b.unionByName(_totals_long(after, sum_cols, "after")))
