"""Table helpers on plain parquet folders.

* Date-partitioned tables restated over a rolling window of days.
* Create-if-absent, replace, append by column name, drop, temp views.

Tables that are merged by key or replaced as a whole under a name are in
``wharf.sources.catalog``.

File-system calls go through Hadoop's FileSystem API, so the same code
works on HDFS, object stores and local disk. Its errors are raised: a store
that cannot be asked is never taken for an absent table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators.incremental import window_days


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem, path and JVM for ``path`` (any scheme)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p, sc._jvm


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files at or below ``path``."""
    fs, p, _ = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path``; none if it does not exist."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def replace_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """CREATE OR REPLACE of a folder: ``df``, which may read the table itself, becomes its
    content. It is written once, beside the table, which is renamed away and back if the
    new one cannot take its place; a plan that fails leaves it as it was. Returns the new content."""
    mark, path = uuid.uuid4().hex[:12], path.rstrip("/")
    staged, old = f"{path}__next-{mark}", f"{path}__old-{mark}"
    try:
        df.write.parquet(staged)
        _put_in_place(spark, staged, path, old)
    except Exception:
        delete_path(spark, staged)
        raise
    delete_path(spark, old)
    return spark.read.schema(df.schema).parquet(path)


def _put_in_place(spark: SparkSession, staged: str, path: str, old: str) -> None:
    fs, there, jvm = _fs(spark, path)
    to = jvm.org.apache.hadoop.fs.Path
    had = fs.exists(there)
    if had and not fs.rename(there, to(old)):
        raise OSError(f"{path} cannot be renamed")
    if not fs.rename(to(staged), there):
        if had:
            fs.rename(to(old), there)
        raise OSError(f"{staged} cannot be renamed to {path}")


def drop_table(spark: SparkSession, path: str) -> None:
    """DROP TABLE IF EXISTS."""
    delete_path(spark, path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty parquet table with ``schema`` when absent; return it.
    An existing table is never written to."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, columns: Sequence[str] | None = None,
           partition_by: Sequence[str] = ()) -> None:
    """Append rows by column *name* (the target's order), never by position."""
    out = df.select(*columns) if columns else df
    w = out.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def replace_window_partitions(spark: SparkSession, root: str, new: DataFrame, date_col: str,
                              run_date, days: int) -> None:
    """Restate the last ``days`` days of a table partitioned by ``date_col``.

    Window days present in ``new`` are replaced partition by partition
    (dynamic partition overwrite: other partitions are not touched); window
    days absent from ``new`` are removed, so an emptied day does not keep
    stale rows. ``new`` is evaluated once: the rows of each day are counted
    while they are written, clustered by day so that a day has few files.
    """
    win = window_days(run_date, days)
    seen = Observation("window_days")
    new_in = (new.where(F.col(date_col).isin(win))
              .observe(seen, *[F.count_if(F.col(date_col) == F.lit(d)).alias(d.isoformat()) for d in win]))
    (new_in.hint("rebalance", date_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(root))
    rows = seen.get
    for d in win:
        if not rows.get(d.isoformat()):
            delete_path(spark, f"{root.rstrip('/')}/{date_col}={d.isoformat()}")
