"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wharf.session import work_dir
from wharf.sources.tables import delete_path

ROW = "_row"                                    # an operator's untouched input row
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = "[\\x20\\x09-\\x0D]"                    # the white space of the word and line rules
NOT_SPACE = "[^\\x20\\x09-\\x0D]+"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000                               # documents handed to a Python worker at a time
PART_BITS = 33                                  # bits of monotonically_increasing_id below the partition


_collecting: list[list[str]] = []


@contextmanager
def collected(paths: list[str]) -> Iterator[None]:
    """Add the folders of the tables written meanwhile to ``paths``."""
    _collecting.append(paths)
    try:
        yield
    finally:
        _collecting.pop()


def _table_name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete collected tables, once what was computed from them is written."""
    while paths:
        path = paths.pop()
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
        delete_path(spark, path)


def work_table(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table, among the collected ones."""
    path = work_dir(spark, name)
    for paths in _collecting:
        paths.append(path)
    return path


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    usual = spark.conf.get(BATCH)
    spark.conf.set(BATCH, min(int(usual), BATCH_ROWS) if int(usual) > 0 else BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH, usual)


def materialise(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Later passes then see the same rows and row numbers whatever executors
    are lost meanwhile, and do not repeat the work above. Python stages get
    smaller batches meanwhile, since a row may hold a long text. ``options``
    are the writer's, for its codec.
    """
    spark = df.sparkSession
    path = work_table(spark, name)
    with _small_batches(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``materialise``, with the rows dealt into buckets by ``key`` once:
    joins on it then read them without a shuffle. Rows should have different
    keys, since a bucket is one task's. As many buckets as shuffle partitions.
    """
    spark = df.sparkSession
    path = work_table(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with _small_batches(spark):
        (df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path)
         .saveAsTable(_table_name(path)))
    return spark.table(_table_name(path))


def pack(df: DataFrame, **cols: Column) -> DataFrame:
    """The input row as one struct beside the operator's own columns, so that
    no name of the input can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW),
                     *[c.alias(n) for n, c in cols.items()])


def unpack(df: DataFrame, *outputs: str) -> DataFrame:
    """Input columns again, then ``outputs``; an input column with the name of
    an output (in any case) gives way to it."""
    taken = {o.lower() for o in outputs}
    fields = [f for f in df.schema[ROW].dataType.names if f.lower() not in taken]
    return df.select(*[F.col(f"{ROW}.`{f}`").alias(f) for f in fields], *outputs)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else left alone (``lower`` would also turn
    other alphabets; it is used where the text has nothing else)."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def count_words(c: Column) -> Column:
    """Number of runs of non-space characters; null has none."""
    return F.coalesce(F.regexp_count(c, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with their place in their group (``index``) and its size (``n``).

    One range sort; a group that spans several ranges, however large, is
    numbered by adding up the rows of the ranges before, one number a range.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    ordered = materialise(rows.withColumn("_tie", F.monotonically_increasing_id())
                          .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                          .withColumn("place", F.monotonically_increasing_id()), name)
    ordered = ordered.withColumn("part", F.shiftright("place", PART_BITS))
    runs = ordered.groupBy(group, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy(group)
    runs = runs.select(F.col(group).alias("_group"), F.col("part").alias("_part"), F.sum("rows").over(own).alias("n"),
                       (F.sum("rows").over(own.orderBy("part")) - F.col("rows") - F.col("first")).alias("shift"))
    return (ordered.join(runs, ordered[group].eqNullSafe(runs["_group"]) & (ordered["part"] == runs["_part"]))
            .withColumn("index", F.col("place") + F.col("shift")).drop("_group", "_part", "shift", "place", "part"))


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of equal ``keys``, from sorted batches; only the rows of the last group are held back."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None and rest.num_rows:
            joined = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()
            batch = joined[0] if len(joined) == 1 else pa.concat_batches(joined)
        values = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        at = 0
        for i in range(1, len(values)):
            if values[i] != values[i - 1]:
                yield batch.slice(at, i - at)
                at = i
        rest = batch.slice(at)
    if rest is not None and rest.num_rows:
        yield rest
