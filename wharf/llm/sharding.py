"""Sharding by a two-pass external shuffle.

Pass 1 scatters the records: a seeded hash of the id picks the shard by
highest random weight (adding a shard takes rows only into the new one) and a
second one a bucket of the shard that fits in memory. Pass 2 gathers one bucket
at a time, Fisher-Yates shuffles it (Spark's ``shuffle``) and numbers its rows.

Only a bucket ever meets in one task. A bucket that repeated ids have filled
beyond its size is split again by row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import materialise, pack, unpack, work_table

SEED = 20240202
BUCKET_BYTES = 16 << 20
LAW = "key"


def highest_weight(key: Column, n: int, seed: int = SEED) -> Column:
    """The shard of 0..n-1 whose seeded hash with the key is highest. A null key
    is a key like any other."""
    weights = F.array(*[F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("w"), F.lit(i).alias("i"))
                        for i in range(n)])
    return F.array_max(weights)["i"]


def shard(docs: DataFrame, n_shards: int, size: Column, key: str = "doc_id",
          bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` with size, law (``key``), shard, slot (its place in
    the shard, gapless from 0) and grown_shard (its shard if there were one more).

    The shard depends on the id and the shard count alone. Null ids share one
    shard; equal ids and repeated rows share theirs, each row with a slot of its
    own. Null size counts as 0 bytes. Empty table: no rows. Columns named like
    an added one give way to it. Columns must be orderable (no maps).
    """
    if n_shards < 1:
        raise ValueError("at least one shard")
    k = F.col(key)
    one = materialise(pack(docs, size=F.coalesce(size, F.lit(0)).cast("long"),
                           shard=highest_weight(k, n_shards, seed),
                           grown_shard=highest_weight(k, n_shards + 1, seed),
                           hash=F.xxhash64(F.lit(seed + 1), k), row=F.monotonically_increasing_id()),
                      "sharding-pass1", compression="zstd")
    total = one.agg(F.sum("size")).head()[0] or 0
    per_shard = max(1, -(-total // (n_shards * bucket_bytes)))
    one = one.withColumn("bucket", F.pmod(F.col("hash"), F.lit(per_shard)))
    # the tables of buckets are written: Spark then knows that they are small, and
    # the records themselves are shuffled once only
    split = materialise(one.groupBy(F.col("shard").alias("f_shard"), F.col("bucket").alias("f_bucket"))
                        .agg(F.ceil(F.sum("size") / F.lit(2.0 * bucket_bytes)).alias("parts"))
                        .where("parts > 1"), "sharding-split")
    one = (one.join(split, (F.col("shard") == F.col("f_shard")) & (F.col("bucket") == F.col("f_bucket")), "left")
           .withColumn("part", F.when(F.col("parts") > 1, F.pmod(
               F.xxhash64(F.lit(seed + 2), "row"), F.col("parts"))).otherwise(F.lit(0))))
    leaf = ["shard", "bucket", "part"]
    before = Window.partitionBy("shard").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    counts = one.groupBy(*leaf).agg(F.count("*").alias("n"))
    starts = materialise(counts.select(*leaf, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")),
                         "sharding-starts")
    record = F.struct("hash", "row", "size", "grown_shard", "start", "_row")
    n_leaves = max(1, n_shards * per_shard)
    two = (one.join(starts, leaf)
           # as many partitions as buckets, a number that AQE leaves alone: shuffle()
           # draws from the seed and the partition, so reruns agree
           .repartition(n_leaves, *leaf)
           .groupBy(*leaf).agg(F.array_sort(F.collect_list(record)).alias("records"))
           .sortWithinPartitions(*leaf)
           .select("shard", F.posexplode(F.shuffle("records", F.lit(seed))).alias("at", "r"))
           .select("shard", "r.size", "r.grown_shard", "r._row", F.lit(LAW).alias("law"),
                   (F.col("r.start") + F.col("at")).alias("slot")))
    return unpack(two, "size", "law", "shard", "slot", "grown_shard")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in files sorted by slot. What ``shard``
    returns is dealt out by bucket already, and a bucket's slots follow each
    other, so its texts are not shuffled again and many tasks write a large shard."""
    (sharded.sortWithinPartitions("shard", "slot")
     .write.mode("overwrite").partitionBy("shard").parquet(path))


def written_shards(sharded: DataFrame, name: str = "shards") -> DataFrame:
    """The records of the shard files, written to the cluster's shared folder."""
    spark = sharded.sparkSession
    path = work_table(spark, name)
    write_shards(sharded, path)
    return spark.read.schema(sharded.schema).parquet(path)
