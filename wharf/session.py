"""Session settings and the shared work folder.

Jobs that must cut lineage or keep state between runs (two-run loads,
versioned tables) write under the cluster's ``spark.checkpoint.dir``.
That folder is read from the session; a local fallback is only used
when Spark itself runs in local mode (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone pinned so that dates and
# epoch conversions repeat; ANSI stays on (Spark 4 default) and the code
# uses try_* where the reference is lenient.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    builder = SparkSession.builder.appName("wharf")
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Runtime SQL settings also apply when the session already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def _spark_context(spark: SparkSession):
    """The SparkContext of a classic session, None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def _checkpoint_root(spark: SparkSession) -> str:
    sc = _spark_context(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if root:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    root = tempfile.mkdtemp(prefix="wharf-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/wharf/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Read one of the driver's parquet tables (no schema inference beyond
    the parquet footer; filters and projections reach the scan)."""
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df):
    """Deal ``df`` out over the cores when it is read from fewer files than there
    are cores; used before heavy work on each row. Only the file listing is
    looked at: no job is started, and large inputs get no shuffle."""
    sc = _spark_context(df.sparkSession)
    if sc is None:
        return df
    cores = sc.defaultParallelism
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


# --- sizing for a given data volume -------------------------------------------
MB = 1024 * 1024


def size_conf(input_bytes: int, target_partition_bytes: int = 256 * MB,
              max_split_bytes: int = 512 * MB) -> dict[str, str]:
    """Shuffle and scan settings for jobs reading about ``input_bytes``:
    enough shuffle partitions that each holds ~``target_partition_bytes``
    (AQE coalesces below that at runtime), scan splits no larger than
    ``max_split_bytes``, and skew-join splitting above 4× the target."""
    parts = max(1, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(min(max_split_bytes, target_partition_bytes)),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def bucket_count(table_bytes: int, target_file_bytes: int = 512 * MB, minimum: int = 8) -> int:
    """Buckets for a key-bucketed table so that one bucket (one file per
    write) stays near ``target_file_bytes``; a power of two."""
    need = max(minimum, -(-table_bytes // target_file_bytes))
    return 1 << (need - 1).bit_length()


BUCKET_ROWS, BUCKET_SOURCE_BYTES = 1 << 18, 32 * MB


def merge_buckets(rows: int, source_bytes: int) -> int:
    """Buckets for a table that is merged by key: a merge sorts a bucket's rows, old and new, several times in one
    task, so they are counted by rows, as the bytes of a well-compressed file say little about them. The source's
    bytes count where rows are very wide."""
    return max(bucket_count(rows, BUCKET_ROWS), bucket_count(source_bytes, BUCKET_SOURCE_BYTES))


@contextmanager
def tasks_for(spark: SparkSession, buckets: int):
    """Jobs run inside read and shuffle in at least as many tasks as ``buckets``, if there is enough to deal out.
    A shuffle to more than 200 buckets holds all rows of a map task in memory, and so does a partial aggregate its
    groups; splits and coalesced partitions are otherwise cut by compressed bytes, which say little about rows."""
    cores, shuffle = spark.sparkContext.defaultParallelism, "spark.sql.shuffle.partitions"
    usual = {"spark.sql.files.minPartitionNum": cores, shuffle: int(spark.conf.get(shuffle)),
             "spark.sql.adaptive.coalescePartitions.minPartitionNum": cores}
    before = {k: spark.conf.get(k, None) for k in usual}
    try:
        for k, n in usual.items():
            spark.conf.set(k, str(max(buckets, int(before[k] or n))))
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
