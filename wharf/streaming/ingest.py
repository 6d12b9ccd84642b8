"""Nightly ingestion of raw event files with Structured Streaming.

The file source remembers in its checkpoint which files it has already
read, so each run with ``trigger(availableNow=True)`` picks up exactly the
files that arrived since the previous run, processes them and stops — an
incremental, restartable batch load. Every micro-batch repairs and types
its lines (``wharf.sources.events``) and writes typed rows and problem rows
into folders named by batch id with overwrite, so a batch replayed after a
failure replaces its own output instead of duplicating it.

``merge_event_files`` goes on from there: raw lines are landed first, then
merged by key into a catalog table, and what cannot be loaded is kept in a
quarantine, so that loaded and quarantined rows add up to the input lines.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wharf.operators.incremental import latest_version, merge_versions
from wharf.sources import events as ev
from wharf.sources.catalog import CatalogTable

BATCH_COL = "batch_id"


def ingest_event_files(spark: SparkSession, source_dir: str, target: str, problems: str,
                       checkpoint: str, fields: list[str], types: Mapping[str, str],
                       money: Mapping[str, str], key: str,
                       max_files_per_trigger: int | None = None) -> None:
    """Load every not-yet-seen text file of ``source_dir`` and stop."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        raw = ev.parse_events(batch, fields).persist(StorageLevel.DISK_ONLY)   # parsed once for both sinks
        (ev.type_events(raw, types, money)
         .write.mode("overwrite").parquet(f"{target}/{BATCH_COL}={batch_id}"))
        (ev.problem_rows(raw, types, money, key)
         .write.mode("overwrite").parquet(f"{problems}/{BATCH_COL}={batch_id}"))
        raw.unpersist()

    q = (lines.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """All rows loaded so far (the batch id is kept as a column)."""
    return spark.read.parquet(target)


def merge_event_files(spark: SparkSession, source_dir: str, table: CatalogTable, landing: str, checkpoint: str,
                      fields: list[str], types: Mapping[str, str], money: Mapping[str, str],
                      version: Column, version_col: str = "version") -> None:
    """Load every not-yet-seen text file below ``source_dir``: raw, then merge by ``table.key``.

    ``version`` (over the ``_metadata`` fields of the file, such as its name)
    says which delivery a line belongs to. Per key the row of the latest version
    is kept, so the same file delivered again, under whatever path and however
    late, changes nothing, and a correction in a later one replaces the row.

    Below ``landing``, each batch (folder ``batch_id=N``, overwritten on replay)
    leaves its raw lines in ``raw``, rejected rows in ``quarantine`` (key, problem,
    value, version; unparseable lines, rows without a readable key) and its counts
    in ``loads``. The table remembers the last batch of the stream that it has
    merged; a batch replayed after its merge is not merged twice.
    """
    lines = (spark.readStream.format("text").option("recursiveFileLookup", "true").load(source_dir)
             .select("value", version.alias(version_col)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        at = lambda part: f"{landing}/{part}/{BATCH_COL}={batch_id}"
        merged = f"wharf.merged.{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}"
        if int(table.property(merged) or -1) >= batch_id:
            return
        batch.write.mode("overwrite").parquet(at("raw"))
        raw = spark.read.schema(batch.schema).parquet(at("raw"))
        parsed = ev.parse_events(raw, fields, keep=[version_col]).persist(StorageLevel.DISK_ONLY)
        loaded, kept = Observation("loaded"), F.col(table.key).isNotNull()
        typed = ev.type_events(parsed, types, money).where(kept).observe(loaded, F.count(F.lit(1)).alias("n"))
        table.merge(typed, lambda src, cur: merge_versions(
            latest_version(src, table.key, version_col), cur, table.key, version_col), unique=False)
        quarantined(parsed, types, table.key, version_col).write.mode("overwrite").parquet(at("quarantine"))
        parsed.unpersist()
        (spark.range(1).select(F.lit(loaded.get["n"]).cast("bigint").alias("loaded_rows"))
         .write.mode("overwrite").parquet(at("loads")))
        table.set_property(merged, str(batch_id))

    q = (lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def quarantined(parsed: DataFrame, types: Mapping[str, str], key: str, version_col: str) -> DataFrame:
    """Parsed rows that cannot be loaded, one row for each: unparseable lines with their repaired text, and
    rows without a readable key with the key's text."""
    corrupt = F.col(ev.CORRUPT)
    readable = F.col(key).try_cast(types[key]) if key in types else F.col(key)
    reason = F.when(corrupt.isNotNull(), "unparseable record").when(readable.isNull(), f"no {key}")
    rows = parsed.select(F.filter(F.array(F.struct(
        reason.alias("problem"), F.coalesce(corrupt, F.col(key)).alias("value"), F.col(version_col).alias(version_col))),
        lambda r: r["problem"].isNotNull()).alias("r"))
    return rows.select(F.inline("r"))


def reconcile_loads(spark: SparkSession, landing: str) -> DataFrame:
    """Per batch: input lines (counted in the raw landing), loaded rows (counted by the load), quarantined rows
    (counted in the quarantine), and whether the first is the sum of the others."""
    def counted(part: str, name: str, rows: Column) -> DataFrame:
        return spark.read.parquet(f"{landing}/{part}").where(rows).groupBy(BATCH_COL).agg(F.count(F.lit(1)).alias(name))
    lines = counted("raw", "input_lines", ev.is_record(F.col("value")))
    loads = spark.read.parquet(f"{landing}/loads")
    bad = counted("quarantine", "quarantined_rows", F.lit(True))
    out = lines.join(loads, BATCH_COL, "full_outer").join(bad, BATCH_COL, "full_outer")
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("input_lines", "loaded_rows", "quarantined_rows")}
    return out.select(F.col(BATCH_COL).cast("bigint").alias(BATCH_COL), *[c.alias(k) for k, c in n.items()],
                      (n["input_lines"] == n["loaded_rows"] + n["quarantined_rows"]).alias("matches"))
