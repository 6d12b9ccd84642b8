"""Tables of Spark's catalog, replaced as a whole and merged by key.

A ``CatalogTable`` with a key is bucketed and sorted by it (``bucketBy`` /
``saveAsTable``). Tables of the same key and bucket count join without a
shuffle, and a merge shuffles the batch only: the table is read by bucket and
written by bucket, one file each.

Content is never changed in place. ``replace`` writes a version of its own
folder under a second name and then swaps it in with one catalog command
(``ALTER TABLE ... SET LOCATION``). Whatever fails before that leaves the table
as it was; readers see the old version or the new one. A new schema or bucket
count needs two renames instead; ``recover`` (called whenever a table is
opened) takes the old version back if a job ended between them. The version
before the current one stays on disk until the next replace, for readers that
have begun with it.

The bucket count belongs to the table and is read from the catalog; it changes
only by ``rebucket``. A merge rewrites the whole table (sequential, without
moving it over the network). Tables so large that a nightly rewrite is too
much should be merged less often, or be split by a coarser key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wharf.operators.incremental import DuplicateKeyError, NullKeyError
from wharf.sources.tables import delete_path, list_dirs

MOST_BUCKETS = 65_536                   # below spark.sql.sources.bucketing.maxBuckets
DUPLICATE_KEY_MSG = "wharf: batch holds a key twice"
NULL_KEY_MSG = "wharf: batch holds a row without a key"
_MARK = "wharf.max."


def open_database(spark: SparkSession, name: str, root: str) -> str:
    """Create database ``name`` at ``root`` if it is absent; returns the name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}'")
    return name


class CatalogTable:
    """``database.table`` with its versions under ``root``."""

    def __init__(self, spark: SparkSession, name: str, root: str, key: str | None = None, buckets: int = 8):
        self.spark, self.name, self.root, self.key = spark, name, root.rstrip("/"), key
        self._first_buckets = min(buckets, MOST_BUCKETS)
        self.recover()

    # -- state in the catalog

    def recover(self) -> None:
        """Finish or undo a swap by rename that a failed job left half done."""
        there = self.spark.catalog.tableExists
        if not there(self.name) and there(f"{self.name}__old"):
            self.spark.sql(f"ALTER TABLE {self.name}__old RENAME TO {self.name}")
        for left in ("__old", "__next"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}{left}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame | None:
        return self.spark.table(self.name) if self.exists() else None

    def _described(self) -> dict[str, str]:
        return {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED {self.name}").collect()}

    @property
    def buckets(self) -> int:
        """The table's own count once it exists, else the one to create it with."""
        return int(self._described()["Num Buckets"]) if self.exists() else self._first_buckets

    def property(self, name: str) -> str | None:
        """A table property, or None."""
        if not self.exists():
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()
        return next((r["value"] for r in rows if r["key"] == name), None)

    def set_property(self, name: str, value: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{name}' = '{value}')")

    def watermark(self, col: str):
        """Newest ``col``; kept as a property by ``merge(track_max=col)``, else scanned. A property that is older
        than the content (a job ended between the two) only makes the next run look at more rows."""
        if not self.exists():
            return None
        kept = self.property(_MARK + col)
        if kept is None:
            return self.read().agg(F.max(col).alias("m")).first()["m"]
        dtype = self.read().schema[col].dataType.simpleString()
        return self.spark.range(1).select(F.lit(kept).cast(dtype).alias("m")).first()["m"]

    # -- replacing

    def _stage(self, df: DataFrame, buckets: int | None) -> str:
        version = f"{self.root}/v-{uuid.uuid4().hex[:12]}"
        writer = df.write.format("parquet").option("path", version).mode("errorifexists")
        if self.key:
            writer = writer.bucketBy(buckets, self.key).sortBy(self.key)
        try:
            writer.saveAsTable(f"{self.name}__next")
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}__next")
            delete_path(self.spark, version)
            raise
        return version

    def _swap(self, version: str, same_layout: bool) -> None:
        run = self.spark.sql
        if not self.exists():
            run(f"ALTER TABLE {self.name}__next RENAME TO {self.name}")
        elif same_layout:
            run(f"ALTER TABLE {self.name} SET LOCATION '{version}'")
            run(f"DROP TABLE {self.name}__next")
        else:
            run(f"ALTER TABLE {self.name} RENAME TO {self.name}__old")
            run(f"ALTER TABLE {self.name}__next RENAME TO {self.name}")
            run(f"DROP TABLE {self.name}__old")
        self.spark.catalog.refreshTable(self.name)

    def replace(self, df: DataFrame, buckets: int | None = None, dealt: bool = False) -> DataFrame:
        """Make ``df``, which may read the table itself, the table's whole content; returns it. The rows of a new
        table are dealt out to its buckets, unless they come ``dealt`` by ``keyed``."""
        before = self._described()["Location"] if self.exists() else None
        now = self.buckets if self.key else None
        n = min(buckets or now, MOST_BUCKETS) if self.key else None
        if self.key and (n != now or before is None and not dealt):
            df = df.repartition(n, F.col(self.key))
        same = before is not None and n == now and df.schema.simpleString() == self.read().schema.simpleString()
        version = self._stage(df, n)
        self._swap(version, same)
        keep = {version.rsplit("/", 1)[1], (before or "").rsplit("/", 1)[-1]}
        for old in list_dirs(self.spark, self.root):
            if old.startswith("v-") and old not in keep:
                delete_path(self.spark, f"{self.root}/{old}")
        return self.read()

    def rebucket(self, buckets: int) -> DataFrame:
        """Deal the table out to another number of buckets, once it has outgrown its own."""
        return self.replace(self.read(), buckets)

    def drop(self) -> None:
        """DROP TABLE IF EXISTS, with all versions."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_path(self.spark, self.root)

    # -- merging

    def keyed(self, batch: DataFrame, unique: bool = True) -> DataFrame:
        """``batch`` dealt out like the table's buckets. With ``unique``, a row without a key or a key that comes
        twice raises inside the job that uses the batch: the count goes over rows that are together anyway."""
        k = F.col(self.key)
        if unique:                     # in the column itself: a filter would give way to a pushed IS NOT NULL
            batch = batch.withColumn(self.key, F.coalesce(k, F.raise_error(F.lit(NULL_KEY_MSG))))
        batch = batch.repartition(self.buckets, k)
        if unique:
            per_key = F.count(F.lit(1)).over(Window.partitionBy(self.key))
            batch = (batch.withColumn("_per_key", per_key)
                     .where(F.when(F.col("_per_key") > 1, F.raise_error(F.lit(DUPLICATE_KEY_MSG)).cast("boolean"))
                            .otherwise(True)).drop("_per_key"))
        return batch

    def merge(self, batch: DataFrame, merge_fn: Callable[[DataFrame, DataFrame | None], DataFrame],
              unique: bool = True, dealt: bool = False, track_max: str | None = None) -> DataFrame:
        """``merge_fn(batch, current rows or None)`` returns the new content. The batch is shuffled to the table's
        buckets unless it comes ``dealt`` like them. ``track_max`` names a change stamp that never decreases; its
        maximum over the written rows becomes the table's watermark."""
        keyed = not dealt
        if keyed:
            batch = self.keyed(batch, unique)
        merged, seen = merge_fn(batch, self.read()), None
        if track_max:
            seen = Observation(f"max_{track_max}")
            merged = merged.observe(seen, F.max(track_max).alias("m"))
        try:
            out = self.replace(merged, dealt=keyed)
        except Exception as e:  # noqa: BLE001 - translate the in-task key checks
            text = str(e)
            if DUPLICATE_KEY_MSG in text:
                raise DuplicateKeyError(f"batch holds a key of {self.key} twice") from None
            if NULL_KEY_MSG in text:
                raise NullKeyError(f"batch holds rows without {self.key}") from None
            raise
        if seen is not None and seen.get.get("m") is not None:
            self.set_property(_MARK + track_max, str(seen.get["m"]))
        return out
