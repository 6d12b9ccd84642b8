"""Catalog tables: merges by key without a shuffle of the table, versions, swaps that fail."""
import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from wharf.operators.incremental import DuplicateKeyError, NullKeyError, stamp_and_merge, upsert
from wharf.plans import loads
from wharf.sources.catalog import CatalogTable, open_database

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def table(spark, tmp_dir):
    db = open_database(spark, f"t_{uuid.uuid4().hex[:10]}", tmp_dir)
    return lambda name="t", key="k", buckets=4: CatalogTable(spark, f"{db}.{name}", f"{tmp_dir}/{name}", key, buckets)


def keyed(spark, n, value=0, start=0):
    return spark.range(start, start + n).select(F.col("id").cast("string").alias("k"), F.lit(value).alias("v"))


def put(t, df, **options):
    return t.merge(df, lambda src, cur: upsert(cur, src, "k"), **options)


def rows(t):
    return sorted(map(tuple, t.read().collect()))


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture()
def no_broadcast(spark):
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)


def test_merge_writes_one_file_a_bucket_and_shuffles_the_batch_only(spark, table, no_broadcast):
    t = table(buckets=8)
    put(t, keyed(spark, 200))
    assert t.buckets == 8 and len(t.read().inputFiles()) == 8
    change = spark.createDataFrame([("7", 1), ("new", 2)], "k string, v int")
    plan = upsert(t.read(), t.keyed(change), "k")
    assert shuffles(plan) == 1
    put(t, change)
    got = dict(rows(t))
    assert len(got) == 201 and (got["7"], got["new"], got["8"]) == (1, 2, 0) and len(t.read().inputFiles()) == 8


def test_tables_of_one_bucketing_join_without_a_shuffle(spark, table, no_broadcast):
    a, b = table("a"), table("b")
    put(a, keyed(spark, 50))
    put(b, keyed(spark, 30).withColumnRenamed("v", "w"))
    joined = a.read().join(b.read(), "k", "left")
    assert shuffles(joined) == 0 and joined.count() == 50
    assert shuffles(a.read().groupBy("k").count()) == 0


def test_key_checks_leave_the_table_as_it_was(spark, table):
    t = table()
    for bad, error in (([("a", 1), ("a", 2)], DuplicateKeyError), ([("a", 1), (None, 2)], NullKeyError)):
        with pytest.raises(error):
            put(t, spark.createDataFrame(bad, "k string, v int"))
        assert not t.exists()
    put(t, spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))
    for bad, error in (([("c", 1), (None, 2)], NullKeyError), ([("a", 5), ("a", 6)], DuplicateKeyError)):
        with pytest.raises(error):
            put(t, spark.createDataFrame(bad, "k string, v int"))
        with pytest.raises(error):           # stamps filter null keys themselves; the check must come first
            t.merge(spark.createDataFrame([(k, v, v) for k, v in bad], "k string, v int, record_hash int"),
                    lambda src, cur: stamp_and_merge(src, None, "k", "2024-01-01 00:00:00"))
    assert rows(t) == [("a", 1), ("b", 2)]


def test_watermark_is_tracked_or_scanned(spark, table):
    ts = lambda d: dt.datetime(2024, 1, d, 5, 6, 7, 123000)
    stamped = lambda *r: spark.createDataFrame(list(r), "k string, stamp timestamp_ntz")
    t = table()
    assert t.watermark("stamp") is None
    put(t, stamped(("a", ts(1)), ("b", ts(3))), track_max="stamp")
    assert t.watermark("stamp") == ts(3) == t.read().agg(F.max("stamp")).first()[0]
    put(t, stamped(("c", ts(5))), track_max="stamp")
    assert t.watermark("stamp") == ts(5)
    u = table("u")
    put(u, stamped(("a", ts(4))))
    assert u.watermark("stamp") == ts(4)


def test_the_bucket_count_belongs_to_the_table(spark, table):
    put(table(buckets=4), keyed(spark, 100))
    grown = table(buckets=16)                      # what a larger source would ask for today
    put(grown, keyed(spark, 50, 1, 90))
    assert grown.buckets == 4 and len(grown.read().inputFiles()) == 4 and len(rows(grown)) == 140
    before = rows(grown)
    grown.rebucket(16)
    assert (grown.buckets, len(grown.read().inputFiles()), rows(grown)) == (16, 16, before)
    put(grown, keyed(spark, 1, 9))
    assert grown.buckets == 16 and dict(rows(grown))["0"] == 9


def test_a_new_table_is_dealt_out_once(spark, table, no_broadcast, monkeypatch):
    t, plans, stage = table(buckets=8), [], CatalogTable._stage
    monkeypatch.setattr(CatalogTable, "_stage", lambda self, df, n: plans.append(shuffles(df)) or stage(self, df, n))
    put(t, keyed(spark, 200))
    assert plans == [1] and t.buckets == 8 and len(t.read().inputFiles()) == 8 and len(rows(t)) == 200


def test_payment_buckets_grow_with_the_rows(spark, tmp_dir):
    """Well-compressed rows: a few MB of file, but too many rows for the sorts of one bucket's task."""
    for name, n in (("orders", 5 << 18), ("lineitem", 0)):
        spark.range(n).write.parquet(f"{tmp_dir}/{name}.parquet")
    assert {t.buckets for t in loads.payment_tables(spark, tmp_dir)} == {8}
    spark.range(17 << 18).write.mode("overwrite").parquet(f"{tmp_dir}/orders.parquet")
    assert {t.buckets for t in loads.payment_tables(spark, tmp_dir)} == {32}
    spark.range(40 << 18).coalesce(4).write.mode("overwrite").parquet(f"{tmp_dir}/lineitem.parquet")
    spark.range(9).write.mode("overwrite").parquet(f"{tmp_dir}/orders.parquet")
    assert {t.buckets for t in loads.payment_tables(spark, tmp_dir)} == {16}


def test_seeds_are_read_and_shuffled_in_as_many_tasks_as_buckets(spark, tmp_dir, monkeypatch):
    """Else a scan task of 6 GB holds millions of wide rows, as a shuffle to over 200 buckets keeps them in memory."""
    for name, sql in (
            ("orders", """SELECT id AS o_orderkey, id % 7 AS o_custkey, 'F' AS o_orderstatus, 1.5D * id AS o_totalprice,
                                 TIMESTAMP_NTZ '2024-01-05 00:00:00' AS o_orderdate, '2-HIGH' AS o_orderpriority
                          FROM range(3000)"""),
            ("lineitem", "SELECT id % 2000 AS l_orderkey, 'R' AS l_returnflag FROM range(5000)"),
            ("customer", "SELECT id AS c_custkey, 0 AS c_nationkey FROM range(7)"),
            ("nation", "SELECT 0 AS n_nationkey, 'PERU' AS n_name")):
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    orders, lineitem = (f"{tmp_dir}/{n}.parquet" for n in ("orders", "lineitem"))
    cost, names = "spark.sql.files.openCostInBytes", ("spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum",
                                                      "spark.sql.adaptive.coalescePartitions.minPartitionNum")
    usual, before, seen, stage = spark.conf.get(cost), [spark.conf.get(k, None) for k in names], [], CatalogTable._stage

    def count(self, df, buckets):
        seen.extend([spark.read.parquet(p).rdd.getNumPartitions() for p in (orders, lineitem)])
        seen.append(spark.range(9).repartition(F.col("id"))._jdf.queryExecution().sparkPlan().outputPartitioning()
                    .numPartitions())
        return stage(self, df, buckets)
    monkeypatch.setattr(CatalogTable, "_stage", count)
    spark.conf.set(cost, "1")                    # splits of a small file
    try:
        acc_t, cb_t, _ = loads.payment_tables(spark, tmp_dir, buckets=32)
        acc, cb = loads.stage_seeds(spark, tmp_dir, acc_t, cb_t, loads.STAGE_TS1, *map(spark.read.parquet, (orders, lineitem)))
        twice = spark.read.parquet(orders).union(spark.read.parquet(orders))
        with pytest.raises(DuplicateKeyError):
            loads.stage_seeds(spark, tmp_dir, acc_t, cb_t, loads.STAGE_TS2, twice, spark.read.parquet(lineitem))
    finally:
        spark.conf.set(cost, usual)
    assert len(seen) == 9 and min(seen) >= 32 and (acc.count(), cb.count()) == (3000, 2000)
    assert [spark.conf.get(k, None) for k in names] == before


def test_replace_reads_what_it_replaces_and_keeps_one_version(spark, table, tmp_dir):
    t = table(key=None)
    t.replace(spark.range(5).toDF("x"))
    old = t.read()
    t.replace(t.read().withColumn("x", F.col("x") * 10))
    assert rows(t) == [(i * 10,) for i in range(5)] and sorted(map(tuple, old.collect())) == [(i,) for i in range(5)]
    t.replace(t.read().withColumn("y", F.lit("new column")))
    assert t.read().columns == ["x", "y"] and t.read().count() == 5
    t.replace(t.read().limit(0))
    assert rows(t) == [] and len([d for d in os.listdir(f"{tmp_dir}/t") if d.startswith("v-")]) == 2
    t.drop()
    assert not t.exists() and not os.path.exists(f"{tmp_dir}/t")


def test_failure_before_the_swap(spark, table, tmp_dir):
    t = table()
    put(t, keyed(spark, 20))
    before, files = rows(t), t.read().inputFiles()
    with pytest.raises(Exception, match="broken"):
        t.merge(keyed(spark, 5, 1), lambda src, cur: upsert(cur, src, "k").withColumn(
            "v", F.when(F.col("k") == "19", F.raise_error(F.lit("broken")).cast("int")).otherwise(F.col("v"))))
    assert rows(t) == before and t.read().inputFiles() == files
    assert len([d for d in os.listdir(f"{tmp_dir}/t") if d.startswith("v-")]) == 1       # what was staged is gone
    put(t, keyed(spark, 5, 1))
    assert len(rows(t)) == 20 and sum(v for _, v in rows(t)) == 5


@pytest.mark.parametrize("layout", [False, True])
def test_failure_during_the_swap(spark, table, monkeypatch, layout):
    """The job ends before the swap's command (same layout), or between its two renames (another layout)."""
    t = table()
    put(t, keyed(spark, 20))
    before, run = rows(t), spark.sql

    class Stopped(Exception):
        pass

    class Failing:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            if "SET LOCATION" in text or text.endswith(f"__next RENAME TO {t.name}"):
                raise Stopped
            return run(text)

    monkeypatch.setattr(t, "spark", Failing())
    with pytest.raises(Stopped):
        t.replace(keyed(spark, 3, 7), buckets=8 if layout else None)
    again = table()                                # the next job opens the table
    assert rows(again) == before and again.buckets == 4
    put(again, keyed(spark, 1, 5))
    assert dict(rows(again))["0"] == 5 and len(rows(again)) == 20


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_nothing_is_shuffled_between_staging_and_fact(spark, no_broadcast):
    tables = loads.payment_tables(spark, SF)
    acc, cb, fact = loads.run_payment_model(spark, SF, tables=tables)
    changes = loads.pay.fact_changes(acc, cb, "2024-01-03 06:00:00", fact, mark=dt.datetime(2024, 1, 1), backfill_days=3)
    merged = loads.pay.merge_fact(changes, fact)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_full_refresh_that_fails_keeps_the_fact(spark, monkeypatch):
    tables = loads.payment_tables(spark, SF)
    _, _, fact = loads.run_payment_model(spark, SF, tables=tables)
    before = sorted(r["transaction_id"] for r in fact.collect())
    _, (_, o2, li2) = loads.order_snapshots(spark, SF)
    build = loads.pay.build_fact
    monkeypatch.setattr(loads.pay, "build_fact", lambda *a: build(*a).withColumn(
        "amount", F.raise_error(F.lit("broken")).cast("double")))
    with pytest.raises(Exception, match="broken"):
        loads.rebuild_payments(spark, SF, tables, loads.STAGE_TS3, o2, li2)
    assert sorted(r["transaction_id"] for r in tables[2].read().collect()) == before
    monkeypatch.undo()
    loads.rebuild_payments(spark, SF, tables, loads.STAGE_TS3, o2, li2)
    ids = sorted(r["transaction_id"] for r in tables[2].read().collect())
    assert ids == sorted(str(r["o_orderkey"]) for r in o2.collect()) and len(ids) < len(before)
