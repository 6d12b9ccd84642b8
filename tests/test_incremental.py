import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators import incremental as inc
from wharf.plans import payments as pay
from wharf.sources import tables as tb

D = dt.date
ADDR = "id int, company_id string, city string, created_at date"


def test_insert_new_rules(spark):
    target = spark.createDataFrame([(1, "c1", "", D(2019, 6, 1), D(2019, 6, 2))],
                                   ADDR + ", import_date date")
    batch = spark.createDataFrame([
        (1, "c1", "x", D(2019, 6, 2)),                   # key already in target → skipped
        (2, "c2", "b", D(2019, 6, 2)), (2, "c2", "a", D(2019, 6, 2)),   # twice in batch → one kept
        (None, "c9", "z", D(2019, 6, 2)),                # NULL key → rejected
        (3, "c3", "", D(2019, 8, 9))], ADDR)
    fresh, rejected = inc.insert_new(target, batch, "id", D(2019, 8, 10), order_cols=["created_at"])
    got = sorted((r["id"], r["city"], r["import_date"]) for r in fresh.collect())
    assert got == [(2, "a", D(2019, 8, 10)), (3, "", D(2019, 8, 10))]
    assert [r["company_id"] for r in rejected.collect()] == ["c9"]


def test_last_import_and_extract(spark):
    empty = spark.createDataFrame([], "import_date date")
    assert inc.last_import([empty, empty]) == D(2010, 1, 1)
    t1 = spark.createDataFrame([(D(2019, 6, 1),)], "import_date date")
    t2 = spark.createDataFrame([(D(2019, 8, 9),)], "import_date date")
    mark = inc.last_import([t1, t2])
    assert mark == D(2019, 8, 9)
    src = spark.createDataFrame([(1, D(2019, 8, 9)), (2, D(2019, 8, 8)), (3, D(2019, 9, 1))], "id int, created_at date")
    assert sorted(r[0] for r in inc.extract_since(src, "created_at", mark).collect()) == [1, 3]   # >= keeps equal


def seed(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pay.ACCEPTANCE_SEED_COLS))


def acc_row(ref, state="ACCEPTED", status="TRUE", amount="10.0", cur="USD", date="2019-01-01 10:00:00"):
    return (ref, status, "GP", "evt" + ref, date, state, "yes", amount, "US", cur, '{"USD": 1}')


def test_staging_two_runs(spark):
    ts1, ts2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    run1 = pay.stage(pay.clean_acceptance(seed(spark, [acc_row("a"), acc_row("b"), acc_row("c"), acc_row("d")])), ts1)
    run2_src = seed(spark, [acc_row("a"),                         # same hash
                            acc_row("b", state=" declined "),     # hash changes
                            acc_row("c", amount="99.0"),          # amount only: outside the hash
                            acc_row("e")])                        # new id; 'd' vanished
    run2 = pay.stage(pay.clean_acceptance(run2_src), ts2, run1)
    got = {r["transaction_id"]: r for r in run2.collect()}
    T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert (got["a"]["dw_created_at"], got["a"]["dw_modified_at"]) == (T1, T1)
    assert (got["b"]["dw_created_at"], got["b"]["dw_modified_at"], got["b"]["transaction_state"]) == (T1, T2, "DECLINED")
    assert (got["c"]["dw_modified_at"], got["c"]["amount"]) == (T1, 99.0)
    assert (got["d"]["dw_created_at"], got["d"]["dw_modified_at"]) == (T1, T1)   # vanished id stays
    assert (got["e"]["dw_created_at"], got["e"]["dw_modified_at"]) == (T2, T2)


def test_staging_rejects_duplicate_ids(spark):
    with pytest.raises(inc.DuplicateKeyError):
        pay.stage(pay.clean_acceptance(seed(spark, [acc_row("a"), acc_row("a", amount="2")])), "2024-01-01 00:00:00")


def cb(spark, rows, ts, target=None):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pay.CHARGEBACK_SEED_COLS))
    return pay.stage(pay.clean_chargeback(df), ts, target)


def test_fact_full_and_incremental(spark):
    ts1, ts2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    acc1 = pay.stage(pay.clean_acceptance(seed(spark, [acc_row("a"), acc_row("b"), acc_row("c", state="DECLINED")])), ts1)
    cb1 = cb(spark, [("a", "TRUE", "GP", "FALSE"), ("b", "TRUE", "GP", "n/a"), ("z", "TRUE", "GP", "TRUE")], ts1)
    fact1 = pay.build_fact(acc1, cb1, ts1)
    f1 = {r["transaction_id"]: r for r in fact1.collect()}
    assert sorted(f1) == ["a", "b", "c"]                         # chargeback without acceptance dropped
    assert f1["a"]["is_missing_chargeback"] is False
    assert f1["b"]["is_missing_chargeback"] is True              # NULL flag
    assert f1["c"]["is_missing_chargeback"] is True and f1["c"]["is_declined"] is True
    # run 2: chargeback for c arrives; a changes amount only (not seen); new id d dated on the run date
    acc2 = pay.stage(pay.clean_acceptance(seed(spark, [
        acc_row("a", amount="55"), acc_row("b"), acc_row("c", state="DECLINED"),
        acc_row("d", date="2024-01-02 01:00:00")])), ts2, acc1)
    cb2 = cb(spark, [("a", "TRUE", "GP", "FALSE"), ("b", "TRUE", "GP", "n/a"), ("c", "TRUE", "GP", "yes")], ts2, cb1)
    fact2 = pay.build_fact(acc2, cb2, ts2, fact1, backfill_days=0)
    f2 = {r["transaction_id"]: r for r in fact2.collect()}
    T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert f2["a"]["amount"] == 10.0 and f2["a"]["dw_modified_at"] == T1     # amount outside the hash
    assert f2["c"]["has_chargeback"] is True and f2["c"]["is_missing_chargeback"] is False
    assert (f2["c"]["dw_created_at"], f2["c"]["dw_modified_at"]) == (T1, T2)
    assert f2["c"]["source_dw_modified_at"] == T2
    assert f2["d"]["dw_created_at"] == T2


def test_backfill_replays_recent_days(spark):
    ts1, ts2 = "2024-01-01 00:00:00", "2024-01-05 00:00:00"
    rows = [acc_row("a", date="2024-01-04 10:00:00"), acc_row("b", date="2023-06-01 10:00:00")]
    acc = pay.stage(pay.clean_acceptance(seed(spark, rows)), ts1)
    cbs = cb(spark, [("a", "TRUE", "GP", "FALSE")], ts1)
    fact1 = pay.build_fact(acc, cbs, ts1)
    ids0 = inc.changed_ids(acc, cbs, pay.fact_mark(fact1), run_date=D(2024, 1, 5), backfill_days=0)
    assert ids0.count() == 0
    ids3 = inc.changed_ids(acc, cbs, pay.fact_mark(fact1), run_date=D(2024, 1, 5), backfill_days=3)
    assert [r[0] for r in ids3.collect()] == ["a"]
    same_day = pay.stage(pay.clean_acceptance(seed(spark, [acc_row("c", date="2024-01-05 01:00:00")])), ts1)
    ids_today = inc.changed_ids(same_day, cbs, dt.datetime(2024, 1, 2), run_date=D(2024, 1, 5), backfill_days=0)
    assert [r[0] for r in ids_today.collect()] == ["c"]       # 0 still replays rows dated on the run date


def test_replace_window_partitions(spark, tmp_dir):
    root = f"{tmp_dir}/events"
    days = [D(2024, 1, d) for d in range(1, 11)]
    old = spark.createDataFrame([(i, d, "old") for i, d in enumerate(days)], "id int, day date, v string")
    old.write.partitionBy("day").parquet(root)
    new = spark.createDataFrame([(100, D(2024, 1, 8), "new"), (101, D(2024, 1, 9), "new"),
                                 (102, D(2024, 1, 1), "outside")], "id int, day date, v string")
    tb.replace_window_partitions(spark, root, new, "day", D(2024, 1, 10), 3)    # window 7, 8, 9
    got = sorted((r["day"], r["v"]) for r in spark.read.parquet(root).collect())
    assert (D(2024, 1, 7), "old") not in got            # emptied day removed
    assert (D(2024, 1, 8), "new") in got and (D(2024, 1, 8), "old") not in got
    assert (D(2024, 1, 1), "old") in got and (D(2024, 1, 10), "old") in got
    assert len(got) == 9
    logical = inc.restated(old, new, "day", D(2024, 1, 10), 3)
    assert sorted((r["day"], r["v"]) for r in logical.collect()) == got


def test_ensure_and_append_by_name(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    p = f"{tmp_dir}/t"
    assert tb.ensure_table(spark, p, schema).count() == 0
    tb.append(spark.createDataFrame([("x", 1)], "b string, a int"), p, columns=schema.fieldNames())
    r = spark.read.parquet(p).first()
    assert (r["a"], r["b"]) == (1, "x")


def test_sync_tables_first_run_into_empty_target(spark, tmp_dir):
    from wharf.plans.loads import sync_tables
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("created_at", T.DateType()),
                           T.StructField("import_date", T.DateType())])
    targets = {"t": (f"{tmp_dir}/t", schema)}
    src = spark.createDataFrame([(1, D(2009, 12, 31)), (2, D(2010, 1, 1)), (3, D(2019, 6, 1))],
                                "id int, created_at date")
    sync_tables(spark, targets, {"t": src}, {"t": "id"}, D(2019, 8, 10), default_mark=D(2010, 1, 1))
    got = sorted((r["id"], r["import_date"]) for r in spark.read.parquet(f"{tmp_dir}/t").collect())
    assert got == [(2, D(2019, 8, 10)), (3, D(2019, 8, 10))]       # older than the default mark: not copied
    src2 = src.unionByName(spark.createDataFrame([(4, D(2019, 8, 10)), (5, D(2019, 8, 9))], "id int, created_at date"))
    sync_tables(spark, targets, {"t": src2}, {"t": "id"}, D(2019, 8, 11))
    got = sorted(r["id"] for r in spark.read.parquet(f"{tmp_dir}/t").collect())
    assert got == [2, 3, 4]                                        # equal to the mark kept; older late row missed


def test_sync_tables_rerun_after_partial_failure(spark, tmp_dir):
    from wharf.plans.loads import sync_tables
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("created_at", T.DateType()),
                           T.StructField("import_date", T.DateType())])
    targets = {"a": (f"{tmp_dir}/a", schema), "b": (f"{tmp_dir}/b", schema)}
    run1 = spark.createDataFrame([(1, D(2019, 1, 5))], "id int, created_at date")
    sync_tables(spark, targets, {"a": run1, "b": run1}, {"a": "id", "b": "id"}, D(2019, 1, 10))
    src = spark.createDataFrame([(1, D(2019, 1, 5)), (2, D(2019, 1, 12))], "id int, created_at date")
    # run 2 loads table a, then "fails" before table b
    sync_tables(spark, {"a": targets["a"]}, {"a": src}, {"a": "id"}, D(2019, 1, 20))
    # rerun of run 2 over both tables: same mark as the first attempt, nothing doubled, nothing missed
    sync_tables(spark, targets, {"a": src, "b": src}, {"a": "id", "b": "id"}, D(2019, 1, 20))
    for name in ("a", "b"):
        got = sorted((r["id"], r["import_date"]) for r in spark.read.parquet(f"{tmp_dir}/{name}").collect())
        assert got == [(1, D(2019, 1, 10)), (2, D(2019, 1, 20))], name


def test_replace_and_drop_table(spark, tmp_dir):
    p = f"{tmp_dir}/rt"
    tb.replace_table(spark, spark.createDataFrame([(1,)], "x int"), p)
    cur = spark.read.parquet(p)
    out = tb.replace_table(spark, cur.withColumn("x", F.col("x") * 10), p)   # reads the table it replaces
    assert [r["x"] for r in out.collect()] == [10]
    empty = tb.replace_table(spark, spark.read.parquet(p).limit(0), p)                         # empty the table
    assert empty.count() == 0
    tb.drop_table(spark, p)
    assert not tb.path_exists(spark, p)


def test_unreachable_store_is_an_error_not_an_absent_table(spark):
    with pytest.raises(Exception, match="nosuchfs"):
        tb.path_exists(spark, "nosuchfs://bucket/table")


def test_ensure_table_never_writes_to_an_existing_one(spark, tmp_dir):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    spark.createDataFrame([(1,)], schema).write.parquet(f"{tmp_dir}/kept")
    assert tb.ensure_table(spark, f"{tmp_dir}/kept", schema).count() == 1


def test_replace_table_that_fails_leaves_the_old_one(spark, tmp_dir, monkeypatch):
    p = f"{tmp_dir}/kept"
    tb.replace_table(spark, spark.createDataFrame([(1,)], "x int"), p)
    bad = spark.read.parquet(p).withColumn("x", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tb.replace_table(spark, bad, p)
    monkeypatch.setattr(tb, "_put_in_place", lambda *a: (_ for _ in ()).throw(OSError("no swap")))
    with pytest.raises(OSError):
        tb.replace_table(spark, spark.createDataFrame([(2,)], "x int"), p)
    assert [r["x"] for r in spark.read.parquet(p).collect()] == [1]
    assert os.listdir(tmp_dir) == ["kept"]
