import os
import uuid

import pytest
from pyspark.sql import functions as F

from wharf.plans import ingest
from wharf.sources.catalog import CatalogTable, open_database
from wharf.streaming.ingest import ingest_event_files, merge_event_files, read_ingested, reconcile_loads


def test_streaming_ingest_reads_each_file_once(spark, tmp_dir):
    src, tgt, bad, ckpt = (f"{tmp_dir}/{n}" for n in ("in", "out", "bad", "ckpt"))
    fields, types = ["id", "name"], {"id": "bigint"}
    spark.createDataFrame([("{'id': 1, 'name': 'a'},",), ("{'id': 2, 'name': 'b'},",)], "value string") \
        .write.text(src)
    ingest_event_files(spark, src, tgt, bad, ckpt, fields, types, {}, "id")
    assert sorted(r["id"] for r in read_ingested(spark, tgt).collect()) == [1, 2]
    ingest_event_files(spark, src, tgt, bad, ckpt, fields, types, {}, "id")   # nothing new
    assert read_ingested(spark, tgt).count() == 2
    spark.createDataFrame([("{'id': 3, 'name': 'c'},",), ("{'id': 'x', 'name': 'd}",)], "value string") \
        .write.mode("append").text(src)
    ingest_event_files(spark, src, tgt, bad, ckpt, fields, types, {}, "id")
    assert sorted(r["id"] for r in read_ingested(spark, tgt).collect()) == [1, 2, 3]
    probs = [(r["id"], r["problem"]) for r in spark.read.parquet(bad).collect()]
    assert probs == [("x", "unparseable record")]


FIELDS, TYPES = ["id", "name"], {"id": "bigint"}


def deliver(spark, folder, night, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{folder}/night={night}")


class Merged:
    """A merged event table with its stream's folders."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        db = open_database(spark, f"m_{uuid.uuid4().hex[:10]}", f"{root}/db")
        self.table = CatalogTable(spark, f"{db}.events", f"{root}/db/events", "id", 4)

    def run(self):
        merge_event_files(self.spark, f"{self.root}/in", self.table, f"{self.root}/landing", f"{self.root}/ckpt",
                          FIELDS, TYPES, {}, F.regexp_extract("_metadata.file_path", "/night=([^/]+)/", 1))

    def rows(self):
        return sorted((r["id"], r["name"], r["version"]) for r in self.table.read().collect())

    def loads(self):
        return [tuple(r) for r in reconcile_loads(self.spark, f"{self.root}/landing").orderBy("batch_id").collect()]


def test_merge_of_repeated_and_corrected_deliveries(spark, tmp_dir):
    m = Merged(spark, tmp_dir)
    first = ["{'id': 1, 'name': 'a'},", "{'id': 2, 'name': 'b'},", "{'id': 2, 'name': 'B'},", "[", ""]
    deliver(spark, f"{tmp_dir}/in/one", "1", *first)
    m.run()
    assert m.rows() == [(1, "a", "1"), (2, "b", "1")]                   # twice in a file: the greater row
    deliver(spark, f"{tmp_dir}/in/two", "2", "{'id': 1, 'name': 'corrected'},", "{'id': 3, 'name': 'c'}", "no record",
            "{'id': 'x', 'name': 'd'}", "{'id': , 'name': 'e'}")
    deliver(spark, f"{tmp_dir}/in/two", "1", *first)
    m.run()
    want = [(1, "corrected", "2"), (2, "b", "1"), (3, "c", "2")]
    assert m.rows() == want
    deliver(spark, f"{tmp_dir}/in/three", "1", *first)                   # late: does not undo the correction
    m.run()
    m.run()                                                              # nothing new: no batch
    assert m.rows() == want
    assert m.loads() == [(0, 3, 3, 0, True), (1, 8, 5, 3, True), (2, 3, 3, 0, True)]
    bad = {(r["problem"], r["value"], r["version"]) for r in spark.read.parquet(f"{tmp_dir}/landing/quarantine").collect()}
    assert bad == {("no id", None, "2"), ("no id", "x", "2"), ("unparseable record", "no record", "2")}


def test_replayed_batch_is_not_merged_twice(spark, tmp_dir):
    m = Merged(spark, tmp_dir)
    deliver(spark, f"{tmp_dir}/in/one", "1", "{'id': 1, 'name': 'a'}")
    m.run()
    files = m.table.read().inputFiles()
    for name in ("0", ".0.crc"):                                        # the job ended before the batch was committed
        os.remove(f"{tmp_dir}/ckpt/commits/{name}")
    m.run()
    assert m.table.read().inputFiles() == files and m.rows() == [(1, "a", "1")] and m.loads() == [(0, 1, 1, 0, True)]


def test_batch_that_fails_is_merged_by_the_next_run(spark, tmp_dir, monkeypatch):
    m = Merged(spark, tmp_dir)
    deliver(spark, f"{tmp_dir}/in/one", "1", "{'id': 1, 'name': 'a'}", "bad")
    merge = m.table.merge
    monkeypatch.setattr(m.table, "merge", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        m.run()
    assert not m.table.exists()
    monkeypatch.setattr(m.table, "merge", merge)
    monkeypatch.setattr(m.table, "set_property", lambda *a: (_ for _ in ()).throw(RuntimeError("late")))
    with pytest.raises(Exception, match="late"):                         # after the merge, before it is noted
        m.run()
    monkeypatch.undo()
    m.run()
    assert m.rows() == [(1, "a", "1")] and m.loads() == [(0, 2, 1, 1, True)]


def some_events(spark, path):
    """Events of both nights, and such whose raw line has no readable time."""
    spark.sql("""SELECT id AS event_id, ts, id % 12 AS user_id, 'view' AS event_type, 1.5D * id AS value,
                        concat('{"k": ', k, '}') AS props
                 FROM range(40) LATERAL VIEW explode(array('1', '0', '98', '99', 'null')) AS k LATERAL VIEW explode(array(
                   TIMESTAMP_NTZ '2024-01-15 23:59:59.9', TIMESTAMP_NTZ '2024-01-16 00:00:00', NULL)) AS ts
              """).write.parquet(f"{path}/events.parquet")


def test_raw_lines_are_made_of_one_night_and_read_k_once(spark, tmp_dir, monkeypatch):
    some_events(spark, tmp_dir)
    make, given = ingest.raw_event_lines, []
    monkeypatch.setattr(ingest, "raw_event_lines",
                        lambda s, d, events=None: given.append(events) or make(s, d, events))
    written = F.regexp_extract("value", r"'event_timestamp': '(\d{4}-\d{2}-\d{2})", 1)
    rows = ingest.q_nightly_event_ingest(spark, tmp_dir).count()
    nights = [make(spark, tmp_dir, e).select((written < "2024-01-16").alias("first")) for e in given]
    assert [[r["first"] for r in n.distinct().collect()] for n in nights] == [[True], [False]]
    assert sum(n.count() for n in nights) == 600 and rows == 360
    plan = make(spark, tmp_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 1


def test_a_night_delivered_again_is_a_copy_of_its_file(spark, tmp_dir, monkeypatch):
    some_events(spark, tmp_dir)
    one = spark.range(3).select(F.concat(F.lit("{'event_id': "), "id", F.lit(", 'note': '"), F.uuid(), F.lit("'},"))
                                .alias("value"))                                        # made anew, it would be another
    monkeypatch.setattr(ingest, "event_deliveries", lambda *a: [{"a": one}, {"a": one}])
    monkeypatch.setattr(ingest, "work_dir", lambda *a: f"{tmp_dir}/merge-{uuid.uuid4().hex[:12]}")
    _, landing = ingest.merged_events(spark, tmp_dir)
    first, again = ([r["value"] for r in spark.read.text(f"{landing}/../incoming/delivery-{n}/night=a").orderBy("value").collect()]
                    for n in (0, 1))
    assert first == again and len(first) == 3
    assert [tuple(r)[1:] for r in reconcile_loads(spark, landing).collect()] == [(3, 3, 0, True)] * 2


def test_event_buckets_grow_with_the_rows(spark, tmp_dir, monkeypatch):
    some_events(spark, tmp_dir)
    monkeypatch.setattr(ingest, "event_deliveries", lambda *a: [])
    assert ingest.merged_events(spark, tmp_dir)[0].buckets == 8
    spark.range(9 << 18).write.mode("overwrite").parquet(f"{tmp_dir}/events.parquet")
    assert ingest.merged_events(spark, tmp_dir)[0].buckets == 16
