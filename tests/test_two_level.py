"""Compaction of hot keys by date ranges, mergeable sketches, landed documents, records over several lines."""
import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wharf.operators import aggregates as agg
from wharf.operators import windows as win
from wharf.plans import ingest
from wharf.sources import documents as docs
from wharf.sources import events as ev

SCHEMA = "k string, since date, a string, b int"


def plain_compact(rows):
    out = []
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for k, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or dt.date.min, r[2] is not None, r[2] or "", r[3] is not None, r[3] or 0))
        kept, last = [], None
        for r in own:
            now = (r[2] or "", "" if r[3] is None else str(r[3]))
            if last is None or now != last:
                kept.append(r)
            last = now
        for i, r in enumerate(kept):
            after = kept[i + 1][1] if i + 1 < len(kept) else None
            out.append((k, r[1], after - dt.timedelta(1) if after else dt.date(9999, 12, 31), r[2], r[3]))
    return Counter(out)


@pytest.mark.parametrize("span", ["month", "year", "week"])
def test_compaction_over_range_edges(spark, span):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "x", "y", None]), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(900)),
             rng.choice(["p", "", None, "q"]), rng.choice([1, None])) for _ in range(1500)]
    rows += [("runs", dt.date(2020, 1, 1) + dt.timedelta(i), "same", 1) for i in range(800)]      # one run over many ranges
    df = spark.createDataFrame(rows, SCHEMA)
    got = win.compact_dim(df, "k", ["a", "b"], "since", span=span)
    assert Counter(map(tuple, got.collect())) == plain_compact(rows)


def test_hot_key_is_spread_over_ranges(spark):
    hot = spark.range(36_500).select(F.lit("hot").alias("k"), F.date_add(F.lit(dt.date(1950, 1, 1)), F.col("id").cast("int")).alias("since"),
                                     (F.col("id") % 500).cast("string").alias("a"), F.lit(1).alias("b"))
    out = win.compact_dim(hot, "k", ["a", "b"], "since")
    assert out.count() == 36_500
    plan = out._jdf.queryExecution().analyzed().toString()
    assert plan.count("windowspecdefinition") >= 5 and "hashpartitioning" not in plan
    most = hot.groupBy("k", F.trunc("since", "month")).count().agg(F.max("count")).first()[0]
    over_edges = hot.select(F.trunc("since", "month")).distinct().count()
    assert most <= 31 and over_edges == 1200                 # rows that one window holds, within and over ranges


def test_compaction_of_nothing_and_of_unknown_dates(spark):
    assert win.compact_dim(spark.createDataFrame([], SCHEMA), "k", ["a", "b"], "since").count() == 0
    rows = [("x", None, "a", 1), ("x", dt.date(2020, 5, 1), "a", 1), ("x", dt.date(2020, 6, 1), "b", 1)]
    got = win.compact_dim(spark.createDataFrame(rows, SCHEMA), "k", ["a", "b"], "since")
    assert Counter(map(tuple, got.collect())) == plain_compact(rows)


def test_sketches_of_days_merge_within_the_bound(spark):
    df = spark.range(60_000).select(F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("d"),
                                    (F.col("id") % 20_011).alias("many"), F.when(F.col("id") % 3 > 0, "v").alias("few"))
    got = agg.profile_of_sketches(agg.daily_sketches(df, F.col("d"), ["many", "few"]), ["many", "few"]).first()
    assert (got["rows_count"], got["days"], got["few_distinct_count"]) == (60_000, 40, 2)
    assert abs(got["many_distinct_count"] - 20_011) <= 3 * agg.SKETCH_ERROR * 20_011
    part = agg.daily_sketches(df.where("id % 2 = 0"), F.col("d"), ["many"]).unionByName(
        agg.daily_sketches(df.where("id % 2 = 1"), F.col("d"), ["many"]))          # loaded in two halves
    halves = agg.profile_of_sketches(part, ["many"]).first()["many_distinct_count"]
    assert abs(halves - 20_011) <= 3 * agg.SKETCH_ERROR * 20_011


def test_landed_documents_are_read_by_day(spark, tmp_dir):
    hour = lambda d, h: int(dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc).timestamp())
    doc = lambda *times: '{"hourly": {"data": [' + ", ".join(f'{{"time": {t}, "temperature": 1}}' for t in times) + "]}}"
    raw = spark.createDataFrame([(1, doc(hour(1, 5), hour(1, 6))), (2, doc(hour(1, 23), hour(2, 0))), (3, doc()), (4, "broken")],
                                "doc_no long, value string")
    docs.land_by_day(raw, f"{tmp_dir}/landed")
    second = docs.read_day(spark, f"{tmp_dir}/landed", "2024-01-03 03:00:00", ingest.DOC_SCHEMA)
    assert [r["doc_no"] for r in second.collect()] == [2]
    assert sorted(r["doc_no"] for r in docs.read_day(spark, f"{tmp_dir}/landed", "2024-01-02 03:00:00", ingest.DOC_SCHEMA).collect()) == [1, 2]
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2024-01-02" in plan
    assert spark.read.parquet(f"{tmp_dir}/landed").where("day IS NULL").count() == 2       # nothing is lost on the way


def test_records_over_several_lines(spark, tmp_dir):
    text = "[{'id': 1,\n 'name': 'a\n b'},\n{'id': 2, 'name':\r\n 'c'},\n{'id': 3, 'name': 'd'}]\n"
    with open(f"{tmp_dir}/events.txt", "w", newline="") as f:
        f.write(text)
    got = ev.read_events(spark, f"{tmp_dir}/events.txt", ["id", "name"], {"id": "bigint"}, {}, record_sep="},\n")
    assert sorted((r["id"], r["name"]) for r in got.collect()) == [(1, "a  b"), (2, "c"), (3, "d")]
