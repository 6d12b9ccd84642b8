"""Registered document queries and the pipeline on the smallest tables."""
import os
import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from scripts.check_oracle import compare, oracle_connection
from tests.llm.test_dedup import plain_near
from tests.llm.test_mixing_sharding import filled
from tests.llm.test_text_operators import plain_marks
from wharf.llm import mixing, quality, queries
from wharf.session import work_dir

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    sql = queries.oracle_sql().get(name)
    status, detail = compare(spark, oracle_connection(SF), SF, name, queries.queries()[name], sql)
    assert status == ("OK" if sql else "NO-ORACLE"), detail


def test_native_queries_run_no_python(spark):
    for name in ("op1_tool_calls", "op3_mixing", "op4_sharding", "op6_line_dedup"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan), name


def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}

    def stage(n, df):
        out = corpus_pipeline.STAGES[n][1](spark, df, SF)
        assert n == 4 or out.columns == columns
        return out

    scored = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    now = stage(0, docs)
    want = {r["doc_id"] for r in scored if r["predicted"] == 1}
    assert sorted(r["doc_id"] for r in now.select("doc_id").collect()) == sorted(want)
    kept = {i: kept[i] for i in want}
    now = stage(1, now)
    kept = {i: kept[i] for i, _, root in plain_near(list(kept.items())) if i == root}
    assert {r["doc_id"]: r["text"] for r in now.collect()} == kept
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    now = stage(2, now)
    hit = {i for i, _, n, _ in plain_marks(list(kept.items()), bench) if n}
    kept = {i: t for i, t in kept.items() if i not in hit}
    assert {r["doc_id"]: r["text"] for r in now.collect()} == kept and hit
    mixed = stage(3, now)
    times = Counter(r["doc_id"] for r in mixed.collect())
    size = {i: len(t.split()) for i, t in kept.items()}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    taken = Counter()
    for i, n in times.items():
        assert n <= 2
        taken[source[i]] += n * size[i]
    for s, t in filled(total, mixing.WEIGHTS).items():
        assert abs(taken[s] - t) <= max(n for i, n in size.items() if source[i] == s) / 2
    out = stage(4, mixed).collect()
    assert Counter(r["doc_id"] for r in out) == times
    for n in range(queries.SHARDS):
        own = sorted(r["slot"] for r in out if r["shard"] == n)
        assert own == list(range(len(own)))
    whole = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in whole) == times


def test_pipeline_with_nulls_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "a b c", None, "s", 5), (0, "", "en", None, 0),
                                 (0, "", "en", None, 0)], docs.schema)
    now = docs.union(odd).union(odd.limit(0))
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, SF)
    assert now.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_pipeline_decides_on_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def stage(n, rows):
        df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema)
        return Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.STAGES[n][1](spark, df, SF).collect())

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scored = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    good = [(r["doc_id"], texts[r["doc_id"]]) for r in scored if r["predicted"] == 1]
    bad = [(r["doc_id"], texts[r["doc_id"]]) for r in scored if r["predicted"] == 0]
    other = next(r["doc_id"] for r in scored if r["predicted"] == 1 and r["held_out"])   # its rows teach nothing
    rows = good + bad + [(None, t) for _, t in good + bad] + [(other, bad[0][1])]
    assert bad and stage(0, rows) == Counter(good + [(None, t) for _, t in good])

    t, u = "p q r s t u", "k l m n o"
    rows = [(4, t), (4, t), (None, t), (9, t), (None, u), (None, u), (None, u), (None, None), (None, None), (3, ""), (3, "")]
    assert stage(1, rows) == Counter([(4, t), (None, u), (None, None), (None, None), (3, ""), (3, "")])

    leaked = spark.read.parquet(f"{SF}/benchmark.parquet").head()["text"]
    rows = [(None, leaked), (7, leaked), (7, "own words"), (None, "own words"), (8, None), (8, None)]
    assert stage(2, rows) == Counter([(7, "own words"), (None, "own words"), (8, None), (8, None)])


def test_sharding_query_reads_its_shard_files(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op4_sharding(spark, SF)
    files = out.inputFiles()
    assert files and all("/shards-" in f and "/shard=" in f for f in files)
    texts = spark.read.parquet(files[0].split("/shard=")[0])
    assert {r["doc_id"]: r["text"] or "" for r in texts.collect()} == docs
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in out.collect()} == {
        i: (len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in docs.items()}


def test_mixing_query_sorts_texts(spark):
    plan = queries.op3_mixing(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    sort = next(n for n, line in enumerate(plan.split("\n")) if "Sort [first_position" in line)
    assert "AS text#" in plan.split("\n")[sort + 1]


def test_pipeline_keeps_columns_with_operators_names(spark):
    clash = ["shard", "slot", "size", "position", "positions", "items", "n_words", "n_hit", "contaminated", "taken", "target",
             "law", "row", "_row", "_c1", "Predicted", "kept"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = docs.select("*", *[(docs.doc_id * 100 + i).alias(c) for i, c in enumerate(clash)])
    now = wide
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, SF)
        assert now.columns == wide.columns + ["shard_", "slot_"] * (n == 4)
    path = f"{work_dir(spark, 'clash')}/out"
    now.write.parquet(path)
    rows = spark.read.parquet(path).collect()
    assert rows and all(r[c] == r["doc_id"] * 100 + i for r in rows for i, c in enumerate(clash))
    for n in {r["shard_"] for r in rows}:
        own = sorted(r["slot_"] for r in rows if r["shard_"] == n)
        assert own == list(range(len(own)))
