"""A corpus pipeline of five stages over ``documents``.

Quality classifier, near-dedup, benchmark decontamination, mixing to target
weights, sharding. Each stage works on all that its predecessor kept and
returns the columns of ``documents``, further ones and those with an operator's
names included; the last adds shard and slot (``shard_``, ``slot_`` where the
names are taken). Stages are
written and read again in between, so a lost executor costs at most a stage's
own tasks, and a stage deletes the tables that its predecessor worked with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.llm import decontamination, mixing, near_dedup, quality, sharding
from wharf.llm.common import ROW, collected, count_words, materialise, pack, read, release, unpack
from wharf.llm.queries import SHARDS

#: QDA scores, near-copies and shuffles are beyond SQL; tests compare with a plain rewrite.
ORACLE_SQL = None

_tables: list[str] = []               # that the latest stage has written on its way


def _stage(fn, first: bool = False):
    """``fn`` as a stage. Its predecessor's result has been written by now, unless
    ``docs`` still reads the tables behind it; then they stay."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [t.rsplit("/", 1)[1] for t in _tables]
        if first:
            _tables.clear()                          # those of an earlier run's result, which may not be written yet
        elif not any(f"/{n}/" in f for f in docs.inputFiles() for n in names):
            release(spark, _tables)
        with collected(_tables):
            return fn(spark, docs, sf_dir)
    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as written, each with a number: what a stage decides on."""
    return materialise(pack(docs, row=F.monotonically_increasing_id()), "pipeline-rows")


def _fields(rows: DataFrame) -> DataFrame:
    return rows.select("row", f"{ROW}.doc_id", f"{ROW}.text")


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Numbered rows without those of ``gone``, one by one: whatever their ids."""
    return unpack(rows.join(gone.select("row"), "row", "left_anti"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs)
    scored = quality.classify(_fields(rows), read(spark, sf_dir, "labels"), row="row")
    return _without(rows, scored.where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, null ids and repeated rows included."""
    rows = _numbered(docs)
    return _without(rows, near_dedup.near_duplicates(_fields(rows), row="row").where(~F.col("first")))


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of the pipeline's own, which no added column can clash with, and those names."""
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*own.values()), own


def _back(df: DataFrame, own: dict[str, str], *added: str) -> DataFrame:
    """The columns of ``documents`` again, with their values; an added column whose name is taken gets a ``_``."""
    taken = {c.lower() for c in own}
    out = [F.col(n).alias(c) for c, n in own.items()]
    for name in added:
        free = name
        while free.lower() in taken:
            free += "_"
        taken.add(free.lower())
        out.append(F.col(name).alias(free))
    return df.select(*out)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, own = _apart(docs)
    marked = decontamination.mark_benchmark(rows, read(spark, sf_dir, "benchmark"), text=own["text"])
    return _back(marked.where(~F.col("contaminated")), own)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    rows, own = _apart(docs)
    mixed = mixing.curriculum(rows, count_words(F.col(own["text"])), source=own["source"], key=own["doc_id"])
    return _back(mixing.training_order(mixed), own)


def shard_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, own = _apart(docs)
    size = F.octet_length(F.coalesce(F.col(own["text"]), F.lit(""))) + 8
    return _back(sharding.shard(rows, SHARDS, size, key=own["doc_id"]), own, "shard", "slot")


STAGES = [("quality", _stage(keep_quality, first=True)), ("near_dedup", _stage(drop_near_copies)),
          ("decontamination", _stage(drop_contaminated)), ("mixing", _stage(mix_sources)),
          ("sharding", _stage(shard_records))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
