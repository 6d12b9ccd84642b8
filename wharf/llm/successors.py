"""Documents side by side with the next one in id order, without a global window.

The ids are range-sorted once without their texts. Every 2,000th row (of more
than 200 million rows, every 100,000th part) begins a block; the blocks' first keys,
at most 100,000 pairs of numbers, go to the tasks that read the texts. Each
row is sent to its block, a block's first row to the block before as well, so
one shuffle of the texts puts every document and its successor into one task,
which reads its blocks in order and holds two texts at a time.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.llm.common import numbered

BLOCK_ROWS, MOST_BLOCKS = 2000, 100_000
_KEY = ["named", "id", "digest"]


def in_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (block, ahead, named, id, digest, text) partitioned by block and sorted: a block's own documents in
    order of ``key``, a long (null first, ties by the text's digest), then the next block's first (``ahead``), after
    the last block the first of all. Null text counts as empty. Rows equal in both are neighbours in one block."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).isNotNull().alias("named"), F.coalesce(F.col(key), F.lit(0)).cast("long").alias("id"),
                       F.xxhash64(body).alias("digest"), body.alias("text"))
    places = numbered(rows.select(*_KEY, F.lit(0).alias("all")), "all", _KEY, "successor-order")
    step = F.greatest(F.lit(BLOCK_ROWS), F.ceil(F.col("n") / MOST_BLOCKS))
    firsts = sorted({tuple(r) for r in places.where(F.col("index") % step == 0).select(*_KEY).collect()})
    last = len(firsts) - 1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = list(zip(*[b.column(c).to_pylist() for c in _KEY], strict=True))
            at = [bisect_right(firsts, k) - 1 for k in keys]
            own = pa.array(at, pa.int64())
            begins = [i for i, k in enumerate(keys) if firsts[at[i]] == k]
            take = pa.array([*range(len(keys)), *begins], pa.int64())
            block = pa.concat_arrays([own, pa.array([at[i] - 1 if at[i] else last for i in begins], pa.int64())])
            ahead = pa.array([False] * len(keys) + [True] * len(begins))
            yield pa.RecordBatch.from_arrays([block, ahead, *[c.take(take) for c in b.columns]],
                                             names=["block", "ahead", *b.schema.names])

    out = T.StructType([T.StructField("block", T.LongType()), T.StructField("ahead", T.BooleanType()), *rows.schema])
    return (rows.mapInArrow(assign, out).repartition("block")
            .sortWithinPartitions("block", "ahead", *_KEY))


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str, bool]]:
    """(id, text, next text, same block as the row before) of the rows that ``in_blocks`` deals out, in order."""
    block, held, first = None, None, True
    for b in batches:
        for at, ahead, named, key, text in zip(*[b.column(c).to_pylist() for c in (
                "block", "ahead", "named", "id", "text")], strict=True):
            if at != block:
                block, held, first = at, None, True
            if held:
                yield (*held, text, not first)
                first = False
            held = None if ahead else (key if named else None, text)
