"""Exact dedup by distributed MSD radix partitioning.

All texts start in the group of their length. Each round reads the next bytes
of every text still in doubt and splits its group by them; a text alone in its
group is done, a group whose texts have ended is a group of equal texts. Bytes
are compared as they are, never digests of them. A round's bytes grow eightfold,
so that there are few rounds even for texts of many megabytes.

Counting is combined before the shuffle and the counts are joined back (a join
whose large partitions AQE splits), so a group of any size is never gathered.
The join is a shuffle at every size: the groups grow with the input, so they
are not broadcast on small inputs either, and what a run costs there is in
proportion to what it costs on large ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.common import ascii_lower, materialise

FIRST_BYTES = 64
GROWTH = 8
MOST_BYTES = 1 << 20                  # bytes compared in one round, a memory bound


def normalised(text):
    """What equality is judged on: A-Z lower-cased, null as empty."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: Sequence[str] = (),
                 first_bytes: int = FIRST_BYTES, growth: int = GROWTH, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row per row: ``key`` and the ``carry`` columns, keep_id, group_size,
    kept and text_sha256 (of the normalised text).

    Of equal texts the row with the largest key stays; a null key is the
    smallest. Of rows that share the largest key exactly one stays. Null text
    equals the empty text. Empty table: no rows. Carried columns are kept in a
    struct meanwhile and may have any name but those of the result.
    """
    norm = normalised(F.col(text))
    state = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([key, *carry])]).alias("who"),
        F.octet_length(norm).cast("long").alias("length"), F.octet_length(norm).cast("long").alias("group"),
        F.sha2(norm, 256).alias("text_sha256"), norm.cast("binary").alias("bytes"),
        F.monotonically_increasing_id().alias("row"))
    done, at, width = [], 0, first_bytes
    while True:
        state = state.withColumn("chunk", F.substring("bytes", at + 1, width))
        groups = materialise(
            state.groupBy("group", "chunk").agg(F.count("*").alias("n")).where("n > 1")
            .select("group", "chunk", F.monotonically_increasing_id().alias("next")), f"radix-groups-{at}")
        ended = F.col("length") <= at + width
        split = materialise(
            state.join(groups.hint("merge"), ["group", "chunk"], "left")
            .select("who", "row", "length", "text_sha256", F.col("next").alias("group"),
                    F.when(F.col("next").isNotNull() & ~ended, F.col("bytes")).alias("bytes")), f"radix-{at}")
        done.append(split.where("bytes is null").select(
            "who", "row", "text_sha256", "group", F.lit(len(done)).alias("round")))
        state = split.where("bytes is not null")
        if state.isEmpty():
            break
        at, width = at + width, min(width * growth, most_bytes)
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    first = F.struct(F.col(f"who.`{key}`").alias("key"), F.col("row"))
    best = materialise(rows.where("group is not null").groupBy("round", "group")
                       .agg(F.count("*").alias("n"), F.max(first).alias("best")), "radix-best")
    alone = F.col("n").isNull()
    return (rows.join(best.hint("merge"), ["round", "group"], "left")
            .select("who.*", F.when(alone, F.col(f"who.`{key}`")).otherwise(F.col("best.key")).alias("keep_id"),
                    F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                    (alone | (F.col("best.row") == F.col("row"))).alias("kept"), "text_sha256"))
