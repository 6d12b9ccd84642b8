"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight schedule over training time 0..1. Its integral gives
the source's share of the words to train on; inverting the cumulative demand
turns a document's place in its source into a position in time, and documents
are range-sorted by position.

The place of a document is an exclusive prefix sum over its source in seeded
order. A source may hold a third of all rows, so the sum has two levels: each
source is cut into about sqrt(rows) hash ranges, range totals are summed up
first, and only rows of one range meet in a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import PART_BITS, materialise, pack, unpack

WEIGHTS = (5, 2, 1)                    # mean weights, repeating over the sources in order
#: Weight over time relative to its mean, as (time, height) knots for each of WEIGHTS:
#: heavy sources grow, light ones fade.
SHAPES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
SHARE = 1.5                            # words of the mix, of all words
CAP = 2.0                              # most of a source's words, of its own
SEED = 20240201
#: How the texts are written that are shuffled twice afterwards.
_SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": 9}
_HEX = 10                              # hex digits of the seeded order
_ORDER_SPAN = float(16 ** _HEX)


def integrate(shape: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Pieces (t0, t1, rate at t0, slope, cumulative share at t0) of a schedule
    whose integral is scaled to 1."""
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(shape, shape[1:], strict=False))
    if area <= 0 or shape[0][0] != 0 or shape[-1][0] != 1:
        raise ValueError("a schedule runs from time 0 to 1 and weighs more than nothing")
    out, done = [], 0.0
    for (t0, h0), (t1, h1) in zip(shape, shape[1:], strict=False):
        if t1 > t0:
            out.append((t0, t1, h0 / area, (h1 - h0) / area / (t1 - t0), done))
            done += (t1 - t0) * (h0 + h1) / 2 / area
    return out


def position(part: Column, kind: Column, shapes=SHAPES) -> Column:
    """Time at which a source of schedule ``kind`` has met ``part`` (0..1) of
    its demand: the inverse of the integrated schedule, a square root per piece."""
    out = F.lit(None).cast("double")
    for k, shape in enumerate(shapes):
        for t0, _, rate, slope, done in integrate(shape):
            left = part - F.lit(done)
            root = F.lit(rate) + F.sqrt(F.lit(rate * rate) + F.lit(2 * slope) * left)
            t = F.lit(t0) + F.when(root > 0, F.lit(2.0) * left / root).otherwise(0.0)
            out = F.when((kind == k) & (left >= 0), t).otherwise(out)
    return out


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """Words to take from each source (columns source, source_size, n_docs; one
    row each): shares by weight, none above ``cap`` times its source, the excess
    reshared by weight. In order of cap to weight the capped sources come first;
    the level that fits is the highest of those that each prefix leaves."""
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    s = (_running(sources.withColumn("rows", F.lit(1)), ["source is null", "source"], ["rows"], "mixing-names")
         .withColumn("kind", (F.col("rows_before") % len(weights)).cast("int"))
         .withColumn("weight", F.element_at(kinds, F.col("kind") + 1))
         .withColumn("most", F.col("source_size") * F.lit(float(cap)))
         .select("source", "source_size", "n_docs", "kind", "weight", "most"))
    s = _running(s, ["most / weight", "source is null", "source"], ["most", "weight", "source_size"], "mixing-caps")
    level = ((F.col("source_size_all") * F.lit(float(share)) - F.col("most_before"))
             / (F.col("weight_all") - F.col("weight_before")))
    fits = s.agg(F.max(level)).first()[0]                  # one number, null without sources
    return s.select("source", "source_size", "n_docs", "kind",
                    F.least("most", F.lit(fits).cast("double") * F.col("weight")).alias("target"))


def _running(rows: DataFrame, order: Sequence[str], cols: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``<c>_before`` (sum over the rows before in ``order``) and ``<c>_all`` (over all rows) for
    each of ``cols``. One range sort; each range adds up its own rows and gets the sums of the ranges before, so
    no task sees more than a range, or one number a range."""
    ordered = materialise(rows.repartitionByRange(*map(F.expr, order)).sortWithinPartitions(*map(F.expr, order))
                          .withColumn("place", F.monotonically_increasing_id()), name)
    ordered = ordered.withColumn("part", F.shiftright("place", PART_BITS))
    parts = ordered.groupBy("part").agg(*[F.sum(c).alias(f"{c}_part") for c in cols]).withColumn("every", F.lit(0))
    own = Window.partitionBy("every")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", *[F.sum(f"{c}_part").over(own).alias(f"{c}_all") for c in cols],
                         *[F.sum(f"{c}_part").over(before).alias(f"{c}_ahead") for c in cols])
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (ordered.join(parts, "part")
            .withColumns({f"{c}_before": F.coalesce(f"{c}_ahead", F.lit(0)) + F.coalesce(F.sum(c).over(inside), F.lit(0))
                          for c in cols})
            .drop("part", "place", *[f"{c}_ahead" for c in cols]))


def seeded_order(key: Column, seed: int = SEED) -> Column:
    """A document's place in its source as an integer below 16^10, from its id
    and the seed alone."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("long")


def curriculum(docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id",
               weights=WEIGHTS, shapes=SHAPES, share=SHARE, cap=CAP, seed=SEED) -> DataFrame:
    """Each row of ``docs`` with its part in the mix.

    Added columns: size, source_size, target (of its source), taken (size times
    the times it is taken), positions (array of times 0..1, one each time it is
    taken). A document is taken in pass e over its source if the middle of its
    words lies before the target, so a source ends within half a document of it.

    Null source: a source of its own, last. Null or empty text, size 0: never
    taken. Equal ids: ordered by size; rows equal in both are interchangeable.
    Empty table: no rows. Input columns named like an added one give way to it.
    """
    base = materialise(pack(docs, source=F.col(source), size=F.coalesce(size, F.lit(0)).cast("long"),
                            key=F.col(key), place=seeded_order(F.col(key), seed)), "mixing", **_SMALL)
    per_source = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = materialise(targets(per_source, weights, share, cap)
                       .withColumnRenamed("source", "plan_source"), "mixing-targets")
    rows = (base.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")
            .withColumn("range", F.floor(F.col("place") / F.lit(_ORDER_SPAN) * F.ceil(F.sqrt("n_docs")))))
    upto = Window.partitionBy("s", "named").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNotNull().alias("named"),
                           F.col("range").alias("r")).agg(F.sum("size").alias("in_range"))
              .select("s", "named", "r", F.coalesce(F.sum("in_range").over(upto), F.lit(0)).alias("start")))
    inside = (Window.partitionBy("s", "named", "r").orderBy("place", "key", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.withColumns({"s": F.coalesce("source", F.lit("")), "named": F.col("source").isNotNull()})
            .withColumnRenamed("range", "r").join(starts, ["s", "named", "r"])
            .withColumn("offset", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0))))
    middle = F.col("offset") + F.col("size") / 2.0
    passes = F.filter(F.sequence(F.lit(0), F.lit(ceil(cap) - 1)),
                      lambda e: (F.col("size") > 0) & (e * F.col("source_size") + middle < F.col("target")))
    rows = rows.withColumn("passes", passes).withColumns({
        "taken": F.col("size") * F.size("passes"),
        "positions": F.transform("passes", lambda e: position(
            (e * F.col("source_size") + middle) / F.col("target"), F.col("kind"), shapes))})
    return unpack(rows, "size", "source_size", "target", "taken", "positions")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each time a document is taken, range-sorted by position
    (column position; ties by nothing further)."""
    return (mixed.withColumn("position", F.explode("positions")).drop("positions")
            .orderBy("position"))
