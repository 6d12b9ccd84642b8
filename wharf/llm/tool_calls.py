"""Chat formatting: link tool calls with their results.

Calls and results are hash-joined by identifier, calls put in an order in which
every call follows those it depends on, arguments validated against the tools'
schemas, and each linked call serialised as canonical JSON (keys sorted at every
depth, no white space: what Spark's variant type keeps and prints).

A call's level is one more than the highest level it depends on. Calls with a
single open dependency form chains, which are contracted by pointer doubling, a
logarithm of their length in rounds, for all conversations at once; calls with
several are rewired past the chains and settled or become part of a chain in the
next turn of the same loop. So a conversation of single dependencies takes one
turn, whatever its length; only calls that stay behind several open ones turn
after turn cost a turn each. Calls on a cycle, or behind one, get no level.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm.common import materialise

#: A tool's fields: name -> (kind, required).
Schema = Mapping[str, tuple[str, bool]]
_KINDS = {"string": r"^STRING$", "integer": r"^BIGINT$", "boolean": r"^BOOLEAN$",
          "number": r"^(?:BIGINT|DOUBLE|DECIMAL.*)$", "array": r"^ARRAY", "object": r"^OBJECT"}
TABLES = 32                            # of earlier turns, before they are written as one
TURNS = 256                            # calls are numbered in stretches of so many turns


def problems(arguments: Column, parsed: Column, tool: Column, tools: Mapping[str, Schema]) -> Column:
    """Array of what is wrong with a call's arguments: empty if they are valid."""
    kind = F.schema_of_variant(parsed)
    out = F.when(tool.isNull() | ~tool.isin(*tools), F.array(F.lit("unknown tool")))
    out = out.when(parsed.isNull(), F.array(F.lit("not JSON"))).when(~kind.startswith("OBJECT"),
                                                                   F.array(F.lit("not an object")))
    for name, schema in tools.items():
        own = []
        for field, (wanted, required) in schema.items():
            value = F.try_variant_get(parsed, f"$.{field}", "variant")
            missing = F.when(value.isNull(), F.lit(f"{field}: missing")) if required else F.when(
                value.isNull(), F.lit(None).cast("string"))
            own.append(missing.when(~F.schema_of_variant(value).rlike(_KINDS[wanted]),
                                    F.lit(f"{field}: not {wanted}")))
        extra = F.transform(F.array_sort(F.array_except(F.json_object_keys(arguments),
                                                        F.array(*[F.lit(f) for f in schema]))),
                            lambda f: F.concat(f, F.lit(": unknown")))
        out = out.when(tool == name, F.concat(F.filter(F.array(*own), lambda x: x.isNotNull()), extra))
    return out


def _doubled(links: DataFrame, turn: int) -> DataFrame:
    """Links (call_id, on, base, step) that lead past all further links: ``on`` is
    then no link itself. A call's level is ``max(base, step + level of on)``, and
    such functions compose. Links that end in a cycle are left out."""
    heads = links.select(F.col("call_id").alias("on"), F.lit(False).alias("done"))
    links = materialise(links.join(heads, "on", "left").select(
        "call_id", "on", "base", "step", F.coalesce("done", F.lit(True)).alias("done")), f"calls-links-{turn}-0")
    left, doubling = links.where("not done").count(), 0
    while left:
        doubling += 1
        next_ = links.select(F.col("call_id").alias("via"), F.col("on").alias("end"), F.col("base").alias("b"),
                             F.col("step").alias("s"), F.col("done").alias("ended"))
        moved = (links.where("not done").join(next_, F.col("on") == F.col("via"))
                 .select("call_id", F.col("end").alias("on"),
                         F.greatest("base", F.col("step") + F.col("b")).alias("base"),
                         (F.col("step") + F.col("s")).alias("step"), F.col("ended").alias("done")))
        links = materialise(links.where("done").unionByName(moved), f"calls-links-{turn}-{doubling}")
        before, left = left, links.where("not done").count()
        if left == before:             # chains twice as long as any that ended: cycles
            break
    return links.where("done").drop("done")


def _levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): 0 for calls that depend on no known call, else one more
    than the highest level they depend on; no row for calls on or behind a cycle."""
    known = calls.select("call_id").distinct()
    edges = materialise(
        calls.select("call_id", F.explode("depends_on").alias("on")).where("on is not null").distinct()
        .join(known.withColumnRenamed("call_id", "on"), "on", "left_semi")
        .withColumn("step", F.lit(1).cast("long")), "calls-edges")
    # open calls: base is the level that their settled dependencies ask for, degree the open ones
    open_ = materialise(known.withColumn("base", F.lit(0).cast("long")).join(
        edges.groupBy("call_id").agg(F.count("*").alias("degree"), F.min("on").alias("on"),
                                     F.min("step").alias("step")), "call_id", "left"), "calls-open")
    settled, chained, turn = [], [], 0
    while True:
        turn += 1
        free = open_.where("degree is null").select("call_id", F.col("base").alias("level"))
        links = _doubled(open_.where("degree = 1").select("call_id", "on", "base", "step"), turn)
        settled.append(free)
        chained.append(links)
        if len(settled) == TABLES:     # so that no plan reads more tables than these
            settled = [materialise(_union(settled), "calls-settled")]
            chained = [materialise(_union(chained), "calls-chained")]
        joins = open_.where("degree > 1").select("call_id", "base")
        if joins.isEmpty() or (free.isEmpty() and links.isEmpty()):
            break
        past = links.select(F.col("call_id").alias("on"), F.col("on").alias("end"), F.col("base").alias("b"),
                            F.col("step").alias("s"))
        ends = free.select(F.col("call_id").alias("end"), "level")
        rewired = (edges.join(joins.select("call_id"), "call_id", "left_semi").join(past, "on", "left")
                   .select("call_id", F.coalesce("end", "on").alias("end"),
                           (F.col("step") + F.col("b")).alias("asked"),
                           (F.col("step") + F.coalesce("s", F.lit(0))).alias("step"))
                   .join(ends, "end", "left")
                   .groupBy("call_id", "end").agg(F.max("asked").alias("asked"), F.max("step").alias("step"),
                                                  F.max("level").alias("level")))
        rewired = materialise(rewired.withColumn("asked", F.greatest("asked", F.col("step") + F.col("level"))),
                              f"calls-rewired-{turn}")
        edges = rewired.where("level is null").select("call_id", F.col("end").alias("on"), "step")
        waits = F.col("level").isNull()
        per_call = rewired.groupBy("call_id").agg(
            F.max("asked").alias("asked"), F.nullif(F.count_if(waits), F.lit(0)).alias("degree"),
            F.min(F.when(waits, F.col("end"))).alias("on"), F.min(F.when(waits, F.col("step"))).alias("step"))
        open_ = materialise(joins.join(per_call, "call_id").select(
            "call_id", F.greatest("base", F.coalesce("asked", F.lit(0))).alias("base"), "degree", "on", "step"),
            f"calls-open-{turn}")
    # each call was settled or became a link once, so the links of all turns are chains that end in a settled call
    free = _union(settled)
    ends = free.select(F.col("call_id").alias("on"), "level")
    out = free.unionByName(_doubled(_union(chained), 0).join(ends, "on").select(
        "call_id", F.greatest("base", F.col("step") + F.col("level")).alias("level")))
    return out.select("call_id", F.col("level").cast("int").alias("level"))


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def link(calls: DataFrame, results: DataFrame, tools: Mapping[str, Schema]) -> DataFrame:
    """One row per call and result, and per result without a call.

    calls: conv_id, turn, call_id, tool, arguments (JSON text), depends_on (array
    of call ids). results: call_id, content. Returned: conv_id, turn, call_id,
    tool, level, place (in the conversation, from 0, after all it depends on),
    status, problems and message (canonical JSON).

    status: ``linked``, ``unanswered`` (no result), ``orphan`` (a result without
    a call: conversation, place and message null) or ``cycle`` (no level and no
    place). Dependencies on unknown calls and null ones count for nothing. A null
    call_id links with nothing, and each call without one is a row of its own, at
    level 0. Of repeated calls (same id) the smallest row counts, of repeated
    results every one is a row. Arguments that are null or
    not JSON are a problem, not an error; the message then has them as null.
    Empty tables: no rows of that side. Further columns are not carried.
    """
    parsed = F.try_parse_json("arguments")
    calls = calls.select("conv_id", "turn", "call_id", "tool", "arguments",
                         F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    calls = (calls.where("call_id is not null").groupBy("call_id")
             .agg(F.min(F.struct("conv_id", "turn", "tool", "arguments", "depends_on")).alias("c"))
             .select("call_id", "c.*").unionByName(calls.where("call_id is null"))
             .withColumn("row", F.monotonically_increasing_id()))
    calls = materialise(calls.withColumn("problems", problems(F.col("arguments"), parsed, F.col("tool"), tools)),
                        "calls")
    levels = _levels(calls.where("call_id is not null"))
    placed = calls.join(levels, "call_id", "left").withColumn("level", F.when(
        F.col("call_id").isNull(), F.lit(0)).otherwise(F.col("level")))
    # place = calls of the conversation at lower levels, or at this one in earlier
    # stretches, or earlier in this stretch: no task holds a whole conversation
    stretch = ["conv_id", "level", "stretch", "part"]
    # calls with neither turn nor id would be one stretch: they are cut by row, and come first
    loose = F.col("turn").isNull() & F.col("call_id").isNull()
    placed = placed.withColumns({"stretch": F.floor(F.col("turn") / F.lit(float(TURNS))),
                                 "part": F.when(loose, F.floor(F.col("row") / F.lit(float(TURNS))))})
    upto = (Window.partitionBy("conv").orderBy("level", "stretch", F.col("part").asc_nulls_last())
            .rowsBetween(Window.unboundedPreceding, -1))
    starts = (placed.where("level is not null").groupBy(*stretch).agg(F.count("*").alias("n"))
              .withColumn("conv", F.col("conv_id"))
              .select(*[F.col(c).alias(f"s_{c}") for c in stretch], F.coalesce(F.sum("n").over(upto), F.lit(0))
                      .alias("start")))
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in stretch]
    inside = Window.partitionBy(*stretch).orderBy("turn", "call_id", "row")
    placed = (placed.join(starts, same[0] & same[1] & same[2] & same[3], "left")
              .withColumn("place", F.col("start") + F.row_number().over(inside) - 1))
    answers = results.select(F.col("call_id").alias("of"), "content", F.lit(True).alias("answered"))
    rows = (placed.where("call_id is not null").join(answers, F.col("call_id") == F.col("of"), "full")
            .unionByName(placed.where("call_id is null"), allowMissingColumns=True))
    message = F.struct(
        F.to_json(F.try_parse_json("arguments")).alias("arguments"), F.col("call_id").alias("id"),
        F.col("tool").alias("name"), F.col("content").alias("result"))
    text = F.concat(F.lit('{"arguments":'), F.coalesce(message["arguments"], F.lit("null")),
                    *[F.concat(F.lit(f',"{k}":'), F.coalesce(_quoted(message[k]), F.lit("null")))
                      for k in ("id", "name", "result")], F.lit("}"))
    orphan = F.col("place").isNull() & F.col("conv_id").isNull() & F.col("call_id").isNull() & F.col("answered")
    status = (F.when(orphan, "orphan").when(F.col("level").isNull(), "cycle")
              .when(F.col("answered"), "linked").otherwise("unanswered"))
    return rows.select("conv_id", "turn", F.coalesce("call_id", "of").alias("call_id"), "tool", "level",
                       F.col("place").cast("long").alias("place"), status.alias("status"), "problems",
                       F.when(~F.coalesce(orphan, F.lit(False)), text).alias("message"))


def _quoted(value: Column) -> Column:
    """A string as JSON text; null stays null."""
    text = F.to_json(F.array(value))
    return F.when(value.isNotNull(), F.substring(text, F.lit(2), F.length(text) - 2))
