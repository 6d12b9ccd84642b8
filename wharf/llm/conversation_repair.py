"""Conversation structure repair: the cheapest edits to a legal order of roles.

A conversation is legal if its role initials match ``(s?(ua)+)?``: an optional
system turn, then user and assistant in turns, or nothing at all. Rows may be
kept (K, cost 0), given the role user or assistant (R, 2) or deleted (D, 3);
empty user or assistant turns may be inserted (I, 2). Blank rows and rows
whose role and text were seen earlier must go; a truncated row that stays
costs 1 more. Of the cheapest edit sequences the one whose initials are least
in ASCII order is taken.

The search is a Viterbi pass over four states (nothing yet, after s, after u,
after a). Survivors hang in a backpointer tree whose nodes count the nodes
that refer to them; branches that nobody refers to go at once, and as soon as
all survivors share an ancestor the edits up to it are final and leave the
tree. A survivor that another one beats whatever comes (by cost, or by order
at the same cost) is dropped, so that survivors do come together and memory is
bounded by the unresolved rows. Only where the rows leave the answer open for
long do these grow: nothing but user turns, say, where the second edit
depends on whether their number is even. Ties are decided by the complete
unresolved suffixes: no suffix is the beginning of another (all end with the
edit of the same row, and equal edits lead to equal states), so their order
carries over from row to row and the survivors' ranks hold it.

Rows are range-sorted by conversation, turn and content without their texts,
so a conversation of any size is spread over as many tasks as it fills. Where
a partition's edge may cut one, the pass is run from every state that the
conversation can be in there; the pieces, at most two for each partition, are
put together by the same search over pieces.

Order of rows: turn (null first), then role, then the first 64 characters,
then the digest of the text; what is equal in all is interchangeable. A null
conversation is one of its own. Null roles and texts count as one space, an
empty role has no legal initial (it can be rerolled or deleted). Input columns
travel in a struct; no name can clash. An empty table has no edits. The rows
as read, the edits and the choice at partition edges are tables in the shared
folder, so a lost executor costs its own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.llm.common import PART_BITS, ROW, materialise, pack

SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)          # what came last
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
TURN = ((USER, "u"), (USER, "u"), (ASSISTANT, "a"), (USER, "u"))     # what may be inserted or rerolled to
ENDS = {START: (0, ""), ASSISTANT: (0, ""), USER: (2, "Ia"), SYSTEM: (4, "IuIa")}
#: (y, x): what it costs at most to do from state y whatever x would do next.
INSTEAD = {(SYSTEM, START): 4, (USER, START): 5, (ASSISTANT, START): 3, (START, SYSTEM): 0, (USER, SYSTEM): 2,
           (ASSISTANT, SYSTEM): 0, (START, USER): 2, (SYSTEM, USER): 2, (ASSISTANT, USER): 2, (START, ASSISTANT): 0,
           (SYSTEM, ASSISTANT): 4, (USER, ASSISTANT): 2}
REROLE, DELETE, INSERT = 2, 3, 2
CHUNK = 10_000                                     # resolved rows written at a time


class Node:
    """One row's edits in the backpointer tree; ``kids`` are the nodes that refer to it."""

    __slots__ = ("row", "item", "parent", "kids")

    def __init__(self, row, item, parent):
        self.row, self.item, self.parent, self.kids = row, item, parent, set()


@dataclass
class Survivors:
    """The best way into each state from one entry state, and what is settled so far."""

    entry: int
    best: dict[int, tuple[int, int, Node]] = field(default_factory=dict)     # state: cost, rank, last node
    root: Node = field(default_factory=lambda: Node(None, "", None))
    done: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        self.best = {self.entry: (0, 0, self.root)}

    def advance(self, row, ways: dict[int, tuple[int, int, str, Node]]) -> None:
        """Take the best way (cost, rank before, edits, node before) into each state as the new survivors."""
        cheap = {x: w for x, w in ways.items() if not any(
            (ways[y][0] + INSTEAD[y, x], *ways[y][1:3]) < w[:3] for y in ways if y != x)}
        order = sorted(cheap, key=lambda x: cheap[x][1:3])
        old = [node for _, _, node in self.best.values()]
        self.best = {}
        for rank, x in enumerate(order):
            cost, _, item, before = cheap[x]
            node = Node(row, item, before)
            before.kids.add(node)
            self.best[x] = (cost, rank, node)
        for node in old:                               # branches without a survivor
            while not node.kids and node is not self.root:
                node.parent.kids.discard(node)
                node = node.parent
        while len(self.root.kids) == 1:                # an ancestor of all survivors is settled
            self.root = self.root.kids.pop()
            self.root.parent = None
            self.done.append((self.root.row, self.root.item))

    def read(self, row, initial: str, must_go: bool, truncated: bool) -> None:
        ways: dict[int, tuple[int, int, str, Node]] = {}

        def offer(x, cost, rank, item, node):
            if x not in ways or (cost, rank, item) < ways[x][:3]:
                ways[x] = (cost, rank, item, node)

        for x, (cost, rank, node) in self.best.items():
            to, who = TURN[x]
            for y, c, item in ((x, cost, ""), (to, cost + INSERT, "I" + who)):
                offer(y, c + DELETE, rank, item + "D-", node)
                if not must_go:
                    if initial in KEEP[y]:
                        offer(KEEP[y][initial], c + truncated, rank, item + "K-", node)
                    offer(TURN[y][0], c + truncated + REROLE, rank, item + "R" + TURN[y][1], node)
        self.advance(row, ways)

    def tail(self, state: int) -> list[tuple]:
        """The edits of a survivor that are not settled yet."""
        node, out = self.best[state][2], []
        while node is not self.root:
            out.append((node.row, node.item))
            node = node.parent
        return out[::-1]

    def end(self) -> tuple[int, int, str]:
        """State, cost and last inserts of the best complete edit sequence."""
        cost, _, x = min((c + ENDS[x][0], rank, x) for x, (c, rank, _) in self.best.items())
        return x, cost, ENDS[x][1]


def _piece(kind: T.DataType) -> T.StructType:
    """Rows that the pass writes: settled edits (exit null) and tails of pieces of conversations, and one row (chunk -1)
    for each piece with its illegal neighbours, its outer initials and, where no edge cuts it, its cost."""
    f, i, long, s = T.StructField, T.IntegerType(), T.LongType(), T.StringType()
    return T.StructType([f("conv", kind), f("part", long), f("chunk", i), f("open", T.BooleanType()), f("entry", i),
                         f("exit", i), f("cost", long), f("rank", i), f("after", s), f("rows", T.ArrayType(long)),
                         f("items", T.ArrayType(s)), f("illegal", long), f("first", s), f("last", s)])


def _search(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, most: int) -> Iterator[pa.RecordBatch]:
    """The Viterbi pass over the sorted rows of one partition."""
    ints, texts = pa.int32(), pa.string()
    kinds = [conv_type, pa.int64(), ints, pa.bool_(), ints, ints, pa.int64(), ints, texts, pa.list_(pa.int64()),
             pa.list_(texts), pa.int64(), texts, texts]
    names = _piece(T.LongType()).names
    out: list[tuple] = []

    def put(open_, entry, exit_, cost, rank, after, edits):
        out.append((conv, part, chunk[0], open_, entry, exit_, cost, rank, after, [r for r, _ in edits],
                    [i for _, i in edits], None, None, None))
        chunk[0] += 1

    def close(last_here: bool):
        cut, cost = starts or last_here, None
        for s in passes:
            if s.done:
                put(cut, s.entry, None, None, None, None, s.done)
            if cut:
                for x, (least, rank, _) in s.best.items():
                    put(cut, s.entry, x, least, rank, None, s.tail(x))
            else:
                x, cost, after = s.end()
                put(cut, s.entry, x, cost, 0, after, s.tail(x))
        out.append((conv, part, -1, cut, None, None, cost, None, None, None, None, illegal, first, before))

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                          names=names)
        out.clear()
        return rows

    passes, conv, part, chunk, starts = [], None, None, [0], True
    for b in batches:
        for c, p, row, initial, gone, short in zip(*[b.column(k).to_pylist() for k in (
                "conv", "part", "row", "initial", "must_go", "truncated")], strict=True):
            if not passes or c != conv:
                if passes:
                    close(False)
                    starts = False
                conv, part, chunk = c, p, [0]
                passes = [Survivors(e) for e in (range(4) if starts else (START,))]
                illegal, first, before = 0, initial, None
            if before is not None:
                illegal += before + initial not in ("su", "ua", "au")
            before = initial
            for s in passes:
                s.read(row, initial, gone, short)
                if len(s.done) >= most:
                    put(None, s.entry, None, None, None, None, s.done)
                    s.done = []
            if len(out) >= 500:
                yield flush()
    if passes:
        close(True)
    if out:
        yield flush()


def _choice(kind: T.DataType) -> T.StructType:
    f, i, long = T.StructField, T.IntegerType(), T.LongType()
    return T.StructType([f("_conv", kind), f("_part", long), f("_entry", i), f("_exit", i), f("_after", T.StringType()),
                         f("_cost", long), f("_illegal", long)])


def _join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same search over the pieces of each conversation that partitions cut: which entry and exit of each piece."""
    for b in batches:
        keys, rows = [], []
        for k, (ways, edges) in enumerate(zip(b.column("ways").to_pylist(), b.column("edges").to_pylist(), strict=True)):
            s, by_part = Survivors(START), {}
            for w in ways:
                by_part.setdefault(w["part"], []).append(w)
            for part in sorted(by_part):
                best: dict[int, tuple] = {}
                for w in by_part[part]:
                    if w["entry"] in s.best:
                        cost, rank, node = s.best[w["entry"]]
                        way = (cost + w["cost"], rank, w["rank"], (w["entry"], w["exit"]), node)
                        if w["exit"] not in best or way[:3] < best[w["exit"]][:3]:
                            best[w["exit"]] = way
                s.advance(part, {x: (c, (rank, own), item, node) for x, (c, rank, own, item, node) in best.items()})
            x, cost, after = s.end()
            edges = sorted(edges, key=lambda e: e["part"])
            illegal = sum(e["illegal"] for e in edges) + sum(
                a["last"] + z["first"] not in ("su", "ua", "au") for a, z in zip(edges, edges[1:], strict=False))
            chosen = s.done + s.tail(x)
            for at, (part, (entry, exit_)) in enumerate(chosen):
                final = at + 1 == len(chosen)
                keys.append(k)
                rows.append((part, entry, exit_, after if final else None, cost if final else None, illegal if final else None))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [b.column("conv").take(pa.array(keys, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]],
            names=_choice(T.LongType()).names)


def _pieces(rows: DataFrame) -> DataFrame:
    """Faults of each row, the rows in order, and the pass over them."""
    bare = F.rtrim("text", F.lit(SPACES))
    seen = rows.select("row", "conv", "turn", "role", F.sha2("text", 256).alias("digest"),
                       F.substring("text", 1, 64).alias("begins"), F.substring("role", 1, 1).alias("initial"),
                       (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    first = (seen.groupBy("conv", "role", "digest")
             .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "row"))["row"].alias("row")).select("row", F.lit(True).alias("new")))
    faults = seen.join(first, "row", "left").select(
        "row", "conv", "turn", "role", "begins", "digest", "initial", "blank",
        (~F.col("blank") & F.col("new").isNull()).alias("duplicate"),
        (~F.col("blank") & F.col("new").isNotNull() & F.col("cut")).alias("truncated"))
    return materialise(faults, "repair-faults")


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Edits and summary.

    Edits, one row each: conv, part, chunk, at, k (in this order within a conversation), edit (K, R, D or I), role and
    text after it (null where deleted), ROW (the input row, null for an insert). Summary, one row for each
    conversation: conv, n_rows, gaps (turns missing between the least and the greatest, nulls left out), blank,
    duplicate, truncated, illegal (neighbours out of order, as read) and cost."""
    rows = materialise(pack(conversations, row=F.monotonically_increasing_id(), conv=F.col(f"`{conv}`"),
                            turn=F.col(f"`{turn}`"), role=F.coalesce(F.col(f"`{role}`"), F.lit(" ")),
                            text=F.coalesce(F.col(f"`{text}`"), F.lit(" "))), "repair-rows")
    faults = _pieces(rows)
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "begins", "digest", "row")]
    ordered = (faults.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("part", F.shiftright(F.monotonically_increasing_id(), PART_BITS))
               .select("conv", "part", "row", "initial", (F.col("blank") | F.col("duplicate")).alias("must_go"), "truncated"))
    schema = _piece(rows.schema["conv"].dataType)
    pieces = materialise(ordered.mapInArrow(lambda b: _typed(b, chunk), schema), "repair-pieces")
    info = pieces.where("chunk = -1")
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))

    ways = pieces.where("open AND exit IS NOT NULL").groupBy("conv").agg(
        F.collect_list(F.struct("part", "entry", "exit", "cost", "rank")).alias("ways"))
    edges = info.where("open").groupBy(F.col("conv").alias("_conv")).agg(
        F.collect_list(F.struct("part", "illegal", "first", "last")).alias("edges"))
    cut = ways.join(edges, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    chosen = materialise(cut.mapInArrow(_join_pieces, _choice(schema["conv"].dataType)), "repair-chosen")

    edits = pieces.where("chunk >= 0")
    early = (edits.where("open IS NULL").drop("open")              # written before the end of their piece was seen
             .join(info.select(F.col("conv").alias("_conv"), F.col("part").alias("_part"), "open"), same)
             .select(edits.columns))
    edits = edits.where("open IS NOT NULL").unionByName(early)
    taken = (edits.where("open")
             .join(chosen, same & (F.col("entry") == F.col("_entry"))
                   & (F.col("exit").isNull() | (F.col("exit") == F.col("_exit"))))
             .withColumn("after", F.when(F.col("exit").isNotNull(), F.col("_after"))))
    last = F.coalesce(F.col("after"), F.lit("")) != ""
    items = edits.where("NOT open").unionByName(taken.select(edits.columns)).select(
        "conv", "part", "chunk",
        F.when(last, F.concat("rows", F.array(F.lit(None).cast("long")))).otherwise(F.col("rows")).alias("row"),
        F.when(last, F.concat("items", F.array("after"))).otherwise(F.col("items")).alias("item"))
    items = items.select("conv", "part", "chunk", F.posexplode(F.arrays_zip("row", "item")).alias("at", "i"))
    marks = items.select("conv", "part", "chunk", "at", "i.row", F.posexplode(F.regexp_extract_all(
        "i.item", F.lit("[KRDI][-ua]"), F.lit(0))).alias("k", "mark"))
    new_role = F.when(F.endswith("mark", F.lit("u")), "user").when(F.endswith("mark", F.lit("a")), "assistant")
    marks = marks.select("conv", "part", "chunk", "at", "k", F.substring("mark", 1, 1).alias("edit"), new_role.alias("new"), "row")
    inserted = marks.where("edit = 'I'").select("conv", "part", "chunk", "at", "k", "edit", F.col("new").alias("role"),
                                                F.lit("").alias("text"), F.lit(None).cast(rows.schema[ROW].dataType).alias(ROW))
    on_rows = (marks.where("edit <> 'I'").join(rows.select("row", "role", "text", ROW), "row")
               .select("conv", "part", "chunk", "at", "k", "edit",
                       F.when(F.col("edit") != "D", F.coalesce("new", "role")).alias("role"),
                       F.when(F.col("edit") != "D", F.col("text")).alias("text"), ROW))

    counts = faults.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("blank").alias("blank"), F.count_if("duplicate").alias("duplicate"),
        F.count_if("truncated").alias("truncated"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    costs = (info.where("NOT open").select(F.col("conv").alias("_conv"), "cost", "illegal")
             .unionByName(chosen.where("_cost IS NOT NULL")
                          .select("_conv", F.col("_cost").alias("cost"), F.col("_illegal").alias("illegal"))))
    summary = counts.join(costs, F.col("conv").eqNullSafe(F.col("_conv"))).select(
        "conv", "n_rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return on_rows.unionByName(inserted), summary


def _typed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The pass, with the Arrow type of the conversation's id."""
    first = next(batches, None)
    if first is not None:
        yield from _search(chain([first], batches), first.schema.field("conv").type, most)


def in_order(edits: DataFrame) -> DataFrame:
    """Edits of each conversation together and in order, for readers that go through them once."""
    return edits.repartition("conv").sortWithinPartitions("conv", "part", "chunk", "at", "k")
