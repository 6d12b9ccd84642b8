"""Merkle manifest of a dataset, with octopus multiproofs.

Every document is a leaf. The leaves of a tree (a language, say) stand in
order, every two consecutive nodes become their parent, a last one alone too,
and the trees' roots are in turn the leaves of one tree over them.

``build`` writes the manifest: all nodes with their coordinates (tree, level,
index). Trees grow by rounds of eight levels, each round in blocks of 256
consecutive nodes, so a tree of a thousand million leaves takes four rounds
and no task needs more than a block.

``prove`` gives each leaf the siblings on its way to the root. It works by
partitions of at most 256 consecutive leaves: a partition finds the least set
of nodes that its leaves don't give (the octopus: on each level the siblings
of known nodes that aren't known themselves), all partitions' coordinates are
fetched from the manifest in one join, and each partition then derives the
nodes that its leaves share once and reads the single proofs off them.
``folded`` recomputes a root from a leaf and its proof in the JVM.

Rows without an order value come first, a null tree is a tree like any other;
equal rows are leaves of their own, next to each other. An empty table has an
empty manifest. Carried columns travel in a struct, so no name can clash.
A lost executor costs its tasks only: the ordered leaves, the nodes and the
coordinates are tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.llm.common import ROW, groups, materialise, numbered

BITS = 8                               # levels of a round; a block has 2 ** BITS nodes
TREE, TOP = 0, 1                       # nodes of the single trees, and of the tree over their roots
_IS_ROOT = "shiftright(n - 1, level) = 0"                  # no node stands above the first with this

NODES = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("tree", T.StringType()),
                      T.StructField("n", T.LongType()), T.StructField("level", T.IntegerType()),
                      T.StructField("index", T.LongType()), T.StructField("hash", T.StringType())])
_WANTED = T.StructType([T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()),
                        T.StructField("kind", T.IntegerType()), T.StructField("level", T.IntegerType()),
                        T.StructField("index", T.LongType())])


def leaf_hash(*fields: Column) -> Column:
    """Digest of fields written one after the other: ``-`` for null, else byte count, ``:`` and value."""
    def written(c: Column) -> Column:
        text = c.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))
    return F.sha2(F.concat(*[written(c) for c in fields]), 256)


def leaves(docs: DataFrame, tree: str, order: str, leaf: Column, carry: dict[str, Column]) -> DataFrame:
    """Numbered leaves: ROW (the carried columns), tree, hash, n, index, and the tree's rank among ``trees``."""
    rows = docs.select(F.struct(*[c.alias(n) for n, c in carry.items()]).alias(ROW),
                       F.col(tree).cast("string").alias("tree"), F.col(order).alias("at"), leaf.alias("hash"))
    found = materialise(numbered(rows, "tree", ["at", "hash"], "manifest-order").drop("at"), "manifest-leaves")
    trees = found.where("index = 0").select(F.lit(0).alias("all"), F.col("tree").alias("_tree"))
    trees = (numbered(trees, "all", ["_tree"], "manifest-trees")
             .select("_tree", F.col("index").alias("rank"), F.col("n").alias("trees")))
    return found.join(trees, found["tree"].eqNullSafe(trees["_tree"])).drop("_tree")


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _batches(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(
        cols, schema, strict=True)], names=schema.names)


def _grow(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The parents, up to ``bits`` levels up, of each block of consecutive nodes."""
    made: list[tuple] = []
    for block in groups(batches, "kind", "tree", "block"):
        kind, tree, n, level = (block.column(c)[0].as_py() for c in ("kind", "tree", "n", "level"))
        first, hashes = block.column("index")[0].as_py(), block.column("hash").to_pylist()
        for up in range(level + 1, level + bits + 1):
            if (n - 1) >> (up - 1) == 0:                           # the level below is the root
                break
            first >>= 1
            hashes = [_h("".join(hashes[i:i + 2])) for i in range(0, len(hashes), 2)]
            made += [(kind, tree, n, up, first + i, h) for i, h in enumerate(hashes)]
        if len(made) >= 5000:
            yield _batches(made, NODES)
            made = []
    yield _batches(made, NODES)


def _forest(level0: DataFrame, name: str) -> DataFrame:
    """All nodes of trees whose leaves are ``level0`` (NODES columns)."""
    most = level0.agg(F.max("n")).first()[0] or 0
    nodes, now, bits = level0, level0, BITS
    for level in range(0, (most - 1).bit_length() if most else 0, bits):
        blocks = (now.where(F.shiftright(F.col("n") - 1, level) > 0)
                  .withColumn("block", F.shiftright("index", bits)).repartition("kind", "tree", "block")
                  .sortWithinPartitions("kind", "tree", "block", "index"))
        made = materialise(blocks.mapInArrow(lambda b: _grow(b, bits), NODES), f"{name}-{level + bits}")
        nodes, now = nodes.unionByName(made), made.where(F.col("level") == level + bits)
    return nodes


def build(leaves: DataFrame) -> DataFrame:
    """The manifest: one row for each node, of the trees (kind 0, level 0 the leaves) and of the tree over them (kind 1)."""
    level0 = leaves.select(F.lit(TREE).alias("kind"), "tree", "n", F.lit(0).alias("level"), "index", "hash")
    nodes = _forest(level0, "manifest-nodes")
    ranks = leaves.where("index = 0").select(F.col("tree").alias("_tree"), "rank", "trees")
    top = (nodes.where(_IS_ROOT).join(ranks, F.col("tree").eqNullSafe(F.col("_tree")))
           .select(F.lit(TOP).alias("kind"), F.lit(None).cast("string").alias("tree"), F.col("trees").alias("n"),
                   F.lit(0).alias("level"), F.col("rank").alias("index"), "hash"))
    return nodes.unionByName(_forest(materialise(top, "manifest-roots"), "manifest-top"))


def root(nodes: DataFrame) -> DataFrame:
    """The root of the manifest (column ``hash``; no row for an empty dataset)."""
    return nodes.where(F.col("kind") == TOP).where(_IS_ROOT).select("hash")


def missing(known: Sequence[int], n: int) -> Iterator[tuple[int, int]]:
    """Coordinates (level, index) needed besides the leaves ``known`` to reach the root of ``n`` leaves."""
    now, level = set(known), 0
    while n > 1:
        for i in sorted(now):
            if i ^ 1 < n and i ^ 1 not in now:
                yield level, i ^ 1
        now, n, level = {i >> 1 for i in now}, (n + 1) >> 1, level + 1


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    asked: list[tuple] = []
    for part in groups(batches, "tree", "block"):
        tree, block, n, rank, trees = (part.column(c)[0].as_py() for c in ("tree", "block", "n", "rank", "trees"))
        asked += [(tree, block, TREE, *at) for at in missing(part.column("index").to_pylist(), n)]
        asked += [(tree, block, TOP, *at) for at in missing([rank], trees)]
        if len(asked) >= 5000:
            yield _batches(asked, _WANTED)
            asked = []
    yield _batches(asked, _WANTED)


def _climb(known: dict[int, str], n: int, given: dict[tuple[int, int], str]) -> tuple[list[dict[int, str]], str]:
    """All nodes above ``known`` that they and the given ones make, level by level, and the root."""
    levels, level = [], 0
    while n > 1:
        full = dict(known)
        for i in known:
            if i ^ 1 < n and i ^ 1 not in full:
                full[i ^ 1] = given[level, i ^ 1]
        levels.append(full)
        known = {i: _h(full[2 * i] + full.get(2 * i + 1, "")) for i in {i >> 1 for i in known}}
        n, level = (n + 1) >> 1, level + 1
    return levels, next(iter(known.values()))


def _way(i: int, levels: list[dict[int, str]]) -> list[str]:
    """Siblings on the way up from node ``i``: ``L`` or ``R`` for their side and the digest, empty for none."""
    out = []
    for full in levels:
        beside = full.get(i ^ 1)
        out.append("" if beside is None else ("L" if i & 1 else "R") + beside)
        i >>= 1
    return out


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single proofs of each partition's leaves, out of its fetched nodes, which come first."""
    for part in groups(batches, "tree", "block"):
        is_leaf, at = part.column("is_leaf").to_pylist(), part.column("index").to_pylist()
        hashes, kinds, level = (part.column(c).to_pylist() for c in ("hash", "kind", "level"))
        cut = is_leaf.index(True)
        n, rank, trees = (part.column(c)[cut].as_py() for c in ("n", "rank", "trees"))
        given: tuple[dict, dict] = ({}, {})
        for i in range(cut):
            given[kinds[i]][level[i], at[i]] = hashes[i]
        levels, subroot = _climb(dict(zip(at[cut:], hashes[cut:], strict=True)), n, given[TREE])
        tops, top = _climb({rank: subroot}, trees, given[TOP])
        last = _way(rank, tops)
        own = part.slice(cut)
        yield pa.RecordBatch.from_arrays(
            [own.column(ROW), own.column("tree"), own.column("index"), own.column("hash"),
             pa.array([subroot] * len(own)), pa.array([top] * len(own)),
             pa.array([_way(i, levels) + last for i in at[cut:]], pa.list_(pa.string()))],
            names=[ROW, "tree", "index", "leaf", "subroot", "root", "proof"])


def prove(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Proofs of ``leaves`` (all, or any of them) against the manifest ``nodes``: ROW, tree, index, leaf, subroot,
    root and proof, the siblings from the leaf up."""
    own = leaves.withColumn("block", F.shiftright("index", BITS))
    by = ["tree", "block"]
    asked = (own.select("tree", "block", "n", "rank", "trees", "index").repartition(*by)
             .sortWithinPartitions(*by).mapInArrow(_ask, _WANTED))
    asked = materialise(asked, "manifest-asked")
    of = nodes.select("kind", F.col("tree").alias("_tree"), "level", "index", "hash")
    tree_of = F.when(F.col("kind") == TREE, F.col("tree"))
    fetched = (asked.withColumn("_of", tree_of)
               .join(of, (F.col("_of").eqNullSafe(F.col("_tree"))) & (asked["kind"] == of["kind"])
                     & (asked["level"] == of["level"]) & (asked["index"] == of["index"]))
               .select("tree", "block", asked["kind"], asked["level"], asked["index"], "hash"))
    stream = (fetched.withColumn("is_leaf", F.lit(False))
              .unionByName(own.withColumns({"is_leaf": F.lit(True), "kind": F.lit(TREE), "level": F.lit(0)}),
                           allowMissingColumns=True)
              .repartition(*by).sortWithinPartitions(*by, "is_leaf"))
    text = T.StringType()
    out = T.StructType([leaves.schema[ROW], T.StructField("tree", text), T.StructField("index", T.LongType()),
                        T.StructField("leaf", text), T.StructField("subroot", text), T.StructField("root", text),
                        T.StructField("proof", T.ArrayType(text))])
    return stream.mapInArrow(_expand, out)


def siblings(proof: Column) -> Column:
    """The digests of a proof, without their sides."""
    return F.transform(F.filter(proof, lambda s: s != ""), lambda s: F.substring(s, 2, 64))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(now: Column, s: Column) -> Column:
        other = F.substring(s, 2, 64)
        return F.sha2(F.when(s.startswith("L"), F.concat(other, now)).when(s.startswith("R"), F.concat(now, other))
                      .otherwise(now), 256)
    return F.aggregate(proof, leaf, up)
