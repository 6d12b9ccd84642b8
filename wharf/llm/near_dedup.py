"""MinHash near-dedup: minima of many universal hashes, banding, signature
verification, an exact check on whole shingle sets, connected components.

Documents with the same sequence of words are one node, named by a digest of
it. Two nodes whose minima agree in a whole band share a bucket. Buckets can
hold a large part of all nodes, so their pairs are never listed:

1. Star: each bucket's most connected node is compared with the others of the
   bucket, which settles most of it.
2. Rest: only buckets that still hold several components go on, without nodes
   whose own shingles (found in no other node left) rule out any partner. Their
   members are compared in blocks, inside tasks, and only pairs of different
   components that signature and own shingles allow come out.

Each pair of step 1 and 2 is confirmed on the whole sets; nothing is capped.
The sets are written once, bucketed by node; ids that grow with the documents
are joined by sort and merge at every size, never sent to every executor by us.
With 25 bands of 5 minima a pair at a similarity of 0.85 is missed with a
probability of 4e-7, a more similar one with less.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm import wordhash
from wharf.llm.common import bucketed, materialise
from wharf.llm.components import connected_components

SHINGLE = 3
PERCENT = 85                          # link at 100 * common >= PERCENT * union
BANDS, ROWS = 25, 5
SLACK = 0.17                          # below the threshold, of estimates: over 5 standard deviations
SAMPLE = 256                          # shingles of a node that blocks are compared by, at most about
BLOCK = 256                           # members compared with as many others in a task
SEED = 20240203


def _hashes(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def _shingles(words: wordhash.Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a batch and each row's bounds; a row of fewer than k
    words has its whole sequence as its only shingle."""
    gram, at = wordhash.grams(words, k)
    bounds = np.searchsorted(at, words.first)
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            a, b = words.first[r], words.first[r + 1]
            h = hashlib.blake2b(words.text(a, b), digest_size=8).digest()
            extra[i] = np.frombuffer(h, dtype=np.uint64)[0]
        gram = np.insert(gram, bounds[short], extra)
        bounds = bounds + np.concatenate([[0], np.cumsum((count > 0) & (count < k))])
    return gram, bounds


def _digests(words: wordhash.Words, rows: int) -> list[bytes | None]:
    """A 128-bit digest of each row's word sequence; None without words."""
    space = ~wordhash.NOT_SPACE[words.low]
    low = np.where(space, np.uint8(32), words.low)
    keep = ~space
    keep[1:] |= ~space[:-1]                          # one space after each word
    count = np.concatenate([[0], np.cumsum(keep)])
    flat = low[keep].tobytes()
    out: list[bytes | None] = []
    for i in range(rows):
        a, b = words.first[i], words.first[i + 1]
        if a == b:
            out.append(None)
            continue
        text = flat[count[words.start[a]]:count[words.end[b - 1]]]
        out.append(hashlib.blake2b(text, digest_size=16).digest())
    return out


def _minima(gram: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Upper 32 bits of each row's minimum under every hash (rows with shingles only)."""
    out = np.empty((len(bounds) - 1, len(a)), dtype=np.uint32)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(out):
            upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + 16384, side="right")) - 1)
            g, starts = gram[bounds[at]:bounds[upto]], bounds[at:upto] - bounds[at]
            buf = np.empty_like(g)
            for j in range(len(a)):
                np.multiply(g, a[j], out=buf)
                np.add(buf, b[j], out=buf)
                out[at:upto, j] = np.minimum.reduceat(buf, starts) >> np.uint64(32)
            at = upto
    return out


def _batches(it: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of text."""
    for batch in it:
        lengths = np.diff(wordhash.bytes_of(batch.column(text))[1])
        cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // most)) + 1 if len(lengths) else []
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _arrays(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(kind)))


def _sign(k: int, n: int, seed: int):
    def run(it):
        a, b = _hashes(n, seed)
        for batch in _batches(it, 1):
            words = wordhash.split(batch.column(1), wordhash.NOT_SPACE)
            gram, bounds = _shingles(words, k)
            size = np.array([len(np.unique(gram[x:y])) for x, y in zip(bounds[:-1], bounds[1:], strict=True)],
                            dtype=np.int64)
            full = np.flatnonzero(size)
            sig = _minima(gram, np.append(bounds[full], len(gram)), a, b) if len(full) else np.zeros((0, n), np.uint32)
            ends = np.concatenate([[0], np.cumsum(size > 0)]) * n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_digests(words, batch.num_rows), pa.binary()), pa.array(size),
                 _arrays(sig.ravel(), ends, np.int32), *batch.columns[2:]],
                ["id", "node", "size", "sig", *batch.schema.names[2:]])
    return run


def _level(size: np.ndarray) -> np.ndarray:
    """How often a set is halved to get down to SAMPLE shingles."""
    return np.ceil(np.log2(np.maximum(size, 1) / SAMPLE)).clip(0).astype(np.int64)


def _sets(k: int):
    """Digest, shingle set and sample of each text: the shingles whose last
    ``level`` bits are 0, by their last 32 bits, so that the samples of two sets
    can be brought to the same rate."""
    def run(it):
        for batch in _batches(it, 0):
            words = wordhash.split(batch.column(0), wordhash.NOT_SPACE)
            gram, bounds = _shingles(words, k)
            sets = [np.unique(gram[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
            size = np.array([len(s) for s in sets], dtype=np.int64)
            last = [s.astype(np.uint32) for s in sets]
            some = [s[s & np.uint32((1 << n) - 1) == 0] for s, n in zip(last, _level(size).tolist(), strict=True)]
            ends = [np.concatenate([[0], np.cumsum([len(s) for s in x])]) for x in (sets, some)]
            empty = np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_digests(words, batch.num_rows), pa.binary()),
                 _arrays(np.concatenate([empty, *sets]), ends[0], np.int64),
                 _arrays(np.concatenate([empty.astype(np.uint32), *some]), ends[1], np.int32)],
                ["node", "shingles", "sample"])
    return run


def _bucket_names(bands: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(i), F.slice("sig", i * rows + 1, rows)) for i in range(bands)])


def _buckets(df: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, node) for each band of each signature."""
    return df.where("size > 0").select(F.explode(_bucket_names(bands, rows)).alias("bucket"), "node")


def _agreement(a: Column, b: Column) -> Column:
    same = F.zip_with(a, b, lambda x, y: x == y)
    return F.size(F.filter(same, lambda t: t)) / F.size(a)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that reach the threshold on whole shingle sets.

    ``sets`` is read by its buckets and not shuffled; the pairs, and the sets of
    those that occur in one, are. The sets of u, which may have very many
    partners, are written first, so that AQE can split them."""
    pairs = materialise(pairs, "near-pairs")
    ends = pairs.select(F.col("u").alias("node")).distinct().hint("merge")
    first = materialise(sets.join(ends, "node", "left_semi")
                        .select(F.col("node").alias("u"), F.col("shingles").alias("s")), "near-first-sets")
    common = F.size(F.array_intersect("s", "t"))
    union = F.size("s") + F.size("t") - common
    return (pairs.hint("merge").join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("t")), "v")
            .join(first.hint("merge"), "u")
            .where(100 * common >= percent * union).select("u", "v"))


def _stars(members: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs of each bucket's most connected node with its other members, as far
    as their signatures allow."""
    degree = members.groupBy("node").agg(F.count("*").alias("degree"))
    ranked = members.join(degree, "node")
    hub = materialise(ranked.groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("hub")), "near-hubs")
    pairs = (members.join(hub, "bucket").where("node <> hub")
             .select(F.col("hub").alias("u"), F.col("node").alias("v")).distinct())
    sig = nodes.select("node", "sig")
    return (pairs.join(sig.toDF("u", "s"), "u").join(sig.toDF("v", "t"), "v")
            .where(_agreement(F.col("s"), F.col("t")) >= least).select("u", "v"))


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of values that each set on the left shares with each on the right."""
    def flat(sets):
        of, value = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([np.zeros(0, np.int32), *sets])
        order = np.argsort(value, kind="stable")
        return of[order], value[order]
    (li, lv), (ri, rv) = flat(left), flat(right)
    out = np.zeros((len(left), len(right)), dtype=np.int32)
    both = np.intersect1d(lv, rv)
    ends = [np.searchsorted(v, both, side=s) for v in (lv, rv) for s in ("left", "right")]
    for a, b, c, d in zip(*ends, strict=True):
        out[np.ix_(li[a:b], ri[c:d])] += 1
    return out


def _similar(sample: list[np.ndarray], level: np.ndarray, left: np.ndarray, right: np.ndarray,
             percent: int) -> np.ndarray:
    """Which pairs the samples allow: those of whole sets exactly, others up to 5
    standard deviations below the threshold. A pair is compared at the rate of
    the larger set; of sets over twice the other's size none can be a pair."""
    ok = np.zeros((len(left), len(right)), dtype=bool)
    for n in np.unique(level):
        a, b = (np.flatnonzero((level[x] == n) | (level[x] == n - 1)) for x in (left, right))
        last = np.int32((1 << int(n)) - 1)
        own = [[s[s & last == 0] for s in (sample[i] for i in x)] for x in (left[a], right[b])]
        size = [np.array([len(s) for s in x]) for x in own]
        common = _common(*own)
        union = np.maximum(size[0][:, None] + size[1][None, :] - common, 1)
        p = percent / 100
        least = p - (5 * np.sqrt(p * (1 - p) / union) if n else 1e-9)
        here = (np.maximum(level[left[a]][:, None], level[right[b]][None, :]) == n) & (common >= least * union)
        ok[np.ix_(a, b)] |= here
    return ok


def _blockwise(bands: int, rows: int, least: float, percent: int):
    """Pairs of different components between two blocks of a bucket (or within
    one) that signatures, own shingles and samples allow, each in the first band
    they share."""
    def run(key, pdf):
        import pandas as pd
        band, same_block = int(pdf["band"].iloc[0]), bool((pdf["i"] == pdf["j"]).all())
        sig, sample = np.stack(pdf["sig"].to_numpy()), [np.asarray(x, np.int32) for x in pdf["sample"]]
        node, root = pdf["node"].to_numpy(), pdf["root"].to_numpy()
        size, own = pdf["size"].to_numpy(), pdf["own"].to_numpy()
        left = right = np.arange(len(pdf))
        if not same_block:
            left, right = np.flatnonzero(pdf["left"].to_numpy()), np.flatnonzero(~pdf["left"].to_numpy())
        most = np.minimum((size - own)[left][:, None], (size - own)[right][None, :])
        ok = 100 * most >= percent * (size[left][:, None] + size[right][None, :] - most)
        ok &= root[left][:, None] != root[right][None, :]
        if same_block:
            ok = np.triu(ok, 1)
        for i in np.flatnonzero(ok.any(axis=1)):
            j = np.flatnonzero(ok[i])
            equal = sig[right[j]] == sig[left[i]]
            whole = equal.reshape(len(j), bands, rows).all(axis=2)
            ok[i, j] = (equal.mean(axis=1) >= least) & whole.any(axis=1) & (whole.argmax(axis=1) == band)
        a, b = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
        if len(a):
            ok[np.ix_(a, b)] &= _similar(sample, _level(size), left[a], right[b], percent)
        x, y = node[left[np.nonzero(ok)[0]]], node[right[np.nonzero(ok)[1]]]
        return pd.DataFrame({"u": [min(p) for p in zip(x, y, strict=True)], "v": [max(p) for p in zip(x, y, strict=True)]})
    return run


def _rest(members: DataFrame, nodes: DataFrame, sets: DataFrame, roots: DataFrame, least: float,
          bands: int, rows: int, percent: int, block: int) -> DataFrame:
    """Pairs left to compare once the stars are joined: see the module's step 2."""
    known = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = [F.count("*").alias("n"), F.min("root").alias("a"), F.max("root").alias("b")]
    # a bucket of two is settled by its star
    open_ = materialise(known.groupBy("bucket").agg(*several).where("n > 2 and a <> b").select("bucket"), "near-buckets")
    left = materialise(known.join(open_, "bucket", "left_semi"), "near-open")
    names = materialise(left.select("node").distinct(), "near-rest")
    alone = (sets.join(names.hint("merge"), "node", "left_semi")
             .select(F.xxhash64("node").alias("of"), F.explode("shingles").alias("shingle"))
             .groupBy("shingle").agg(F.count("*").alias("n"), F.min("of").alias("of")).where("n = 1")
             .groupBy("of").agg(F.count("*").alias("own")))
    nodes = materialise(nodes.join(names.hint("merge"), "node", "left_semi").join(sets.select("node", "sample"), "node")
                        .withColumn("of", F.xxhash64("node"))
                        .join(alone, "of", "left").withColumn("own", F.coalesce("own", F.lit(0))).drop("of"),
                        "near-own")
    left = materialise(left.join(nodes.select("node", "size", "own"), "node"), "near-sized")
    fewest = materialise(left.groupBy("bucket").agg(F.min("own").alias("fewest")), "near-fewest")
    left = materialise(left.join(fewest, "bucket").where(
        (100 * (F.col("size") - F.col("own")) >= percent * (F.col("size") + F.col("fewest")))), "near-left")
    blocks = materialise(left.groupBy("bucket").agg(*several).where("a <> b")
                         .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "near-blocks")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (left.join(blocks, "bucket").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})
             .withColumn("left", F.col("mine") == F.col("i"))
             .join(nodes.select("node", "sig", "sample"), "node"))
    dealt = dealt.withColumn("band", F.array_position(_bucket_names(bands, rows), F.col("bucket")).cast("int") - 1)
    return (dealt.groupBy("bucket", "i", "j")
            .applyInPandas(_blockwise(bands, rows, least, percent), "u binary, v binary").distinct())


def _node_sets(own: DataFrame, signed: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """The shingle set and sample of every node, one row each, bucketed by node:
    the joins that follow read them where they lie.

    Texts are found by the node's id. An id that several rows have (null, as a
    rule) finds them all: their texts are made distinct first, map-side and then
    by text, and their sets by node."""
    several = materialise(signed.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("id").alias("twice")),
                          "near-repeated-ids")
    ids = (nodes.select(F.col("id").alias("wanted")).distinct()
           .join(several.withColumn("many", F.lit(True)), F.col("wanted").eqNullSafe(F.col("twice")), "left"))
    ids = materialise(ids.select("wanted", F.coalesce("many", F.lit(False)).alias("many")), "near-ids")
    texts = own.join(ids.hint("merge"), F.col("id").eqNullSafe(F.col("wanted")))
    kind = "node binary, shingles array<long>, sample array<int>"
    one = texts.where("not many").select("text").mapInArrow(_sets(shingle), kind).where("node is not null")
    if ids.where("many").isEmpty():
        return bucketed(one, "near_sets", "node")
    wanted = nodes.join(several, F.col("id").eqNullSafe(F.col("twice")), "left_semi").select("node")
    more = materialise(texts.where("many").select("text").distinct().mapInArrow(_sets(shingle), kind)
                       .where("node is not null").join(wanted, "node", "left_semi").dropDuplicates(["node"]),
                       "near-repeated-sets")
    return bucketed(one.unionByName(more), "near_sets", "node")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK,
                    seed: int = SEED, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id reachable by links) and kept (whether it is that document); with
    ``row``, a column of different row numbers, also row and first (true for
    exactly one row of each component: the lowest id's, null ids last, with the
    lowest number; a row without shingles is a component of its own).

    Links join documents whose sets of ``shingle``-word shingles (A-Z lower-cased)
    have 100 * common >= percent * union; fewer words make one shingle. Null or
    empty text, or white space only: no shingles, linked with nothing,
    component_id its own id. A null id is nobody's smallest: component_id null
    and kept only if no document of its component has an id. Equal ids share
    their fate if their texts do. Empty table: no rows.
    """
    least = percent / 100 - SLACK
    numbers, more = ([F.col(row).cast("long").alias("row")], ", row long") if row else ([], "")
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), *numbers)
    signed = materialise(own.mapInArrow(_sign(shingle, bands * rows, seed),
                                        f"id long, node binary, size long, sig array<int>{more}"), "near-signed")
    # written before it is joined back, here and below, so that AQE can split a bucket's rows
    # copies are one node, combined before the shuffle
    every = materialise(signed.where("size > 0").groupBy("node")
                        .agg(F.first("size").alias("size"), F.first("sig").alias("sig"), F.min("id").alias("id")),
                        "near-every")
    shared = materialise(_buckets(every, bands, rows).groupBy("bucket").agg(F.count("*").alias("n"))
                         .where("n > 1").select("bucket"), "near-shared")
    members = materialise(_buckets(every, bands, rows).join(shared.hint("merge"), "bucket", "left_semi"),
                          "near-members")
    named = materialise(members.select("node").distinct(), "near-named")
    nodes = materialise(every.join(named.hint("merge"), "node", "left_semi"), "near-nodes")
    sets = _node_sets(own, signed, nodes, shingle)
    stars = materialise(_confirm(_stars(members, nodes, least), sets, percent), "near-stars")
    roots = connected_components(stars)
    more = materialise(_confirm(_rest(members, nodes, sets, roots, least, bands, rows, percent, block),
                                sets, percent), "near-links")
    if not more.isEmpty():
        roots = connected_components(stars.union(more))
    placed = (signed.drop("sig").join(roots, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    first = [F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias("first")] if row else []
    smallest = materialise(placed.where("root is not null").groupBy("root").agg(F.min("id").alias("smallest"), *first),
                           "near-smallest")
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("smallest"))
    decided = [F.col("row"), (F.col("root").isNull() | (F.col("row") == F.col("first"))).alias("first")] if row else []
    return (placed.join(smallest, "root", "left")
            .select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"),
                    component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"), *decided))
