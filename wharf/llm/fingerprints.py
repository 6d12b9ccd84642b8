"""Document fingerprints: sketches that scale with the document.

A fingerprint holds every hash of a document's shingles (five words) that
lies below a fixed fraction of the hash range, so it grows with the document
and no slots are shared out beforehand. Two fingerprints of documents of very
different length can be compared: the hashes of the short one that the long
one has too estimate how much of it the long one contains. Fingerprints are
mergeable: the union of two is the fingerprint of both texts' shingles.

The least hash is kept even if it is above the threshold, so that short texts
have one as well; a union keeps what is below the threshold and its least hash.
A text of fewer than five words has one shingle, its whole word sequence; a
text without words, and null, has the empty fingerprint, which is like another
empty one (1.0) and unlike all others (0.0).

As text, a fingerprint is its hashes in ascending order, 16 hex digits each,
with a blank between. Words are runs of letters, digits and everything beyond
ASCII, A-Z lower-cased. Equal texts have equal fingerprints. Texts are hashed
in Arrow batches, a batch's memory is a small multiple of its bytes. Input
columns pass through; one named ``fingerprint`` gives way to the operator's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.llm.common import ROW, pack, unpack
from wharf.llm.wordhash import LETTERS, grams, mix, split

SHINGLE = 5
FRACTION = 1 / 8
_STEP = np.uint64(0x9E3779B97F4A7C15)


def limit(fraction: float) -> int:
    """The greatest hash below ``fraction`` of the range."""
    return int(fraction * 2**64) - 1


def sketches(texts: pa.Array, shingle: int = SHINGLE, fraction: float = FRACTION) -> list[np.ndarray]:
    """Ascending hashes of each text of a batch."""
    words = split(texts, LETTERS)
    hashes, at = grams(words, shingle)
    low = hashes <= np.uint64(limit(fraction))
    cut = np.searchsorted(at, words.first)                     # the grams of row i: cut[i] .. cut[i + 1]
    counts = np.diff(words.first)
    out = []
    for i, n in enumerate(counts):
        if n == 0:
            out.append(hashes[:0])
        elif n < shingle:
            h = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words.hash[words.first[i]:words.first[i + 1]]:
                    h = h * _STEP + w
            out.append(mix(np.array([h], dtype=np.uint64)))
        else:
            own = hashes[cut[i]:cut[i + 1]]
            kept = own[low[cut[i]:cut[i + 1]]]
            out.append(np.unique(kept) if len(kept) else own.min(keepdims=True))
    return out


def written(sketch: np.ndarray) -> str:
    return " ".join([f"{h:016x}" for h in sketch.tolist()])


def alike(a: np.ndarray, b: np.ndarray) -> float:
    """Shared part of all hashes of two fingerprints: an estimate of their shingle sets' resemblance."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the fingerprint of each whole text."""
    packed = pack(docs, _text=F.col(f"`{text}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([written(s) for s in sketches(b.column("_text"), shingle, fraction)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(ROW), found], names=[ROW, "fingerprint"])

    out = T.StructType([packed.schema[ROW], T.StructField("fingerprint", T.StringType())])
    return unpack(packed.mapInArrow(run, out), "fingerprint")


def hashes(fingerprint: Column) -> Column:
    """A fingerprint's hashes as an array."""
    return F.when(fingerprint == "", F.array().cast("array<string>")).otherwise(F.split(fingerprint, " "))


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two fingerprints' documents, 0 to 1; null if one is null."""
    both = F.size(F.array_intersect(hashes(a), hashes(b)))
    of = F.size(hashes(a)) + F.size(hashes(b)) - both
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(of == 0, 1.0).otherwise(both / of)


def containment(a: Column, b: Column) -> Column:
    """Estimated part of the first document's shingles that the second one has; 1 for an empty first one."""
    both, of = F.size(F.array_intersect(hashes(a), hashes(b))), F.size(hashes(a))
    return F.when(a.isNull() | b.isNull(), F.lit(None)).when(of == 0, 1.0).otherwise(both / of)


def merged(prints: DataFrame, *keys: str, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of groups of documents (all of a source, say): one row for each key and hash, in no group
    cell that could outgrow a row. Hot keys' hashes are made distinct before and after the shuffle."""
    first = prints.select(*keys, F.explode(hashes(F.col("fingerprint"))).alias("hash")).distinct()
    most = f"{limit(fraction):016x}"
    least = first.groupBy(*keys).agg(F.min("hash").alias("hash"))
    return first.where(F.col("hash") <= most).union(least.where(F.col("hash") > most))


def contained_in(prints: DataFrame, groups: DataFrame, id_col: str, *keys: str) -> DataFrame:
    """How much of each document every merged group holds that shares a hash with it (id, keys, containment).
    Hashes that many documents have meet in the join on the hash, whose large partitions Spark splits;
    the counts are added up before the second shuffle."""
    own = prints.select(id_col, F.explode(hashes(F.col("fingerprint"))).alias("hash"),
                        F.size(hashes(F.col("fingerprint"))).alias("_of")).distinct()
    return (own.join(groups, "hash").groupBy(id_col, *keys, "_of").agg(F.count(F.lit(1)).alias("_both"))
            .select(id_col, *keys, (F.col("_both") / F.col("_of")).alias("containment")))
