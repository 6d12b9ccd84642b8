"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (all of its words
if it has fewer). Of every ``WINDOW - GRAM + 1`` consecutive grams of ``GRAM``
words the smallest hash is kept as a fingerprint, on both sides, so whatever
holds a whole window has one of the window's fingerprints. Documents are joined
with the benchmark by fingerprint; each hit is extended to the windows around
it, and those that the benchmark really has (equal words, by a 128-bit digest)
count.

A fingerprint or window that many items share is joined once, not once for each
of them. Both joins are plain ones: the benchmark's side is broadcast by Spark
while its written size allows it, else both sides are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wharf.llm import wordhash
from wharf.llm.common import materialise, pack, unpack
from wharf.llm.near_dedup import _batches

WINDOW = 10
GRAM = 5


def _winnow(hashes: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the smallest of some ``width`` consecutive grams of
    one row (the last of equals); a row of fewer grams has none."""
    if width == 1:
        return np.arange(len(at))
    n = len(at) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, value = np.arange(n) + width - 1, hashes[width - 1:].copy()
    for i in range(width - 2, -1, -1):
        lower = hashes[i:i + n] < value
        value = np.where(lower, hashes[i:i + n], value)
        best = np.where(lower, np.arange(n) + i, best)
    whole = at[width - 1:] - at[:n] == width - 1            # not across rows: a row's end leaves a gap
    return np.unique(best[whole])


def _fingerprints(words: wordhash.Words, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the fingerprints that every ``span`` words have."""
    k = min(gram, span)
    h, at = wordhash.grams(words, k)
    pick = _winnow(h, at, span - k + 1)
    return h[pick], at[pick]


def _marks(spans, gram: int):
    """(row, span, gram hash, word position) of all fingerprints of (row, text)."""
    def run(it):
        for batch in _batches(it, 1):
            words = wordhash.split(batch.column(1), wordhash.LETTERS)
            rows = batch.column(0).to_numpy()
            for span in spans:
                h, at = _fingerprints(words, span, gram)
                row = np.searchsorted(words.first, at, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[row]), pa.array(np.full(len(at), span, dtype=np.int32)),
                     pa.array(h.view(np.int64)), pa.array((at - words.first[row]).astype(np.int64))],
                    ["row", "span", "hash", "at"])
    return run


def _digest(words: wordhash.Words, a: int, span: int) -> bytes:
    return hashlib.blake2b(words.text(a, a + span), digest_size=16).digest()


def _item_windows(span_of):
    """(item row, span, window digest) of all windows of (row, text)."""
    def run(it):
        for batch in _batches(it, 1):
            words = wordhash.split(batch.column(1), wordhash.LETTERS, hashed=False)
            out = []
            for row, a, b in zip(batch.column(0).to_pylist(), words.first[:-1], words.first[1:], strict=True):
                span = span_of(int(b - a))
                if span:
                    found = {_digest(words, i, span) for i in range(a, b - span + 1)}
                    out += [(row, span, d) for d in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                 pa.array([x[2] for x in out], pa.binary())], ["row", "span", "window"])
    return run


def _extend(gram: int):
    """Words of (row, text, hits) and the windows around its hits."""
    kind = pa.list_(pa.struct([("span", pa.int32()), ("at", pa.int64()), ("window", pa.binary())]))

    def run(it):
        for batch in _batches(it, 1):
            words = wordhash.split(batch.column(1), wordhash.LETTERS, hashed=False)
            out = []
            for i, hits in enumerate(batch.column(2).to_pylist()):
                a, b = int(words.first[i]), int(words.first[i + 1])
                starts = {(h["span"], s) for h in hits or ()
                          for s in range(max(0, h["at"] - h["span"] + min(gram, h["span"])), h["at"] + 1)
                          if a + s + h["span"] <= b}
                out.append([{"span": n, "at": s, "window": _digest(words, a + s, n)} for n, s in sorted(starts)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(words.first).astype(np.int64)), pa.array(out, kind)],
                ["row", "n_words", "windows"])
    return run


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                   item_text: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit (words inside any occurrence of
    a window), items (sorted ids, as strings, of the items with occurring
    windows), n_items and contaminated.

    Words are runs of letters, digits and everything beyond ASCII, A-Z
    lower-cased. Null or empty texts have no words, on either side; items without
    words occur nowhere, and items of fewer than ``window`` words as a whole.
    Items with a null id mark words but are not listed; repeated ids are listed
    once, repeated items and rows treated alike. Empty tables: nothing is hit.
    Columns named like an added one give way to it.
    """
    base = materialise(pack(docs, row=F.monotonically_increasing_id()), "decontamination")
    items = materialise(benchmark.select(F.monotonically_increasing_id().alias("row"), F.col(item).cast("string").alias("item"),
                                         F.col(item_text).alias("text")), "benchmark")
    windows = materialise(
        items.select("row", "text").mapInArrow(_item_windows(lambda n: min(n, window)),
                                               "row long, span int, window binary")
        .join(items.select("row", "item"), "row").select("span", "window", "item").distinct(), "benchmark-windows")
    # at most ``window`` different lengths
    spans = sorted(r[0] for r in windows.select("span").distinct().collect())
    if not spans:
        spans = [window]
    marks = "row long, span int, hash long, at long"
    known = materialise(items.select("row", "text").mapInArrow(_marks(spans, gram), marks)
                        .select("span", "hash").distinct(), "benchmark-marks")
    body = base.select("row", F.col(f"_row.`{text}`").alias("text"))
    hits = (body.mapInArrow(_marks(spans, gram), marks).join(known, ["span", "hash"], "left_semi")
            .groupBy("row").agg(F.collect_set(F.struct("span", "at")).alias("hits")))
    found = materialise(body.join(hits, "row", "left").select("row", "text", "hits").mapInArrow(
        _extend(gram), "row long, n_words long, windows array<struct<span:int, at:long, window:binary>>"),
        "decontamination-windows")
    each = found.select("row", F.explode("windows").alias("w")).select("row", "w.span", "w.at", "w.window")
    sure = each.join(windows.select("span", "window").distinct(), ["span", "window"], "left_semi")
    before = Window.partitionBy("row").orderBy("at", "span").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("span")
    covered = F.greatest("at", F.coalesce(F.max(end).over(before), F.lit(0)))
    n_hit = (sure.select("row", F.greatest(end - covered, F.lit(0)).alias("new"))
             .groupBy("row").agg(F.sum("new").alias("n_hit")))
    named = (sure.select("row", "span", "window").distinct().join(windows, ["span", "window"])
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    none = F.array().cast("array<string>")
    out = (base.join(found.select("row", "n_words"), "row").join(n_hit, "row", "left").join(named, "row", "left")
           .withColumn("items", F.coalesce("items", none))
           .withColumn("n_items", F.size("items").cast("long"))
           .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
           .withColumn("contaminated", F.col("n_hit") > 0))
    return unpack(out, "n_words", "n_hit", "items", "n_items", "contaminated")
