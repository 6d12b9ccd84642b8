"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a vector of transformed statistics (lengths, shares of kinds
of characters, entropy, repetition of words, lines and shingles). Each class is
a normal density over them, its covariance shrunk towards the pooled one and
towards a multiple of the identity. The score is the posterior of class 1 from
the difference of the two log densities, whose Mahalanobis terms use Cholesky
factors computed once.

Moments are summed where the rows are; only sums of fixed size reach the driver,
so all labelled rows are learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wharf.llm import wordhash
from wharf.llm.common import materialise
from wharf.llm.near_dedup import _batches

FOLDS = 5                             # crc32(doc_id as text) mod FOLDS = 0 is held out
THRESHOLD = 0.3
POOLED, ROUND = 0.2, 0.02             # shares of the pooled covariance and of the identity
FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "letters", "upper", "digits", "points",
    "symbols", "bars", "bangs", "spaces", "line_ends", "beyond_ascii", "entropy", "word_variety", "top_word",
    "line_variety", "line_length", "shingle_variety", "upper_words", "symbol_ends")


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_KINDS = np.stack([
    _class(b"abcdefghijklmnopqrstuvwxyz") + _UPPER + (np.arange(256) >= 128), _UPPER, _class(b"0123456789"),
    _class(b".,;:'\"()-"), _class(b"#$%&*+/<=>@[\\]^_`{}~"), _class(b"|"), _class(b"!?"), _class(b" \t"),
    _class(b"\r\n"), (np.arange(256) >= 128).astype(float)], axis=1)
_ENDS = _class(b"#$%&*+/<=>@\\^_`{|}~!") > 0
_NO_LINE_END = np.arange(256) != 10


def _variety(hashes: np.ndarray) -> tuple[float, float]:
    """Share of different values, and of the commonest one."""
    if not len(hashes):
        return 1.0, 0.0
    _, n = np.unique(hashes, return_counts=True)
    return len(n) / len(hashes), n.max() / len(hashes)


def statistics(texts) -> np.ndarray:
    """One row of FEATURES for each text of a string column; null as empty."""
    raw, offsets = wordhash.bytes_of(texts)
    words = wordhash.split(texts, wordhash.NOT_SPACE)
    lines = wordhash.split(texts, _NO_LINE_END)
    gram, at = wordhash.grams(words, 3)
    grams = np.searchsorted(at, words.first)
    length = (words.end - words.start).astype(float)
    shout = _UPPER[raw[words.start]] * _UPPER[raw[np.maximum(words.end - 1, 0)]] if len(raw) else length
    last = _ENDS[raw[words.end - 1]] if len(raw) else length
    shout = np.maximum(shout, last * _UPPER[raw[words.start]]) if len(raw) else shout
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i in range(len(out)):
        text = raw[offsets[i]:offsets[i + 1]]
        a, b = words.first[i], words.first[i + 1]
        la, lb = lines.first[i], lines.first[i + 1]
        count = np.bincount(text, minlength=256)
        n, w = max(1, len(text)), max(1, b - a)
        share = count @ _KINDS / n
        p = count[count > 0] / n
        variety, top = _variety(words.hash[a:b])
        own = length[a:b]
        out[i, :5] = (np.log1p(len(text)), np.log1p(b - a), np.log1p(own.sum() / w),
                      np.log1p(own.std()) if b > a else 0.0, 0.0)
        out[i, 4:14] = np.sqrt(share)
        out[i, 14] = -(p * np.log(p)).sum()
        out[i, 15] = np.log1p(variety * (b - a)) / np.log1p(w)
        out[i, 16] = np.sqrt(top)
        out[i, 17] = _variety(lines.hash[la:lb])[0]
        out[i, 18] = np.log1p(len(text) / max(1, lb - la))
        out[i, 19] = _variety(gram[grams[i]:grams[i + 1]])[0]
        out[i, 20] = np.sqrt(shout[a:b].sum() / w)
        out[i, 21] = np.sqrt(last[a:b].sum() / w)
    return out


@dataclass
class Quadratic:
    """Two class densities ready to score: means, inverses of the Cholesky
    factors, log determinants and log prior odds."""

    mean: np.ndarray
    scale: np.ndarray
    centre: list[np.ndarray]
    factor: list[np.ndarray]
    log_det: list[float]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        logs = []
        for c in (0, 1):
            far = (z - self.centre[c]) @ self.factor[c].T
            logs.append(-0.5 * ((far * far).sum(axis=1) + self.log_det[c]))
        return 1.0 / (1.0 + np.exp(-np.clip(logs[1] - logs[0] + self.log_odds, -500, 500)))


@dataclass
class Constant:
    """What there is to say without rows of both classes."""

    share: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def fit(n: np.ndarray, total: np.ndarray, square: np.ndarray, pooled=POOLED, round_=ROUND) -> Quadratic | Constant:
    """From each class's row count, sum of vectors and sum of outer products."""
    if n.min() < 2:
        return Constant(float(n[1] / n.sum()) if n.sum() else 0.5)
    d = total.shape[1]
    mean = total.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(square.sum(axis=0)) / n.sum() - mean ** 2, 1e-6))
    centre = [(total[c] / n[c] - mean) / scale for c in (0, 1)]
    cov = [(square[c] / n[c] - np.outer(total[c], total[c]) / n[c] ** 2) / np.outer(scale, scale) for c in (0, 1)]
    both = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    factor, log_det = [], []
    for c in (0, 1):
        shrunk = (1 - pooled) * cov[c] + pooled * both
        shrunk = (1 - round_) * shrunk + round_ * max(np.trace(shrunk) / d, 1e-3) * np.eye(d)
        low = np.linalg.cholesky(shrunk)
        factor.append(np.linalg.inv(low))
        log_det.append(float(2 * np.log(np.diag(low)).sum()))
    return Quadratic(mean, scale, centre, factor, log_det, float(np.log(n[1] / n[0])))


def _features(it):
    for batch in _batches(it, 1):
        x = statistics(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(
                pa.list_(pa.float64())), *batch.columns[2:]], ["doc_id", "x", *batch.schema.names[2:]])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(FEATURES))


def _moments(it):
    """Sums over a task's rows of each class: count, vectors, outer products."""
    d = len(FEATURES)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in it:
        x, y = _matrix(batch.column(1)), batch.column(0).to_numpy()
        for c in (0, 1):
            own = x[y == c]
            sums[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["quality", "sums"])


def held_out(key: Column, folds: int = FOLDS) -> Column:
    """Whether a row's label may not be learnt from; a null id is held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


def learn(features: DataFrame, labels: DataFrame) -> Quadratic | Constant:
    """The model from features (doc_id, x) and labels (doc_id, quality) outside
    the held-out fold. An id with several labels counts as its lowest."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    d = len(FEATURES)
    sums = (features.join(known, "doc_id").select("quality", "x")
            .mapInArrow(_moments, "quality int, sums array<double>")
            .select("quality", F.posexplode("sums").alias("at", "value"))
            .groupBy("quality", "at").agg(F.sum("value").alias("value")))
    flat = np.zeros((2, 1 + d + d * d))
    for c, at, value in sums.collect():              # 2 * (1 + d + d * d) rows
        flat[c, at] = value
    return fit(flat[:, 0], flat[:, 1:1 + d], flat[:, 1 + d:].reshape(2, d, d))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id",
             threshold: float = THRESHOLD, row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (probability of
    quality 1) and predicted (1 if score >= threshold); with ``row``, a column
    of row numbers, also row.

    Null and empty texts are scored by their statistics like any other. Repeated
    rows score alike. Labels of unknown ids, null ids and values other than 0
    and 1 count for nothing. Without two labelled rows of each class the score
    is the share of label 1 (0.5 without labels). Empty table: no rows.
    """
    numbers, more = ([F.col(row).cast("long").alias("row")], ", row long") if row else ([], "")
    features = materialise(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *numbers)
                           .mapInArrow(_features, f"doc_id long, x array<double>{more}"), "quality-features")
    model = learn(features, labels)

    def score(it):
        for batch in it:
            s = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), *batch.columns[2:]],
                                             ["doc_id", "score", *batch.schema.names[2:]])

    return (features.mapInArrow(score, f"doc_id long, score double{more}")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), *(["row"] if row else [])))
