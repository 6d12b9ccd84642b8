"""Edit-aware token counts over pre-token segment trees.

A text is cut into leaves of about ``LEAF`` characters, each ending where white
space begins. No pre-token of a byte-level BPE crosses such a place, and the
pre-tokens on either side do not depend on the other, so the token count of a
text is the sum over its leaves. The counts are kept in a segment tree.

An edit re-encodes the leaves it touches. Where it spoils a leaf's end (no white
space after other text any more) the leaf is encoded together with its
neighbour. Then only the sums above the changed leaves are updated. A leaf that
has outgrown two leaves is cut anew, each part encoded alone, and the sums are
added up again over the larger number of leaves.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wharf.llm.near_dedup import _batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's own pre-token pattern.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 512
CUTS = frozenset(" \n")
#: White space as the pattern's \s has it (fixed values).
WHITE = frozenset("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
                  "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The vocabulary file (under 1 MB), read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


_encoders: dict[int, Callable[[str], int]] = {}


def counter(vocabulary: bytes) -> Callable[[str], int]:
    """Tokens of a text; built once per Python worker."""
    if (known := _encoders.get(hash(vocabulary))) is None:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        known = _encoders[hash(vocabulary)] = lambda text: len(encoding.encode_ordinary(text))
    return known


class Leaves:
    """Leaf texts of a document and the segment tree of their token counts:
    tree[n + i] is leaf i's count, tree[i] the sum of its two children."""

    def __init__(self, leaves: list[str], tree: list[int]):
        self.leaves, self.tree = leaves, tree

    @classmethod
    def build(cls, text: str, count: Callable[[str], int], leaf: int = LEAF) -> Leaves:
        leaves = cut(text, leaf)
        return cls(leaves, _sums([count(x) for x in leaves]))

    @property
    def total(self) -> int:
        return self.tree[1] if len(self.tree) > 1 else 0

    def _set(self, i: int, value: int) -> None:
        i += len(self.leaves)
        by = value - self.tree[i]
        while by and i:
            self.tree[i] += by
            i //= 2

    def edit(self, edits: Sequence[tuple[int, int, str]], count: Callable[[str], int], leaf: int = LEAF) -> int:
        """Apply edits (start, end, text) of the present text, ascending and not
        overlapping; returns how many texts were encoded for it."""
        if not self.leaves and edits:
            new = Leaves.build("".join(x for _, _, x in edits), count, leaf)
            self.leaves, self.tree = new.leaves, new.tree
            return len(new.leaves)
        starts = [0, *accumulate(len(x) for x in self.leaves)][:-1]
        touched: set[int] = set()
        for a, b, new in reversed(edits):              # from the end: what lies before stays in place
            i = max(0, bisect_right(starts, a) - 1)
            j = max(i, bisect_left(starts, b) - 1)
            head, tail = self.leaves[i][:a - starts[i]], self.leaves[j][b - starts[j]:]
            self.leaves[i:j + 1] = [head + new + (tail if i == j else ""), *[""] * (j - i - 1),
                                    *[tail] * (j > i)]
            touched.update(range(i, j + 1))
        encoded = done = 0
        grown: dict[int, list[str]] = {}
        for i in sorted(touched):
            if i < done:
                continue
            a, b = i, i + 1
            while a > done and not self._sound(a):
                a -= 1
            while b < len(self.leaves) and (b in touched or not self._sound(b)):
                b += 1
            encoded += self._encode(a, b, count, leaf, grown)
            done = b
        return encoded + self._grow(grown, count)

    def _grow(self, grown: dict[int, list[str]], count: Callable[[str], int]) -> int:
        """Put the parts of grown leaves in their place; returns how many."""
        if not grown:
            return 0
        n, leaves, counts = len(self.leaves), [], []
        for i, text in enumerate(self.leaves):
            parts = grown.get(i, [text] if text else [])
            leaves += parts
            counts += map(count, parts) if i in grown else self.tree[n + i:n + i + len(parts)]
        self.leaves, self.tree = leaves, _sums(counts)
        return sum(map(len, grown.values()))

    def _sound(self, i: int) -> bool:
        """Whether leaf i begins with white space after other text: then it
        counts alone."""
        here, k = self.leaves[i], i - 1
        while k >= 0 and not self.leaves[k]:
            k -= 1
        return bool(here) and here[0] in CUTS and (k < 0 or self.leaves[k][-1] not in WHITE)

    def _encode(self, a: int, b: int, count: Callable[[str], int], leaf: int, grown: dict[int, list[str]]) -> int:
        """Encode leaves a to b - 1 anew, those with unsound ends together; parts
        of those that have outgrown two leaves are left to ``_grow``."""
        first, encoded = a, 0
        for i in range(a + 1, b + 1):
            if i == b or self._sound(i):
                text = "".join(self.leaves[first:i])
                self.leaves[first:i] = [text] + [""] * (i - first - 1)
                parts = cut(text, leaf) if len(text) > 2 * leaf else [text]
                if len(parts) > 1:
                    grown[first] = parts
                for j, value in enumerate([count(text) if len(parts) == 1 else 0, *[0] * (i - first - 1)], first):
                    self._set(j, value)
                first, encoded = i, encoded + (len(parts) == 1)
        return encoded


def _sums(counts: list[int]) -> list[int]:
    """The tree over the leaves' counts."""
    n = len(counts)
    tree = [0] * n + counts
    for i in range(n - 1, 0, -1):
        tree[i] = tree[2 * i] + tree[2 * i + 1]
    return tree


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """Leaves: cut where white space begins, once a leaf has ``leaf`` characters."""
    out, start, n = [], 0, len(text)
    while start < n:
        at = start + leaf
        while at < n and not (text[at] in CUTS and text[at - 1] not in WHITE):
            at += 1
        out.append(text[start:min(at, n)])
        start = min(at, n)
    return out


def _ints(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def build_trees(docs: DataFrame, text: str = "text", key: str = "doc_id", vocabulary: str = VOCABULARY,
                leaf: int = LEAF) -> DataFrame:
    """State to keep: doc_id, text, ends (of the leaves, in characters), tree and
    n_tokens of every row. Null and empty texts have no leaves and no tokens."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(it):
        count = counter(ranks.value)
        for batch in _batches(it, 1):
            built = [Leaves.build(t or "", count, leaf) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _ints([[*accumulate(map(len, x.leaves))] for x in built]),
                 _ints([x.tree for x in built]), pa.array([x.total for x in built], pa.int64())],
                ["doc_id", "text", "ends", "tree", "n_tokens"])

    return (docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, "doc_id long, text string, ends array<int>, tree array<int>, n_tokens long"))


def _load(text: str | None, ends: list[int], tree: list[int]) -> Leaves:
    return Leaves([(text or "")[a:b] for a, b in zip([0, *ends], ends, strict=False)], list(tree))


def apply_edits(trees: DataFrame, vocabulary: str = VOCABULARY, edits: str | None = "edits",
                pattern: str | None = None, replacement: str = "", leaf: int = LEAF) -> DataFrame:
    """State after the edits, as ``build_trees`` returns it, with n_tokens_before,
    n_edits, n_leaves and n_encoded (texts encoded for the edits).

    Edits are the column ``edits`` (array of start, end, text in characters of
    the text, in any order, not overlapping; null: none), or, with ``pattern``,
    the replacement of each of its matches.
    """
    ranks = trees.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    wanted = re.compile(pattern) if pattern is not None else None
    rows = trees.select("doc_id", "text", "ends", "tree", *([edits] if wanted is None else []))

    def run(it):
        count = counter(ranks.value)
        for batch in _batches(it, 1):
            texts = batch.column(1).to_pylist()
            if wanted is not None:
                todo = [[(m.start(), m.end(), replacement) for m in wanted.finditer(t or "")] for t in texts]
            else:
                todo = [sorted((e["start"], e["end"], e["text"] or "") for e in x or ())
                        for x in batch.column(4).to_pylist()]
            out = []
            for text, ends, tree, own in zip(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                                             todo, strict=True):
                doc = _load(text, ends, tree)
                before = doc.total
                encoded = doc.edit(own, count, leaf)
                out.append((text if text is None and not own else "".join(doc.leaves),
                            [*accumulate(map(len, doc.leaves))], doc.tree, doc.total, before, len(own),
                            len(doc.leaves), encoded))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.string()), _ints(cols[1]), _ints(cols[2]),
                 *[pa.array(c, pa.int64()) for c in cols[3:]]],
                ["doc_id", "text", "ends", "tree", "n_tokens", "n_tokens_before", "n_edits", "n_leaves", "n_encoded"])

    return rows.mapInArrow(run, "doc_id long, text string, ends array<int>, tree array<int>, n_tokens long, "
                                "n_tokens_before long, n_edits long, n_leaves long, n_encoded long")


def with_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """State with the edits of a table (doc_id, start, end, text) beside each text."""
    own = edits.groupBy("doc_id").agg(F.collect_list(F.struct(
        F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), F.col("text"))).alias("edits"))
    return trees.join(own, "doc_id", "left")
