"""Fingerprints and the Merkle manifest against brute force."""
import hashlib
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wharf.llm import fingerprints, manifest, queries, successors

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, tree int"


def write_docs(spark, folder, rows):
    """documents.parquet of (doc_id, text, lang, source, n_chars) rows, with clashing columns besides."""
    spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3).write.parquet(
        f"{folder}/documents.parquet")
    return folder


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def shingles(t):
    w = WORD.findall(lower(t))
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def vocabulary(seed, n, words=60):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(words))) for _ in range(n)]


ODD = ["", None, "one", "ONE", "one two", "é " * 9, "word " * 3000, "x" * 50_000, "\n\t .", "a b c d e", "A b, c d. e"]


def test_sketch_is_a_function_of_the_shingles():
    texts = [t or "" for t in ODD] + vocabulary(1, 80)
    found = [s.tolist() for s in fingerprints.sketches(pa.array(texts), fraction=1.0)]
    assert [len(s) for s in found] == [len(shingles(t)) for t in texts]
    known = {}
    for t, s in zip(texts, found, strict=True):            # one hash for each shingle, wherever it stands
        if len(shingles(t)) == 1:
            assert known.setdefault(next(iter(shingles(t))), s[0]) == s[0]
    some = fingerprints.sketches(pa.array(texts))
    for a, b in zip(found, some, strict=True):
        below = [h for h in a if h < 2**61]
        assert b.tolist() == (below or a[:1])
    assert found[texts.index("a b c d e")] == found[texts.index("A b, c d. e")]


def test_estimates_follow_the_sets(spark):
    base = vocabulary(2, 1, 8000)[0].split()
    while len(base) < 4000:
        base += vocabulary(len(base), 1, 8000)[0].split()
    long, short = " ".join(base[:4000]), " ".join(base[1000:1800])
    docs = spark.createDataFrame([(1, long), (2, short), (3, " ".join(base[:2000])), (4, None), (5, "")], "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    one = spark.createDataFrame([(prints[1], prints[2], prints[3], prints[4], prints[5])], "a string, b string, c string, d string, e string")
    r = one.select(fingerprints.containment(F.col("b"), F.col("a")).alias("in"), fingerprints.likeness(F.col("a"), F.col("c")).alias("half"),
                   fingerprints.containment(F.col("a"), F.col("b")).alias("few"), fingerprints.likeness(F.col("d"), F.col("e")).alias("none"),
                   fingerprints.likeness(F.col("a"), F.col("e")).alias("zero"), fingerprints.containment(F.col("e"), F.col("a")).alias("all"),
                   fingerprints.likeness(F.col("a"), F.lit(None).cast("string")).alias("null")).first()
    assert r["in"] == 1.0 and abs(r["few"] - 0.2) < 0.06 and abs(r["half"] - 0.5) < 0.08
    assert (r["none"], r["zero"], r["all"], r["null"]) == (1.0, 0.0, 1.0, None)


def test_merged_fingerprint_is_that_of_all_shingles(spark):
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 3}") for i, t in enumerate(vocabulary(3, 60) + ["tiny", ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    prints = fingerprints.fingerprints(docs)
    groups = {}
    for r in fingerprints.merged(prints, "source").collect():
        groups.setdefault(r["source"], set()).add(int(r["hash"], 16))
    for source in {s for _, _, s in rows}:
        every = {int(h) for _, t, s in rows if s == source for h in fingerprints.sketches(pa.array([t]), fraction=1.0)[0]}
        assert groups[source] == ({h for h in every if h < 2**61} or {min(every)})
    inside = fingerprints.contained_in(prints, fingerprints.merged(prints, "source"), "doc_id", "source").collect()
    own = {(r["doc_id"], r["source"]): r["containment"] for r in inside}
    assert all(own.get((i, s), 1.0) == 1.0 for i, t, s in rows if len(shingles(t)) > 5 and any(
        h < 2**61 for h in fingerprints.sketches(pa.array([t]))[0]))


def plain_edits(rows):
    """(doc_id, n_chars, text, edited, next) in id order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, r in enumerate(order):
        t, after = r[1] or "", order[(k + 1) % len(order)][1] or ""
        out.append((r[0], len(t), t, t[:len(t) - len(t) // 2] + after[:len(t) // 2], after))
    return out


def sketch_text(t):
    return fingerprints.written(fingerprints.sketches(pa.array([t]))[0])


@pytest.mark.parametrize("block", [1, 3, 2000])
def test_op12_against_plain(spark, tmp_dir, monkeypatch, block):
    monkeypatch.setattr(successors, "BLOCK_ROWS", block)
    rows = [(i * 3 - 7, t, "en", "s", 0) for i, t in enumerate([t for t in ODD] + vocabulary(4, 40))]
    rows.append((None, "nobody's text of some words here", None, None, None))
    random.Random(1).shuffle(rows)
    out = {r["doc_id"]: r for r in queries.op12_fingerprints(spark, write_docs(spark, tmp_dir, rows)).collect()}
    assert len(out) == len(rows)
    for i, n, t, edited, after in plain_edits(rows):
        r = out[i]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (sketch_text(t), sketch_text(edited))
        sets = [set(sketch_text(x).split()) for x in (t, edited, after)]
        for got, other in ((r["near_edited"], sets[1]), (r["near_next"], sets[2])):
            every = sets[0] | other
            assert got == (len(sets[0] & other) / len(every) if every else 1.0)


def test_op12_with_repeats_alone_and_empty(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(successors, "BLOCK_ROWS", 2)
    rows = [(5, "same text", "en", "s", 0)] * 9 + [(None, None, None, None, None)] * 4 + [(6, "last", "en", "s", 0)]
    out = queries.op12_fingerprints(spark, write_docs(spark, f"{tmp_dir}/a", rows)).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    assert sorted(r["near_next"] for r in out if r["doc_id"] == 5) == [0.0] + [1.0] * 8
    out = queries.op12_fingerprints(spark, write_docs(spark, f"{tmp_dir}/b", [(1, "own words only", "en", "s", 3)])).collect()
    assert [(r["near_next"], r["n_chars"]) for r in out] == [(1.0, 14)]
    assert queries.op12_fingerprints(spark, write_docs(spark, f"{tmp_dir}/c", [])).count() == 0


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return levels


def plain_manifest(rows):
    """doc_id -> (leaf, subroot, root, proof, folded root) for distinct ids."""
    def leaf(r, n_chars):
        fields = [r[0], r[3], r[2], n_chars, r[1]]
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])

    langs = sorted({r[2] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in langs:
        own = sorted((r for r in rows if r[2] == s), key=lambda r: (r[0] is not None, r[0] or 0))
        trees[s] = own, plain_tree([leaf(r, r[4]) for r in own])
    top = plain_tree([trees[s][1][-1][0] for s in langs])

    def way(levels, i):
        out = []
        for now in levels[:-1]:
            out.append((now[i ^ 1] if i ^ 1 < len(now) else "", i & 1))
            i >>= 1
        return out

    out = {}
    for k, s in enumerate(langs):
        own, levels = trees[s]
        for i, r in enumerate(own):
            steps = way(levels, i) + way(top, k)
            hit = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            back = leaf(r, r[4] + 1) if hit else levels[0][i]
            for beside, left in steps:
                back = h(beside, back) if left else h(back, beside)
            out[r[0]] = (levels[0][i], levels[-1][0], top[-1][0], h(*[b for b, _ in steps]), back)
    return out


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_op13_against_plain(spark, tmp_dir, monkeypatch, bits):
    monkeypatch.setattr(manifest, "BITS", bits)
    sizes = {"en": 37, "de": 16, None: 5, "": 1, "é": 2, "zz": 1, "fr": 64}
    rows = [(n * 1000 + i * 3 - 4, f"text é {i}" if i % 5 else None, s, None if i % 4 == 0 else "web", None if i % 6 == 1 else i)
            for n, (s, c) in enumerate(sizes.items()) for i in range(c)]
    rows.append((None, "no id", "de", "web", 5))
    out = {r["doc_id"]: r for r in queries.op13_manifest(spark, write_docs(spark, tmp_dir, rows)).collect()}
    want = plain_manifest(rows)
    assert len(out) == len(rows) and {i: (r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"])
                                      for i, r in out.items()} == want
    assert all(r["verified"] == (want[i][4] == want[i][2]) for i, r in out.items())
    assert {r["verified"] for r in out.values()} == {True, False}


def test_manifest_of_repeats_one_leaf_and_none(spark, tmp_dir):
    rows = [(3, "a", "en", "s", 1)] * 700 + [(4, "b", "en", "s", 1)]
    out = queries.op13_manifest(spark, write_docs(spark, f"{tmp_dir}/a", rows)).collect()
    assert len(out) == 701 and all(r["verified"] and r["folded_root"] == r["root"] for r in out)
    out = queries.op13_manifest(spark, write_docs(spark, f"{tmp_dir}/b", rows[-1:])).collect()
    assert [(r["leaf"] == r["subroot"] == r["root"], r["proof_sha256"]) for r in out] == [(True, h(""))]
    assert queries.op13_manifest(spark, write_docs(spark, f"{tmp_dir}/c", [])).count() == 0


def test_octopus_asks_for_no_more_than_needed(spark):
    rng = random.Random(7)
    for n in (1, 2, 3, 37, 64, 1000):
        for known in ([0], [n - 1], list(range(n)), sorted(rng.sample(range(n), (n + 2) // 3))):
            asked = list(manifest.missing(known, n))
            levels = plain_tree([str(i) for i in range(n)])
            _, root = manifest._climb({i: str(i) for i in known}, n, {at: levels[at[0]][at[1]] for at in asked})
            assert root == levels[-1][0] and len(set(asked)) == len(asked)
            single = {at for i in known for at in manifest.missing([i], n)}
            assert set(asked) <= single and len(asked) <= len(single)
    assert list(manifest.missing(range(1000), 1000)) == []


def test_proofs_of_some_leaves(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("lang"))
    leaves = manifest.leaves(docs, "lang", "doc_id", manifest.leaf_hash(F.col("doc_id")), {"tree": F.col("doc_id")})
    nodes = manifest.build(leaves)
    some = manifest.prove(leaves.where("index % 97 = 5"), nodes)
    rows = some.select("_row.tree", manifest.folded(F.col("leaf"), F.col("proof")).alias("back"), "root", "leaf").collect()
    assert [r["tree"] for r in sorted(rows)] == list(range(5, 3000, 97))
    assert all(r["back"] == r["root"] for r in rows) and manifest.root(nodes).collect()[0]["hash"] == rows[0]["root"]
    assert all(r["leaf"] == h(f"{len(str(r['tree']))}:{r['tree']}") for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    out = queries.op12_fingerprints(spark, SF).join(docs, "doc_id").collect()
    by_text = {}
    for r in out:
        assert by_text.setdefault(r["text"], r["fingerprint"]) == r["fingerprint"]
    assert len(out) == docs.count() and np.mean([r["near_edited"] for r in out]) > np.mean([r["near_next"] for r in out])
