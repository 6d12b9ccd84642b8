"""Decontamination, quality, token counts and licences against plain rewrites."""
import os
import random
import re
import textwrap
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wharf.llm import decontamination, licences, quality, token_counts, wordhash

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_hit string, row int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_words_and_grams():
    texts = ["One  two\tthree", None, "", "É-x\x0bÜ " * 3, "a" * 3_000_000 + " b", " \n", "end"]
    for inside, pattern in ((wordhash.NOT_SPACE, r"[^\x20\x09-\x0D]+"),
                            (wordhash.LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = wordhash.split(pa.array(texts), inside)
        for i, t in enumerate(texts):
            want = re.findall(pattern, lower(t))
            a, b = w.first[i], w.first[i + 1]
            assert [w.text(j, j + 1).decode() for j in range(a, b)] == want
        names = [w.text(j, j + 1) for j in range(len(w.start))]
        assert len(set(names)) == len(set(w.hash.tolist()))
        assert len({(x, y) for x, y in zip(names, w.hash.tolist(), strict=True)}) == len(set(names))
    sliced = wordhash.split(pa.array(texts).slice(3, 1), wordhash.NOT_SPACE)
    assert len(sliced.start) == len(texts[3].split())
    g, at = wordhash.grams(wordhash.split(pa.array(["a b c", "a b", None, "a b c d"]), wordhash.NOT_SPACE), 3)
    assert at.tolist() == [0, 5, 6] and g[0] == g[1] != g[2]


def plain_marks(rows, bench, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    known = {}
    for i, t in bench:
        w = words(t)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[a:a + n]), set()).add(None if i is None else str(i))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in known}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in known:
                    hit.update(range(a, a + n))
                    found |= known[tuple(w[a:a + n])]
        out.append((i, len(w), len(hit), sorted(found - {None})))
    return out


def test_benchmark_marks(spark):
    rng = random.Random(8)
    word = lambda: rng.choice("ab é3 Cd ef_g the of x".split())
    bench = [(i, " ".join(word() for _ in range(rng.randint(8, 30)))) for i in range(30)]
    bench += [(100, None), (101, ""), (102, "Only three words"), (103, "single"), (None, bench[0][1]), (104, bench[0][1]),
              (104, bench[0][1]), (105, "same " * 14)]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 80)))) for i in range(120)]
    for i in range(40):
        t = rng.choice([b for _, b in bench if b]).split() or ["x"]
        a = rng.randrange(len(t))
        rows.append((200 + i, "p q, " + "--".join(t[a:a + rng.randint(5, 25)]) + " r s"))
    rows += [(None, None), (None, bench[3][1]), (7, ""), (7, bench[3][1]), (8, "q " * 4000 + bench[4][1]),
             (9, "same " * 13), (10, "Single")]
    got = decontamination.mark_benchmark(frame(spark, rows), items(spark, bench))
    assert got.columns == ["doc_id", "text", "row", "n_words", "n_hit", "items", "n_items", "contaminated"]
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    have = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()), key=key)
    assert have == sorted(plain_marks(rows, bench), key=key)


def test_benchmark_edges(spark):
    assert decontamination.mark_benchmark(frame(spark, []), items(spark, [(1, "a b")])).count() == 0
    out = decontamination.mark_benchmark(frame(spark, [(1, "a b")]), items(spark, [(1, None)])).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in out] == [(2, 0, False)]


def test_discriminant_is_the_log_density_difference():
    rng = np.random.default_rng(1)
    x0, x1 = rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (600, 3))
    moments = lambda x: (len(x), x.sum(0), x.T @ x)
    n, total, square = map(np.array, zip(moments(x0), moments(x1)))
    model = quality.fit(n, total, square, pooled=0.3, round_=0.1)
    x = rng.normal(0.5, 2, (50, 3))
    z = lambda v: (v - model.mean) / model.scale
    covs = [np.cov(z(v).T, bias=True) for v in (x0, x1)]
    both = (400 * covs[0] + 600 * covs[1]) / 1000
    logs = []
    for v, cov, share in ((x0, covs[0], .4), (x1, covs[1], .6)):
        s = 0.7 * cov + 0.3 * both
        s = 0.9 * s + 0.1 * np.trace(s) / 3 * np.eye(3)
        d = z(x) - z(v).mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.log(np.linalg.det(s))
                    + np.log(share))
    assert np.allclose(model.score(x), 1 / (1 + np.exp(logs[0] - logs[1])))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classify(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.95 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.93
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out.collect())


def test_quality_edges(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 0), (3, 7, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = [(None, None), (1, ""), (1, ""), (2, "x" * 200_000), (3, "\n\n"), (4, "Ünï")]
    out = quality.classify(frame(spark, rows), labels).collect()
    assert len(out) == 6 and all(0 <= r["score"] <= 1 for r in out)
    assert quality.classify(frame(spark, []), labels).count() == 0
    assert quality.classify(frame(spark, rows), labels.where("false")).select("score").distinct().head()[0] == 0.5


@pytest.fixture(scope="module")
def count():
    if not os.path.exists(token_counts.VOCABULARY):
        pytest.skip("vocabulary not present")
    return token_counts.counter(token_counts.read_vocabulary())


def test_edited_trees_count_like_the_text(count):
    rng = random.Random(6)
    alphabet = ["a", "the", " ", "  ", "\n", "\n\n", "'s", "é", "12", "!?", " x", "\t", " ", "日本", "\x1c"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))
        doc = token_counts.Leaves.build(text, count, leaf=rng.choice([1, 4, 20]))
        assert "".join(doc.leaves) == text and doc.total == count(text)
        for _ in range(3):
            spots = sorted(rng.sample(range(len(text) + 1), min(len(text) + 1, 2 * rng.randint(0, 4)) // 2 * 2))
            edits = [(a, b if rng.random() < .7 else a, rng.choice(["", *alphabet])) for a, b in zip(spots[::2], spots[1::2])]
            doc.edit(edits, count)
            for a, b, new in reversed(edits):
                text = text[:a] + new + text[b:]
            assert "".join(doc.leaves) == text and doc.total == count(text) == sum(doc.tree[len(doc.leaves):])


def test_edits_of_a_table(spark, count):
    rows = [(1, "The 1234567 and the rest of it"), (2, ""), (3, None), (4, "mail a.b@c.de now " * 2000), (4, "x")]
    trees = token_counts.build_trees(frame(spark, rows))
    edits = spark.createDataFrame([(1, 4, 11, "<x>"), (2, 0, 0, "new text"), (1, 0, 0, "So "), (9, 0, 1, "")],
                                  "doc_id long, start int, end int, text string")
    out = token_counts.apply_edits(token_counts.with_edits(trees, edits)).collect()
    texts = {(r["doc_id"], r["text"]): r for r in out}
    assert len(out) == 5 and (1, "So The <x> and the rest of it") in texts and (2, "new text") in texts
    assert all(r["n_tokens"] == count(r["text"] or "") for r in out)
    out = token_counts.apply_edits(trees, pattern=r"\d+|a\.b", replacement="").collect()
    assert all(r["n_tokens"] == count(r["text"] or "") for r in out)
    assert max(r["n_encoded"] for r in out) <= max(r["n_leaves"] for r in out)
    assert token_counts.build_trees(frame(spark, [])).count() == 0


def test_licence_units(spark):
    isc = dict(licences.KNOWN)["ISC"]
    rows = [(1, "Copyright (c) 2020 Someone\nCopyright 2021 by X\n\n" + isc.upper().replace("\n", "\n\n")),
            (2, "Prose here.\n\n" + "Licenced under the Apache Licence -- version 2.0!"), (3, None), (4, ""), (None, " \n "),
            (5, "released under the\nmit license"), (6, "released under the MIT license and more"),
            (7, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (7, "x")]
    out = {(r["doc_id"], r["n_units"]): r for r in licences.scan(frame(spark, rows)).collect()}
    assert len(out) == len(rows)
    by = {k[0]: r for k, r in out.items() if k != (7, 3)}
    assert by[1]["whole"] == "ISC" and by[1]["licences"] == ["ISC"]
    assert by[2]["whole"] is None and by[2]["licences"] == ["Apache-2.0"] and by[2]["n_matches"] == 2
    assert by[5]["whole"] == "MIT" and by[6]["licences"] == [] and by[3]["n_units"] == by[4]["n_units"] == 0
    assert out[(7, 4)]["licences"] == ["CC-BY-NC-4.0", "MIT"]
    assert licences.scan(frame(spark, [])).count() == 0


def test_every_known_text_matches_itself(spark):
    known = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(licences.KNOWN)], "doc_id long, text string")
    out = licences.scan(known).select(F.col("doc_id"), "whole").collect()
    assert {r["doc_id"]: r["whole"] for r in out} == {i: n for i, (n, _) in enumerate(licences.KNOWN)}


PUBLISHED = "/usr/share/common-licenses"              # where the system keeps texts of licences


def rewrapped(text, width):
    """Each paragraph on lines of another width; those with a copyright line, which counts as a line, stay."""
    parts = re.split(r"\n\s*\n", text)
    return "\n\n".join(p if re.search("(?im)^\\s*copyright", p) else textwrap.fill(" ".join(p.split()), width) for p in parts)


def test_licences_alone_rewrapped_and_inside_other_text(spark):
    texts = list(licences.KNOWN)
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if os.path.isdir(PUBLISHED):
        for name, file in files.items():
            with open(f"{PUBLISHED}/{file}", encoding="utf-8") as f:
                texts.append((name, f.read()))
    rows, want = [], {}
    for name, text in texts:
        for form in (text, rewrapped(text, 61), re.sub(r"\bLICENSE\b", "LICENCE", text.upper())):
            for whole in (True, False):
                i = len(rows)
                body = form if whole else f"Our own words come first.\n\nSome more.\n\n{form}\n\nAnd then others."
                rows.append((i, body))
                want[i] = (name if whole else None, [name])
    got = {r["doc_id"]: (r["whole"], r["licences"]) for r in licences.scan(frame(spark, rows)).collect()}
    assert {i: w for i, (w, _) in got.items()} == {i: w for i, (w, _) in want.items()}
    assert all(set(want[i][1]) <= set(found) for i, (_, found) in got.items())
    cut = [(1, licences._MIT.rsplit("\n\n", 1)[0]), (2, licences._MIT.replace("free of charge", "for a fee")), (3, "x\n\n" * 2000)]
    assert all(r["licences"] == [] for r in licences.scan(frame(spark, cut)).collect())


def test_leaves_that_grow_are_cut_again():
    spent = []

    def count(text):
        spent.append(len(text))
        return len(re.findall(r"\S+", text))

    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(1000)}" for _ in range(1000))
    doc = token_counts.Leaves.build(text, count)
    small = len(doc.leaves)
    new = " ".join(f"n{rng.randrange(10**6)}" for _ in range(25_000))
    for a, b, more in [(2000, 2003, f" {new} "), (90_000, 90_001, "x"), (0, 0, "a" * 3000 + " " + "b" * 3000), (5, 180_000, ""),
                       (7, 7, " y" * 700)]:
        spent.clear()
        doc.edit([(a, b, more)], count)
        used = sum(spent)
        text = text[:a] + more + text[b:]
        assert "".join(doc.leaves) == text and doc.total == len(re.findall(r"\S+", text))
        assert used <= len(more) + 8 * token_counts.LEAF + 3000 * (a < 8)
        assert all(len(x) < 2 * token_counts.LEAF + 20 or " " not in x[1:] for x in doc.leaves)
        if b == 2003:
            assert len(doc.leaves) > small + 100
        if more == "x":
            assert used < 4 * token_counts.LEAF
