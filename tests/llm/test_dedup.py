"""Exact, line and near dedup against brute force."""
import hashlib
import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from wharf.llm import exact_dedup, line_dedup, near_dedup
from wharf.llm.components import connected_components

SCHEMA = "doc_id long, text string, n_dropped string, row int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], SCHEMA)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("steps", [(64, 8, 1 << 20), (1, 2, 4)])
def test_exact_groups(spark, steps):
    rng = random.Random(5)
    base = ["", "a", "A", "É", "é", "ab" * 200, "ab" * 200 + "c", "x" * 70_000, "x" * 69_999 + "y", "ſ", "s"]
    if steps[0] == 1:
        base = [t[:40] for t in base]
    rows = [(i, rng.choice(base)) for i in range(300)] + [(500, None), (501, "aB" * 20), (502, "Ab" * 20)]
    rows += [(None, "nobody"), (None, "nobody"), (700, "twice"), (700, "twice"), (None, "a")]
    out = exact_dedup.exact_groups(frame(spark, rows), carry=["n_dropped"], first_bytes=steps[0], growth=steps[1],
                                   most_bytes=steps[2]).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    by_sha = {sha(t): ids for t, ids in groups.items()}
    assert len(out) == len(rows)
    for r in out:
        ids = by_sha[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = Counter(r["text_sha256"] for r in out if r["kept"])
    assert kept == Counter(dict.fromkeys(by_sha, 1))
    assert all(r["keep_id"] == r["doc_id"] for r in out if r["kept"]) and out[0]["n_dropped"] == "clash"


def test_exact_groups_empty(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def plain_lines(rows, least):
    key = lambda x: lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x))
    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_common_lines(spark):
    rng = random.Random(2)
    lines = ["Cookie notice", " cookie NOTICE\t", "É", "é", "", " ", "own"] + [f"l{i}" for i in range(40)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 8)))) for i in range(60)]
    rows += [(None, None), (None, "Cookie notice"), (3, "\n\n"), (3, "own\nown\nown\nown"), (90, "z\n" * 3000)]
    for least in (10, 4):
        got = line_dedup.drop_common_lines(frame(spark, rows), min_docs=least)
        assert got.columns == ["doc_id", "text", "row", "kept_text", "n_lines", "n_dropped"]
        got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in got.collect()]
        assert Counter(got) == Counter(plain_lines(rows, least))
    assert line_dedup.drop_common_lines(frame(spark, [])).count() == 0


def shingles(t, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def roots(links, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_near(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {(i, len(sets[i]), r) for i, r in roots(links, list(sets)).items()}


def family(rng, n, words, changes):
    base = [f"w{rng.randrange(9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"c{rng.randrange(10 ** 9)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block", [256, 16])
def test_near_duplicates(spark, block):
    rng = random.Random(11)
    texts = family(rng, 150, 120, 9) + family(rng, 40, 40, 4) + family(rng, 3, 6000, 200)
    texts += ["", " \n", "one", "One ", "one two", "ONE\ttwo", "a b c", "a b c d"] + texts[:20]
    rows = list(enumerate(texts)) + [(9000, None)]
    rng.shuffle(rows)
    out = near_dedup.near_duplicates(frame(spark, rows), block=block).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out} == plain_near(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out) and len(out) == len(rows)


def test_near_duplicates_edges(spark):
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e"), (None, "a b c d e"), (None, None), (4, "p q r"), (4, "p q r"), (2, "P  q r"),
            (None, "p q r"), (8, "alone in here")]
    got = Counter((r["doc_id"], r["component_id"], r["kept"])
                  for r in near_dedup.near_duplicates(frame(spark, rows)).collect())
    assert got == Counter({(None, None, True): 3, (4, 2, False): 2, (2, 2, True): 1, (None, 2, False): 1,
                           (8, 8, True): 1})


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(5, 5), (7, None), (None, 3)]
    rng.shuffle(links)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = roots(real, {x for p in real for x in p})
    assert {n: got.get(n, n) for n in want} == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_line_dedup_of_a_text_with_very_many_lines(spark):
    many = "\n".join(f"line {i}" for i in range(60_000))
    docs = frame(spark, [(1, many), (2, "line 1\nother"), (3, "line 1\n" + many)])
    begun = time.time()
    out = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup.drop_common_lines(docs, min_docs=3).collect()}
    assert out == {1: (60_000, 1), 2: (2, 1), 3: (60_001, 2)} and time.time() - begun < 60


def test_one_row_for_each_node_of_repeated_rows_without_ids(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = [" ".join([*base[:117], f"a{i}", f"b{i}", f"c{i}"]) for i in range(6)]
    rows = [(None, t) for t in texts for _ in range(400)] + [(None, t.upper()) for t in texts for _ in range(50)]
    rows += [(7, "own words of this one"), (7, "own words of this one"), (7, texts[0]), (3, texts[1])]
    seen = []
    found = near_dedup._node_sets
    monkeypatch.setattr(near_dedup, "_node_sets", lambda *a: (seen.append(found(*a)), seen[0])[1])
    out = near_dedup.near_duplicates(frame(spark, rows).repartition(5)).collect()
    counts = seen[0].groupBy("node").count().collect()
    assert len(counts) == 6 and all(r["count"] == 1 for r in counts)
    linked = [r for r in out if r["n_shingles"] > 100]
    assert len(linked) == len(rows) - 2 and {r["component_id"] for r in linked} == {3}
    assert sorted(r["doc_id"] for r in linked if r["kept"]) == [3]
