"""Conversation repair against plain searches."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from wharf.llm import conversation_repair as cr
from wharf.llm import queries

LEGAL = re.compile(r"(s?(ua)+)?")
BEGUN = re.compile(r"(s?(ua)*u?)?")
SCHEMA = "conv_id long, turn long, role string, text string, row int, audit string"


def faults(rows):
    """(role, text, kind) of one conversation's rows in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        kind = ("blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def plain_repair(rows):
    """(cost, audit, repaired rows) by a search that keeps the best whole edit list for each whole role order."""
    best = {"": (0, "", [])}

    def put(to, roles, way):
        if BEGUN.fullmatch(roles) and (roles not in to or way[:2] < to[roles][:2]):
            to[roles] = way

    def inserted(now):
        out = dict(now)
        for _ in range(2):
            for roles, (cost, audit, done) in list(out.items()):
                for r in ("user", "assistant"):
                    put(out, roles + r[0], (cost + 2, audit + "I", done + [(r, "")]))
        return out

    for role, text, kind in faults(rows):
        after = {}
        for roles, (cost, audit, done) in inserted(best).items():
            put(after, roles, (cost + 3, audit + "D", done))
            if kind not in ("blank", "duplicate"):
                more = kind == "truncated"
                if role:
                    put(after, roles + role[0], (cost + more, audit + "K", done + [(role, text)]))
                for r in ("user", "assistant"):
                    put(after, roles + r[0], (cost + more + 2, audit + "R", done + [(r, text)]))
        best = after
    return min(w for roles, w in inserted(best).items() if LEGAL.fullmatch(roles))


def every_repair(rows):
    """The same by writing out all edit lists."""
    own = faults(rows)
    spare = [()] + [(x,) for x in "ua"] + list(itertools.product("ua", repeat=2))
    picks = [("D", "", 3)], [("K", None, 0), ("D", "", 3), ("R", "u", 2), ("R", "a", 2)]
    best = None
    for edits in itertools.product(*[picks[k not in ("blank", "duplicate")] for _, _, k in own]):
        for gaps in itertools.product(spare, repeat=len(own) + 1):
            roles, audit, cost = "", "", 0
            for gap, row, edit in itertools.zip_longest(gaps, own, edits):
                roles, audit, cost = roles + "".join(gap), audit + "I" * len(gap), cost + 2 * len(gap)
                if row:
                    roles += (row[0][:1] or "?") if edit[0] == "K" else edit[1]
                    audit, cost = audit + edit[0], cost + edit[2] + (edit[0] != "D" and row[2] == "truncated")
            if LEGAL.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


ROLES = ["system", "user", "assistant", "tool", "", "user", "assistant"]
TEXTS = ["a.", "b!", "c?", "d", "", " \n", "a. \t"]


def conversation(rng, n):
    return [(rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.4 else f"t{rng.randrange(99)}{rng.choice(['.', '.', ''])}")
            for _ in range(n)]


def test_plain_search_is_exhaustive():
    rng = random.Random(3)
    for n in (0, 1, 1, 2, 2, 2, 3, 3, 3):
        rows = conversation(rng, n)
        assert plain_repair(rows)[:2] == every_repair(rows), rows


def walk(rows, entry=cr.START):
    s = cr.Survivors(entry)
    for at, (role, _, kind) in enumerate(faults(rows)):
        s.read(at, role[:1], kind in ("blank", "duplicate"), kind == "truncated")
    return s


def test_viterbi_takes_the_cheapest_and_least():
    rng = random.Random(4)
    for n in [*range(8)] * 40 + [60]:
        rows = conversation(rng, n)
        s = walk(rows)
        x, cost, after = s.end()
        done = s.done + s.tail(x)
        assert [r for r, _ in done] == list(range(n))
        assert (cost, "".join(i for _, i in done + [(None, after)])[::2]) == plain_repair(rows)[:2], rows


@pytest.mark.parametrize("rows", [
    [("user", "a{}."), ("assistant", "b{}.")], [("user", "a{}."), ("user", "b{}."), ("assistant", "c{}.")], [("user", "")],
    [("system", "s{}."), ("user", "u{}"), ("assistant", "v{}")], [("assistant", "x{}"), ("tool", " "), ("user", "y{}")]])
def test_survivors_come_together(rows):
    s, longest = cr.Survivors(cr.START), 0
    for at, (role, _, kind) in enumerate(faults([(r, t.format(i)) for i in range(1500) for r, t in rows])):
        s.read(at, role[:1], kind in ("blank", "duplicate"), kind == "truncated")
        longest = max(longest, *[len(s.tail(x)) for x in s.best])
    assert longest <= 12 and len(s.done) > 1400 * len(rows)


def test_answers_that_stay_open_to_the_end():
    for n in (60, 61):
        s = walk([("user", f"{i}.") for i in range(n)])
        x, cost, after = s.end()
        audit = "".join(i for _, i in s.done + s.tail(x) + [(None, after)])[::2]
        assert len(s.tail(x)) > 50 and (cost, audit) == plain_repair([("user", f"{i}.") for i in range(n)])[:2]
        assert audit[:4] == ("KIKR" if n % 2 else "KRKR")


def repaired(spark, rows, chunk=cr.CHUNK):
    """conv -> (summary, edits as tuples, digest rows)."""
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA)
    edits, summary = cr.repair(df, chunk=chunk)
    by = defaultdict(list)
    for e in edits.orderBy("conv", "part", "chunk", "at", "k").collect():
        by[e["conv"]].append(e)
    return {r["conv"]: (r, by[r["conv"]]) for r in summary.collect()}


@pytest.mark.parametrize("parts,chunk", [(4, 10_000), (40, 10_000), (7, 1)])
def test_repair_across_partitions(spark, parts, chunk):
    rng = random.Random(5)
    convs = {i: conversation(rng, rng.randrange(1, 9)) for i in range(30)}
    convs[100], convs[None] = conversation(rng, 90), conversation(rng, 40)
    rows = [(i, t, *r) for i, own in convs.items() for t, r in enumerate(own)]
    rng.shuffle(rows)
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = repaired(spark, rows, chunk)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(out) == set(convs)
    for i, own in convs.items():
        cost, audit, done = plain_repair(own)
        s, edits = out[i]
        assert (s["cost"], "".join(e["edit"] for e in edits)) == (cost, audit)
        assert [(e["role"], e["text"]) for e in edits if e["edit"] != "D"] == done
        kinds = Counter(k for _, _, k in faults(own))
        assert (s["blank"], s["duplicate"], s["truncated"]) == (kinds["blank"], kinds["duplicate"], kinds["truncated"])
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(own, own[1:])]
        assert s["illegal"] == sum(p not in ("su", "ua", "au") for p in pairs)
        assert (s["n_rows"], s["gaps"]) == (len(own), 0)
        assert all(e["_row"]["audit"] == "clash" and e["_row"]["row"] == 7 for e in edits if e["edit"] != "I")
    if parts == 40:
        assert len({e["part"] for e in out[100][1]}) > 3


def test_edges(spark):
    many = "word " * 60_000
    rows = [(1, None, None, None), (1, None, "user", "a."), (1, 4, "assistant", "b."), (1, 7, "assistant", "b."),
            (2, None, "user", "x."), (2, None, "user", "x."), (3, 0, "user", many), (3, 1, "assistant", many + "."),
            (4, 5, "", "no role."), (None, 1, "user", None)]
    out = {i: (r.asDict(), "".join(e["edit"] for e in edits)) for i, (r, edits) in repaired(spark, rows).items()}
    assert out[1][0]["gaps"] == 2 and out[1][0]["blank"] == 1 and out[1][0]["duplicate"] == 1 and out[1][1] == "DKKD"
    assert out[2][0]["duplicate"] == 1 and out[2][0]["gaps"] == 0 and out[2][1] == "KDI"
    assert out[3][0]["truncated"] == 1 and out[3][1] == "KK" and out[4][1] == "D" and out[None][1] == "D"
    assert repaired(spark, []) == {}


def plain_query(rows):
    by, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by[conv] += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in own if t is not None]
        own = [r[1:] for r in own]
        kinds = Counter(k for _, _, k in faults(own))
        cost, audit, done = plain_repair(own)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds["blank"], kinds["duplicate"],
                     kinds["truncated"], sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())
    return out


def queried(spark, folder):
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = queries.op11_conversation_repair(spark, folder).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r[c] for c in cols) for r in out}


def test_op11_against_plain(spark, tmp_dir):
    rng = random.Random(6)
    rows = [(i, t, *r) for i in [*range(150), None] for t, r in enumerate(conversation(rng, rng.randrange(1, 12)))]
    rows += [(500, None, "user", "only null turns."), (501, None, None, None)]
    gone = next(i for i in itertools.count(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "dropped."))
    rng.shuffle(rows)
    spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_dir}/a/conversations.parquet")
    out = queried(spark, f"{tmp_dir}/a")
    assert out == plain_query(rows)
    assert out[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_dir}/b/conversations.parquet")
    assert queried(spark, f"{tmp_dir}/b") == {}


def test_op11_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert queried(spark, sf) == plain_query(rows)
