"""Tool-call linking: order, validation, canonical text, edge cases."""
import json
import random
from collections import defaultdict

from wharf.llm import common, tool_calls

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)},
         "add": {"a": ("number", True), "more": ("array", False), "o": ("object", False), "f": ("boolean", False)}}
CALLS = "conv_id long, turn long, call_id string, tool string, arguments string, depends_on array<string>, status string"


def run(spark, calls, results):
    calls = spark.createDataFrame([(*c, "clash") for c in calls], CALLS)
    return tool_calls.link(calls, spark.createDataFrame([(*r, 1) for r in results], "call_id string, content string, message int"),
                           TOOLS).collect()


def test_arguments_and_canonical_text(spark):
    cases = [('{"query": "x\\n\\"é\\"", "limit": 3}', "search", []),
             ('{"limit": "3"}', "search", ["query: missing", "limit: not integer"]),
             ('{"query": "q", "z": 1, "b": {"d": [1, {"y": 2, "x": null}], "c": true}}', "search",
              ["b: unknown", "z: unknown"]),
             ('{"a": 1.5, "more": [], "o": {}, "f": false}', "add", []), ('{"a": "1", "f": 0}', "add",
                                                                         ["a: not number", "f: not boolean"]),
             ("[1]", "add", ["not an object"]), ("{", "add", ["not JSON"]), (None, "add", ["not JSON"]),
             ("{}", "nope", ["unknown tool"]), ("{}", None, ["unknown tool"])]
    calls = [(1, i, f"c{i}", tool, args, None) for i, (args, tool, _) in enumerate(cases)]
    out = {r["call_id"]: r for r in run(spark, calls, [("c0", 'say "é"\t'), ("c1", None)])}
    for i, (args, tool, wrong) in enumerate(cases):
        r = out[f"c{i}"]
        assert r["problems"] == wrong
        try:
            value = json.loads(args)
        except (TypeError, ValueError):
            value = None
        want = {"arguments": value, "id": f"c{i}", "name": tool, "result": 'say "é"\t' if i == 0 else None}
        assert r["message"] == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert r["status"] == ("linked" if i < 2 else "unanswered")


def test_order_follows_dependencies(spark):
    rng = random.Random(9)
    calls, deps = [], {}
    for conv in range(6):
        n = [1, 3, 40, 12, 700, 5][conv]
        order = list(range(n))
        rng.shuffle(order)
        for place, i in enumerate(order):
            own = [f"{conv}-{j}" for j in rng.sample(order[:place], min(place, rng.randint(0, 2))) if conv != 4]
            deps[f"{conv}-{i}"] = own
            calls.append((conv, i, f"{conv}-{i}", "add", '{"a":1}', own + ["unknown", None]))
    calls += [(5, 10, "x", "add", "{}", ["y"]), (5, 11, "y", "add", "{}", ["x"]), (5, 12, "z", "add", "{}", ["y"]),
              (5, 13, "self", "add", "{}", ["self"])]
    rng.shuffle(calls)
    out = {r["call_id"]: r for r in run(spark, calls, [])}
    assert len(out) == len(calls)
    for c, own in deps.items():
        assert all(out[d]["place"] < out[c]["place"] and out[d]["level"] < out[c]["level"] for d in own)
        assert out[c]["level"] == max((out[d]["level"] + 1 for d in own), default=0)
    places = defaultdict(list)
    for r in out.values():
        if r["status"] != "cycle":
            places[r["conv_id"]].append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert {c for c, r in out.items() if r["status"] == "cycle"} == {"x", "y", "z", "self"}


def test_long_chains_in_few_rounds(spark):
    """A chain of 1,000 calls, a star of 300 on its last one, calls that depend on two links of it, a long cycle with
    calls behind it: the levels of a walk over the calls, in rounds that grow with the logarithm of the chain."""
    deps = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(1000)}
    deps |= {f"s{i}": ["c999"] for i in range(300)}
    deps |= {"two": ["c17", "c640"], "three": ["two", "c641", "s4"], "after": ["three"], "both": ["after", "c5"]}
    deps |= {f"o{i}": [f"o{(i + 1) % 50}"] for i in range(50)} | {"behind": ["o3"], "partly": ["c3", "behind", "o7"]}
    paths = []
    with common.collected(paths):
        calls = spark.createDataFrame([(c, d) for c, d in deps.items()], "call_id string, depends_on array<string>")
        got = {r["call_id"]: r["level"] for r in tool_calls._levels(calls).collect()}
    names = [p.rsplit("/", 1)[1] for p in paths]
    want = {}
    for c in [f"c{i}" for i in range(1000)] + [f"s{i}" for i in range(300)] + ["two", "three", "after", "both"]:
        want[c] = max((want[d] + 1 for d in deps[c]), default=0)
    assert got == want
    assert sum(n.startswith("calls-links-1-") for n in names) <= 12 and len(names) <= 40


def test_levels_against_a_walk(spark):
    """Random graphs, a few of them with cycles, against settling calls one by one."""
    rng = random.Random(4)
    for density in (1, 2, 4):
        deps = {i: [rng.randrange(i) for _ in range(rng.randint(0, density))] if i else [] for i in range(120)}
        for i in rng.sample(range(100), 2):
            deps[i].append(rng.randrange(i, 120))
        want, last = {}, -1
        while len(want) != last:
            last = len(want)
            want |= {c: max((want[d] + 1 for d in own), default=0) for c, own in deps.items()
                     if c not in want and all(d in want for d in own)}
        calls = spark.createDataFrame([(str(c), [str(d) for d in own]) for c, own in deps.items()],
                                      "call_id string, depends_on array<string>")
        assert {int(r["call_id"]): r["level"] for r in tool_calls._levels(calls).collect()} == want


def test_edges(spark):
    calls = [(1, 0, "a", "add", '{"a":1}', None), (1, 5, "a", "add", '{"a":2}', None), (1, 0, None, "add", '{"a":3}', None),
             (None, None, "n", "add", '{"a":4}', ["a"]), (None, None, None, None, None, None)]
    results = [("a", "one"), ("a", "two"), ("gone", "r"), (None, "nobody"), ("n", "")]
    out = run(spark, calls, results)
    seen = sorted((str(r["conv_id"]), str(r["call_id"]), r["status"], str(r["level"]), str(r["place"])) for r in out)
    assert seen == sorted([("1", "a", "linked", "0", "1"), ("1", "a", "linked", "0", "1"), ("1", "None", "unanswered", "0", "0"),
                           ("None", "n", "linked", "1", "1"), ("None", "None", "unanswered", "0", "0"),
                           ("None", "gone", "orphan", "None", "None"), ("None", "None", "orphan", "None", "None")])
    assert run(spark, [], []) == [] and [r["status"] for r in run(spark, [], [("a", "x")])] == ["orphan"]


def test_calls_without_an_id(spark):
    calls = [(1, 3, None, "search", '{"a":1}', None), (1, 3, None, "fetch", '{"a":2}', None), (1, 4, "b", "add", "{}", None),
             (1, 3, None, "fetch", '{"a":2}', None)]
    calls += [(2, None, None, "add", f'{{"a":{i}}}', None) for i in range(600)] + [(2, None, "z", "add", "{}", None)]
    out = run(spark, calls, [("b", "one"), (None, "nobody")])
    assert len(out) == len(calls) + 1
    loose = [r for r in out if r["call_id"] is None and r["status"] != "orphan"]
    assert {(r["status"], r["level"]) for r in loose} == {("unanswered", 0)}
    assert sorted(r["tool"] for r in loose if r["conv_id"] == 1) == ["fetch", "fetch", "search"]
    assert len({r["message"] for r in loose if r["conv_id"] == 2}) == 600
    place = {(r["conv_id"], r["call_id"]): r["place"] for r in out if r["call_id"]}
    assert place == {(1, "b"): 3, (2, "z"): 600}
    for conv, n in ((1, 4), (2, 601)):
        assert sorted(r["place"] for r in out if r["conv_id"] == conv) == list(range(n))
