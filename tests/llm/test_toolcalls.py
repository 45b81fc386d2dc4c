import json
import random

from glossa.llm import queries, toolcalls
from tests.conftest import SF_SMALL
from tests.llm.conftest import oracle, same

CALLS = "conv_id long, call_id string, turn int, name string, arguments string, depends array<string>, status string"
RESULTS = "conv_id long, call_id string, turn int, content string, name string"
SCHEMAS = [("f", [("q", "string", True), ("n", "integer", False), ("x", "number", False), ("l", "array", False), ("o", "object", False), ("b", "boolean", False)])]


def run(spark, calls, results):
    out = toolcalls.link(spark.createDataFrame([(*c, "clash") for c in calls], CALLS), spark.createDataFrame([(*r, "clash") for r in results], RESULTS), spark.createDataFrame(SCHEMAS, toolcalls.SCHEMA))
    return {(r.conv_id, r.call_id): r for r in out.collect()}, out


def canonical(ident, name, arguments, depends, result):
    return json.dumps({"id": ident, "name": name, "arguments": arguments, "depends_on": sorted(depends), "result": result}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_links_and_serialises(spark):
    args = '{"q": "a \\"b\\" \\u00e9", "n": 3, "o": {"z": [1, null], "a": true}}'
    calls = [(1, "c1", 0, "f", args, []), (1, "c2", 2, "f", '{"q": 1, "zz": 2}', ["c1", "c1", None, "gone"]), (1, "c3", 4, "g", "{}", ["c2"]), (1, "c3", 5, "f", '{"q": "later"}', None), (2, "c1", 0, "f", "no json", None), (2, "c2", 1, "f", "[1]", None), (2, "c3", 2, "f", None, None), (2, "c4", 3, None, "{}", None), (2, "c5", 4, "f", '{"x": 1.5, "b": 1, "l": {}, "q": null}', None), (None, "c9", 0, "f", "{}", None), (2, None, 0, "f", "{}", None)]
    results = [(1, "c1", 1, "ok\n\t"), (1, "c1", 9, "again"), (1, "c2", 3, None), (3, "c1", 1, "alone"), (None, "c1", 1, "x")]
    got, out = run(spark, calls, results)
    assert out.count() == 12
    r = got[1, "c1"]
    assert (r.status, r.valid, r.problems, r.repeats, r.canonical) == ("linked", True, [], 1, canonical("c1", "f", json.loads(args), [], "ok\n\t"))
    r = got[1, "c2"]
    assert (r.status, r.valid, r.problems, r.missing) == ("linked", False, ["type:q", "unknown:zz"], ["gone"])
    assert r.canonical == canonical("c2", "f", {"q": 1, "zz": 2}, ["c1", "gone"], None)
    assert (got[1, "c3"].status, got[1, "c3"].problems, got[1, "c3"].repeats, got[1, "c3"].turn) == ("open", ["schema"], 1, 4)
    assert [got[2, f"c{k}"].problems for k in range(1, 5)] == [["json"], ["json"], ["json"], ["schema"]]
    assert got[2, "c5"].problems == ["type:b", "type:l", "type:q"]
    assert (got[3, "c1"].status, got[3, "c1"].canonical) == ("orphan", canonical("c1", None, None, [], "alone"))
    assert {k for k, r in got.items() if r.status == "unnamed"} == {(None, "c9"), (2, None), (None, "c1")}


def test_order(spark):
    calls = [(1, f"c{k}", k, "f", '{"q":"a"}', [f"c{k - 1}"] if k else []) for k in range(30)]  # turns are the order
    calls += [(2, "a", 0, "f", "{}", ["b"]), (2, "b", 1, "f", "{}", ["d"]), (2, "d", 2, "f", "{}", []), (2, "e", 3, "f", "{}", ["a", "d"])]
    calls += [(3, "a", 0, "f", "{}", ["b"]), (3, "b", 1, "f", "{}", ["a"]), (3, "c", 2, "f", "{}", ["b"]), (3, "d", 3, "f", "{}", []), (3, "e", 4, "f", "{}", ["e"])]
    got, _ = run(spark, calls, [])
    assert [got[1, f"c{k}"].level for k in range(30)] == list(range(30)) and not got[1, "c3"].cyclic
    assert {k: got[2, k].level for k in "abde"} == {"d": 0, "b": 1, "a": 2, "e": 3}
    assert {k: got[3, k].cyclic for k in "abcde"} == {"a": True, "b": True, "c": True, "d": False, "e": True} and got[3, "d"].level == 0


def longest(calls):
    """(level, cyclic) of every call, plainly: settle what waits for nothing open, again and again."""
    deps = {(c, i): {(c, d) for d in w} for c, i, *_, w in calls}
    deps = {k: {d for d in w if d in deps} for k, w in deps.items()}
    level = {}
    while True:
        free = [k for k, w in deps.items() if k not in level and w <= level.keys()]
        if not free:
            return {k: (level.get(k), k not in level) for k in deps}
        level |= {k: max((level[d] + 1 for d in deps[k]), default=0) for k in free}


def test_order_of_any_graph(spark):
    rng = random.Random(7)
    calls = []
    for c in range(25):
        n = rng.randrange(1, 25)
        for k in range(n):
            pick = [rng.randrange(n) if c % 5 == 0 else rng.randrange(k + 1 + (c % 3 == 1)) for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))]
            calls.append((c, f"c{k}", rng.randrange(n), "f", "{}", [f"c{d}" for d in pick if d != k or c % 5 == 0]))
    calls += [(99, f"c{k}", 500 - k, "f", "{}", [f"c{k - 1}", "c0"] if k else []) for k in range(500)]  # one long conversation, turns in reverse
    got, _ = run(spark, calls, [])
    want = longest(calls)
    assert {k: (got[k].level, got[k].cyclic) for k in want} == want
    assert any(cyclic for _, cyclic in want.values()) and want[99, "c499"] == (499, False)


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    rounds = []
    kept = toolcalls.stored
    monkeypatch.setattr(toolcalls, "stored", lambda df, name: rounds.append(name) or kept(df, name))
    run(spark, [(1, f"c{k}", k, "f", "{}", [f"c{k - 1}", "c0"] if k else []) for k in range(400)], [])
    assert rounds.count("settled-calls") <= 3 and rounds.count("chains") <= 15


def test_empty_tables(spark):
    assert run(spark, [], []) [1].count() == 0


def test_whole_table(spark):
    got = {(r.conv_id, r.call_id): r for r in queries.op4_tool_calls(spark, SF_SMALL).collect()}
    turns = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()}
    heads = {}
    for (c, t), r in turns.items():
        if r.role == "system":
            heads[c] = min(t, heads.get(c, t))
    calls = {k: r for k, r in turns.items() if r.role in ("system", "user")}
    size = {k: len(r.text.encode()) for k, r in calls.items()}
    waits = {(c, t + 2) for (c, t), r in calls.items() if r.role == "user" and size[c, t] % 5 == 0}
    graph, problem = [], {2: "missing:words", 3: "type:words", 4: "unknown:lang"}
    for (c, t), r in calls.items():
        user = r.role == "user"
        depends = [f"call-{t - 2}"] * (user and t >= 2 and (c, t) not in waits) + [f"call-{t + 2}"] * (user and size[c, t] % 5 <= 1) + [f"call-{heads.get(c)}"] * (heads.get(c, t) != t)
        answer = turns.get((c, t + 1))
        answer = answer.text if answer is not None and answer.role == "assistant" else None
        flaw, words = size[c, t] % 11, len(r.text.split())
        arguments = {"text": r.text} | ({} if flaw == 2 else {"words": str(words) if flaw == 3 else words}) | ({"lang": "xx"} if flaw == 4 else {})
        assert got[c, f"call-{t}"].canonical == canonical(f"call-{t}", "configure" if r.role == "system" else "answer", arguments, set(depends), answer)
        assert got[c, f"call-{t}"].problems == problem.get(flaw, "") and got[c, f"call-{t}"].missing == ",".join(sorted({d for d in depends if (c, int(d[5:])) not in calls}))
        graph.append((c, f"call-{t}", t, "f", "{}", depends))
    want = {k: (-1 if cyclic else level, cyclic) for k, (level, cyclic) in longest(graph).items()}
    assert {k: (got[k].level, got[k].cyclic) for k in want} == want
    assert sum(r.status != "orphan" for r in got.values()) == len(calls)
    assert {r.cyclic for r in got.values()} == {True, False} and len({r.level for r in got.values()}) > 3 and len({r.problems for r in got.values()}) == 4


def test_query_against_sql(spark):
    same(queries.op4_tool_calls(spark, "/root/testdata/sf0.01").toPandas(), oracle("op4_tool_calls", "/root/testdata/sf0.01"))
