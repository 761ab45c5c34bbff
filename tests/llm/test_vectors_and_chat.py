"""Nearest neighbours against brute force, tool-call linking, and the whole pipeline."""

import json
import math

import numpy as np
from pyspark.sql import functions as F

from wakeline.llm import ann, chat

SCHEMAS = [("add", "a", "integer", True), ("add", "b", "number", True), ("add", "note", "string", False)]


def _exact(rows, queries, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == 8
            and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, qv in good:
        if q in queries:
            d = sorted((float(np.sqrt(((np.array(v) - np.array(qv)) ** 2).sum())), i) for i, v in good if i != q)
            out[q] = d[:k]
    return out


def test_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((1500, 8)).astype(np.float32)
    base[300:700] = base[300]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [float("nan")] + [1.0] * 7), (2300, [1.0, None] + [1.0] * 6), (None, [1.0] * 8),
             (2400, [1.0, 2.0]), rows[5], rows[100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for r in ann.neighbours(df, df.filter("vec_id % 100 = 0"), k=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = _exact(rows, {i for i in range(0, 3000, 100)}, 10)
    assert got.keys() == want.keys()
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, len(near) + 1))
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        hits += len({v for _, v, _ in mine} & {v for _, v in near})
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert ann.neighbours(df.limit(0), df.limit(0)).count() == 0


def test_few_candidates_are_all_returned(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in (0, 1, 2)], "vec_id long, embedding array<float>")
    got = sorted((r["rank"], r.vec_id) for r in ann.neighbours(df, df.filter("vec_id = 0"), k=10).collect())
    assert got == [(1, 1), (2, 2)]


def test_bounds_hold_the_distances():
    rng = np.random.default_rng(2)
    x, q, c = rng.standard_normal((400, 64)), rng.standard_normal((30, 64)), rng.standard_normal(64) * 0.1
    turn = ann.rotation(64)
    low, high = ann.bounds(*ann.codes(x, c, turn), q, c, turn, ann.EPSILON)
    exact = ((x[:, None, :] - q[None, :, :]) ** 2).sum(axis=2)
    assert ((low <= exact) & (exact <= high)).mean() > 0.99


def _call(i, name, arguments):
    return {"id": i, "name": name, "arguments": arguments}


def test_tool_calls_are_linked_ordered_and_checked(spark):
    calls = [_call("x", "add", {"b": 2.5, "a": 1}), _call("y", "add", {"a": {"$ref": "x"}, "b": 1}),
             _call("z", "add", {"a": "one", "extra": True}), _call("c1", "add", {"a": {"$ref": "c2"}, "b": 1}),
             _call("c2", "add", {"a": {"$ref": "c1"}, "b": 1}), _call("u", "gone", {}), _call("w", "add", {"a": {"$ref": "y"}, "b": 3}),
             _call(None, "add", [1])]
    rows = [(1, 0, "user", "hello"), (1, 1, "assistant", json.dumps({"tool_calls": calls})),
            (1, 2, "tool", json.dumps({"tool_call_id": "x", "content": "3.5"})), (1, 3, "tool", json.dumps({"tool_call_id": "nobody", "content": None})),
            (1, 4, "assistant", "plain"), (1, 5, "tool", "not json"), (1, 6, None, None), (None, 0, "user", "lost"), (1, 0, "user", "hello"),
            (2, 0, "assistant", json.dumps({"tool_calls": [_call("x", "add", {"a": 1, "b": 1})]}))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("kind", F.lit("own"))
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    out = chat.formatted(df, schemas).collect()
    got = {(r.conv_id, r.call_id): r for r in out if r.kind == "call"}
    assert {k: r.level for k, r in got.items()} == {(1, "x"): 0, (1, "y"): 1, (1, "w"): 2, (1, "z"): 0, (1, "u"): 0, (1, "c1"): None,
                                                    (1, "c2"): None, (1, None): None, (2, "x"): 0}
    assert got[1, "x"].linked and not got[2, "x"].linked and not got[1, "y"].linked
    assert got[1, "z"].errors == ["missing b", "type a", "unknown extra"]
    assert got[1, "u"].errors == ["unknown tool"] and got[1, None].errors == ["not an object"]
    assert got[1, "y"].valid and got[1, "x"].valid
    assert got[1, "x"].json == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add"}'
    results = {r.call_id: r.linked for r in out if r.kind == "result"}
    assert results["x"] and not results["nobody"]
    assert sum(r.kind == "message" for r in out) == 4
    assert chat.formatted(df.limit(0), schemas).count() == 0


def _formatted(spark, rows):
    df = spark.createDataFrame([(1, t, r, x if isinstance(x, str) else json.dumps(x)) for t, r, x in rows],
                               "conv_id long, turn long, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    return chat.formatted(df, schemas).collect()


def test_nothing_of_a_call_is_lost(spark):
    nested = {"id": "n", "function": {"name": "add", "arguments": '{"b":1,"a":2}'}}
    broken = {"id": "b", "name": "add", "arguments": '{"a": "x'}
    twice = {"id": "t", "name": "add", "arguments": '{"a":1,"a":2}'}
    lost = {"id": "l", "name": "add", "arguments": {"a": {"$ref": "nobody"}, "b": 1}}
    out = _formatted(spark, [(5, "assistant", {"content": "I add", "tool_calls": [nested, broken, twice, lost]}),
                             (4, "tool", {"tool_call_id": "n", "content": "early"}),
                             (6, "tool", {"tool_call_id": "n", "content": {"z": 1, "y": [2]}}),
                             (7, "tool", {"tool_call_id": "n", "content": "again"}),
                             (4, "tool", {"tool_call_id": "b", "content": "early"})])
    got = {r.call_id: r for r in out if r.kind == "call"}
    assert json.loads(got["n"].json) == {"arguments": {"a": 2, "b": 1}, "id": "n", "name": "add"} and got["n"].valid
    assert json.loads(got["b"].json)["arguments"] == got["b"].arguments == '{"a": "x'
    assert json.loads(got["t"].json)["arguments"] == got["t"].arguments == '{"a":1,"a":2}'
    assert got["b"].errors == got["t"].errors == ["not an object"]
    assert got["l"].errors == ["reference nobody"] and got["l"].level == 0
    assert [json.loads(r.json) for r in out if r.kind == "message"] == [{"content": "I add", "role": "assistant"}]
    assert got["n"].linked and not got["b"].linked
    results = {(r.call_id, r.turn): r for r in out if r.kind == "result"}
    assert {k for k, r in results.items() if r.linked} == {("n", 6)}
    assert results["n", 6].json == '{"content":{"y":[2],"z":1},"role":"tool","tool_call_id":"n"}'
    assert json.loads(results["n", 7].json)["content"] == "again"


def _levels_by_hand(needs):
    level = {c: 0 for c, n in needs.items() if not n}
    while True:
        more = {c: 1 + max(level[x] for x in n) for c, n in needs.items() if c not in level and all(x in level for x in n)}
        if not more:
            return {c: level.get(c) for c in needs}
        level.update(more)


def test_levels_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(6)
    needs = {f"k{i}": {f"k{i - 1}"} if i else set() for i in range(1000)}  # a chain
    needs |= {f"r{i}": {f"r{j}" for j in rng.integers(0, i, rng.integers(0, 4))} if i else set() for i in range(60)}
    needs |= {"o1": {"o2"}, "o2": {"o3"}, "o3": {"o1"}, "o4": {"o1"}, "o5": {"o4", "k3"}, "o6": {"o6"}, "m": {"k999", "r9"}, "m2": {"m"}}
    df = spark.createDataFrame([(1, 0, "h", i, c, "add", json.dumps([{"$ref": n} for n in sorted(v)]))
                                for i, (c, v) in enumerate(needs.items())],
                               "conv_id long, turn long, message string, place int, call_id string, name string, arguments string")
    rounds = []
    real = chat.materialize
    monkeypatch.setattr(chat, "materialize", lambda d: rounds.append(1) or real(d))
    chat._jumped(chat.references(df.filter("call_id like 'k%'")).filter("needs like 'k%'"))
    assert len(rounds) <= 12
    assert {r.call_id: r.level for r in chat.levels(df).collect()} == _levels_by_hand(needs)


def test_calls_of_messages_that_share_a_turn_stay_apart(spark):
    rows = []
    for conv, turn in ((1, 0), (None, 0), (None, None), (2, None)):
        rows += [(conv, turn, "assistant", json.dumps({"tool_calls": [_call(f"i{n}", "add", a), _call("same", "add", a)]}))
                 for n, a in enumerate([{"a": 1, "b": 1}, {"a": "x", "b": 1}, {"a": 1}])]
        rows += [(conv, turn, "tool", json.dumps({"tool_call_id": i, "content": "r"})) for i in ("i1", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, param string, type string, required boolean")
    want = {"i0": [], "i1": ["type a"], "i2": ["missing b"]}
    got = [r for r in chat.formatted(df, schemas).collect() if r.kind == "call"]
    assert len(got) == 4 * 6
    for conv, turn in ((1, 0), (None, 0), (None, None), (2, None)):
        here = [r for r in got if (r.conv_id, r.turn) == (conv, turn)]
        assert {r.call_id: r.errors for r in here if r.call_id != "same"} == want
        assert sorted(r.errors for r in here if r.call_id == "same") == sorted(want.values())
        assert all(r.valid == (not r.errors) for r in here)
        assert {r.call_id for r in here if r.linked} == (set() if conv is None else {"i1", "same"})
        assert sum(r.linked for r in here) == (0 if conv is None else 2)


def test_pipeline_stages_keep_clean_documents(spark, scratch):
    import corpus_pipeline as P

    rng = np.random.default_rng(4)
    vocab = {"en": [f"the{i}ing" for i in "abcdefghij"] + ["of", "and"], "de": [f"der{i}ung" for i in "klmnopqrst"] + ["und", "ich"]}
    words = {k: [w + x for w in v for x in ("", "s", "en", "er", "t", "ly")] for k, v in vocab.items()}
    rows = []
    for i in range(240):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join(rng.choice(words[lang], 80)), lang, f"s{i % 3}", 1, "own"))
    rows[10] = (10, rows[8][1] + " tail", "en", "s1", 1, "own")
    rows += [(500, "too short", "en", "s0", 1, "own"), (501, None, None, None, None, None), (502, "1 2 3 4 5 6 7 8 9 10 11 12", "en", "s0", 1, "own"),
             (503, rows[7][1].replace(" ", ' token = "abcdEFGH1234" ', 1), "de", "s0", 1, "own"), rows[20], rows[20]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    df.write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    seen = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, scratch)
        if name != P.STAGES[-1][0]:
            assert out.columns == df.columns
            out.write.parquet(f"{scratch}/{name}")
            docs = spark.read.parquet(f"{scratch}/{name}")
            seen.append({r.doc_id: r.text for r in docs.collect()})
    clean = set(range(240))
    assert clean <= seen[0].keys() and 500 not in seen[0] and 501 not in seen[0]
    assert 502 not in seen[1] and clean <= seen[1].keys()
    assert 10 not in seen[2] and 8 in seen[2] and docs.filter("doc_id = 20").count() == 1
    assert "abcdEFGH1234" not in "".join(seen[3].values()) and seen[3].keys() == seen[2].keys()
    packed = P.run(spark, scratch)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(seen[3])
    sizes = packed.groupBy("bin_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0]
    assert sizes <= 8192


def test_queries_register_one_per_operator():
    from wakeline.llm.queries import QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
