import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tarnloom.functions import codecheck, dom, text as X, toolspec
from tarnloom.operators import history, ranking, resolve, skew, tasks
from tarnloom.operators.components import connected_components


def test_components(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e"), ("f", "f"), (None, "a"), ("c", "b")], "a string, b string")
    got = {r["node"]: r["component"] for r in connected_components(e).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}
    assert connected_components(e.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    n = 60
    e = spark.createDataFrame([(i, i + 1) for i in random.Random(1).sample(range(n), n)], "a bigint, b bigint")
    assert {r["component"] for r in connected_components(e).collect()} == {0}


def test_heavy_keys(spark):
    rows = [(f"j{i % 900}", "completed", None, datetime(2024, 1, 1), 0, None, None, 1, datetime(2024, 1, 2), None, (" A " if i % 3 == 0 else f"o{i % 400}"), (None if i % 2 else "G")) for i in range(1000)]
    q = spark.createDataFrame(rows, "job_id string, status string, job_data string, created_at timestamp, priority int, lock_id string, locked_at timestamp, stalls int, finished_at timestamp, failed_reason string, owner_id string, group_id string")
    got = {tuple(r) for r in skew.found(q).collect()}
    assert ("owner_id", "a") in got and ("group_id", "g") in got and not any(v.startswith("o") for _, v in got)
    stats = skew.per_key(q, "owner_id").toPandas().set_index("owner_id")
    assert stats.loc["a", "heavy"] and stats["n_jobs"].sum() == 900
    assert skew.found(q.limit(0)).count() == 0


def test_merge_records_follows_the_fold(spark):
    rng = random.Random(3)
    for _ in range(3):
        rows = [(i, rng.choice(["", "t1", "t2", "t3", "t4", None]), rng.choice(["", "http://u/1", "http://u/2", "http://u/3", None])) for i in range(25)]
        old, new = rows[:5], rows[5:]
        schema = "seq bigint, title string, url string"
        got = {(r["seq"]) for r in resolve.merge_records(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)).collect()}
        keep = resolve.fold_merge([((t or "").strip().lower(), u or "", i < 5) for i, t, u in rows])
        assert got == {r[0] for r, k in zip(rows, keep) if k}


def test_merge_keeps_third(spark):
    schema = "seq bigint, title string, url string"
    new = spark.createDataFrame([(1, "t1", "http://u/1"), (2, "t2", "http://u/1"), (3, "t2", "http://u/3")], schema)
    assert {r["seq"] for r in resolve.merge_records(new.limit(0), new).collect()} == {1, 3}


def test_fuse():
    assert resolve.fuse([{"a": 1, "b": None}, {"a": 1, "b": "x"}, {"a": 2, "b": "null"}]) == [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    assert resolve.fuse([{"a": 1, "l": [1]}, {"a": 1, "l": [2, 1]}]) == [{"a": 1, "l": [1, 2]}]


def test_fuse_records(spark):
    rows = spark.createDataFrame([("g", 1, json.dumps({"a": 1, "b": None})), ("g", 2, json.dumps({"a": 1, "b": 5})), ("h", 1, json.dumps({"a": 9}))], "g string, seq int, item string")
    got = {(r["g"], r["position"]): json.loads(r["item"]) for r in resolve.fuse_records(rows, "g", "item", ["seq"]).collect()}
    assert got == {("g", 0): {"a": 1, "b": 5}, ("h", 0): {"a": 9}}


def test_schema_halves():
    s = {"properties": {"a": {"type": "string"}, "b": {"type": "array"}, "c": {"type": "object", "properties": {"d": {}}}}, "required": ["a", "b"]}
    one, rest = resolve.split_schema(s, ["b", "c.d"])
    assert set(one["properties"]) == {"b", "c"} and rest["required"] == ["a"]
    assert resolve.mix_objects(s, {"a": "x", "c": {"d": 1}}, {"b": [1], "c": {"d": 2}}) == {"a": "x", "b": [1], "c": {"d": 2}}
    assert resolve.array_to_object(s, [{"a": None, "b": [1]}, {"a": "z", "b": [1, 2]}]) == {"a": "z", "b": [1, 2], "c": {}}


def test_change_status(spark):
    v = spark.createDataFrame([(1, "u", 1, 200, "ab c"), (2, "u", 2, 200, "c ba"), (3, "u", 3, 200, ""), (4, "u", 4, 200, "abx"), (5, "u", 5, 404, None)], "version_id int, k string, t int, status_code int, markdown string")
    got = [r["change"] for r in history.change_status(v, "k", ["t"]).orderBy("version_id").collect()]
    assert got == ["new", "same", "changed", "changed", "removed"]


def test_as_of(spark):
    left = spark.createDataFrame([(1, "k", 5), (2, "k", 1), (3, "z", 9)], "id int, k string, t int")
    right = spark.createDataFrame([("k", 2, "a"), ("k", 5, "b"), ("k", 7, "c")], "k string, at int, v string")
    got = {r["id"]: (r["v"], r["as_of_at"]) for r in history.as_of(left, right, "k", "t", "at", ["v"]).collect()}
    assert got == {1: ("b", 5), 2: (None, None), 3: (None, None)}


def test_runs_and_take_while(spark):
    r = spark.createDataFrame([(1, "u", "a"), (2, "u", None), (3, "u", None), (4, "u", "a")], "t int, u string, v string")
    assert [x["n_rows"] for x in history.runs(r, "u", ["t"], "v").orderBy("run_no").collect()] == [1, 2, 1]
    assert [x["t"] for x in history.take_while(r, "u", ["t"], F.col("v") == "a").collect()] == [1]


def test_vector_top_k(spark):
    v = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)] + [(99, None), (98, [1.0])], "vec_id bigint, embedding array<float>")
    q = v.where("vec_id in (0, 5)")
    for block in (1, 100):
        got = {(r["query_id"], r["rank"]): r["vec_id"] for r in ranking.vector_top_k(v, q, 2, block=block).collect()}
        assert got == {(0, 1): 1, (0, 2): 2, (5, 1): 4, (5, 2): 6}
    assert ranking.vector_top_k(v, v.limit(0), 2).count() == 0


def test_text_functions(spark):
    df = spark.createDataFrame([("Héllo, World!  x",), ("",), ("a" * 1000,)], "t string")
    r = df.select(X.slug(F.col("t")).alias("s"), X.chunks(F.col("t"), 400, 100).alias("c"), X.preview(F.col("t"), 5).alias("p")).collect()
    assert r[0]["s"] == "h-llo-world-x" and r[1]["s"] == "task" and r[1]["c"] is None
    assert [len(x) for x in r[2]["c"]] == [400, 400, 400, 100] and r[2]["p"] == "aaaaa... (truncated)"


def test_reply_json(spark):
    df = spark.createDataFrame([('{"a":1}',), ('x\n```json\n{"b":2}\n```',), ('see {"c":3} there',), ("none",)], "t string")
    assert [r[0] for r in df.select(X.fenced_json(F.col("t"))).collect()] == ['{"a":1}', '{"b":2}', '{"c":3}', None]


def test_diffs(spark):
    diff = "diff --git a/src/a.py b/src/a.py\n+++ b/src/a.py\n+x\ndiff --git a/tests/t.py b/tests/t.py\n+++ b/tests/t.py\n+y\n"
    df = spark.createDataFrame([(diff, "Fixes #12, closes #3 <!-- fixes #9 --> see #4")], "d string, b string")
    r = df.select(X.changed_files(F.col("d")).alias("f"), X.split_patch(F.col("d")).alias("p"), X.resolved_issues(F.col("b")).alias("i")).first()
    assert r["f"] == ["src/a.py", "tests/t.py"] and r["p"]["fix"].endswith("+x\n") and "+y" in r["p"]["test"] and r["i"] == ["12", "3"]


def test_dom():
    html = '<html lang="en"><head><title> T </title><meta name="description" content="a"><meta property="description" content="b"><base href="/d/"></head><body><nav><a href="/n">n</a></nav><div id="main"><p>x <a href="y">l</a><p>z</div><img srcset="a.png 1x, b.png 2x"></body>'
    m = dom.metadata(html)
    assert m["title"] == ["T"] and m["language"] == ["en"] and m["description"] == ["a, b"]
    assert dom.absolute_links(html, "https://e.x/p") == ["https://e.x/n", "https://e.x/d/y"]
    clean = dom.transform(html, "https://e.x/p")
    assert "<nav>" not in clean and 'href="https://e.x/d/y"' in clean and "b.png" in clean
    assert dom.attributes(html, "div#main > p a", "href") == ["y"] and dom.attributes(html, "p:first", "x") == []
    assert dom.images('<img src="a.png"><div style="background:url(b.png)">', "https://e.x/") == ["https://e.x/a.png", "https://e.x/b.png"]
    assert dom.tidy_markdown("[Skip to Content](#m)[a\nb](/c)") == "[a\\\nb](/c)"
    assert dom.markdown("<ol><li>a<li>b</ol><blockquote>q</blockquote>") == "1. a\n2. b\n\n> q"
    assert dom.markdown(None) == "" and dom.links("<a>") == []


def test_toolspec():
    spec = toolspec.from_source('raise SystemExit\n@m.tool("find", description="D", foo=1, meta={"v": 2})\nasync def impl(q: str, n: int | None = None):\n    "doc"\n    1/0\n')
    assert (spec.name, spec.description, spec.is_async, spec.meta) == ("find", "D", True, {"v": 2, "_decorator_extras": {"foo": 1}})
    assert spec.parameters["required"] == ["q"] and spec.parameters["properties"]["n"] == {"type": "integer", "default": None}
    with pytest.raises(TypeError):
        toolspec.from_source("@t(name=3)\ndef f(): pass")
    with pytest.raises(ValueError):
        toolspec.from_function(lambda x: x)
    r = toolspec.Registry()
    r.register(lambda x: 1 // x, "inv")
    assert r.call("inv", x=1)["output"] == 1 and r.call("inv", x=1)["cached"] and r.call("inv", x=0)["error"] == "ZeroDivisionError" and r.call("no")["error"] == "missing"


def test_code_checks():
    good = "import re\ndef solve(tools):\n    return {'a': tools.find(q=1)}\n"
    assert codecheck.check_solution(good) == (True, "") and codecheck.tool_calls(good) == ["find"]
    assert codecheck.check_solution("import os\n" + good)[1] == "import" and codecheck.check_solution(good + "eval('1')")[1] == "unsafe"
    assert codecheck.check_solution("x(")[1] == "syntax" and codecheck.check_solution(None)[1] == "empty"
    assert codecheck.check_verifier("def verify(a):\n    return True")[1] == "constant" and codecheck.check_verifier("def verify(a):\n    return a > 1") == (True, "")
    assert codecheck.drop_repeated_functions("def f(): return 1\ndef f(): return 2").count("def f") == 1


def test_tasks(spark):
    t = spark.createDataFrame([(1, "0.5", "1", "x", None), (2, "1", "1", "1", "1"), (3, "9", "-1", None, None)], "seq int, correctness string, complexity string, diversity string, verifiability string")
    got = {r["seq"]: (r["composite"], r["rank"]) for r in tasks.ranked(t).collect()}
    assert got == {2: (1.0, 1), 3: (0.61, 2), 1: (0.54, 3)}
    v = spark.createDataFrame([("q1", "truth", "yes"), ("q1", "candidate", "no"), ("q2", "truth", "YES"), ("q2", "candidate", "INCORRECT"), ("q3", "truth", "no"), ("q4", "truth", "yes")], "question_id string, kind string, verdict string")
    assert {r["question_id"]: r["retain"] for r in tasks.retained(v).collect()} == {"q1": True, "q2": False, "q3": False, "q4": True}
    p = spark.createDataFrame([(["t"], "one two three four five six seven eight", "def verify"), ([], "short", "verify"), (["t"], None, None)], "tools array<string>, c string, v string")
    assert [r[0] for r in p.select(tasks.package_problem(F.col("tools"), F.col("c"), F.col("v"))).collect()] == [None, "too short", "verification"]


def test_annotations(spark):
    p = spark.createDataFrame([("a",), ("b",), ("c",)], "instance_id string")
    a = spark.createDataFrame([("a", 1, "bug", True, 3), ("a", 2, "doc", False, 1), ("b", 1, "bug", False, None)], "instance_id string, seq int, kind string, ok boolean, files int")
    ids = lambda **k: {r["instance_id"] for r in tasks.filtered_by_annotations(p, a, **k).collect()}
    assert ids(criteria={"kind": ["bug"], "ok": True, "files": (None, 5)}) == {"a", "c"}
    assert ids(criteria={"kind": ["bug"]}, require=True) == {"a", "b"}


def test_assembled(spark):
    env = spark.createDataFrame([("e", "x"), ("f", "y")], "env_id string, kind string")
    tools = spark.createDataFrame([("e", 1, "t", "d"), ("e", 2, "t", "again")], "env_id string, seq int, name string, description string")
    ts = spark.createDataFrame([("e", 1, "A", "c", "def verify", None), ("e", 2, "B", "c", "nothing", None)], "env_id string, seq int, title string, content string, verification string, error string")
    docs = {r["env_id"]: json.loads(r["document"]) for r in tasks.assembled(env, tools, ts).collect()}
    assert docs["e"]["metadata"] == {"n_tools": 1, "n_tasks": 1, "version": "1.2"} and docs["f"]["metadata"]["n_tools"] == 0


def test_similarity_verdict_against_brute_force(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng = random.Random(4)
    head = "x" * 60  # the same beginning says nothing of the whole
    rows = []
    for g in range(12):
        for _ in range(rng.randint(1, 8)):
            a = head + "".join(rng.choice("abcdé") for _ in range(rng.randint(0, 300)))
            b = "".join(x if rng.random() > 0.02 * g else rng.choice("qrs") for x in a)
            rows.append((g, rng.choice([a] * 6 + [None, ""]), rng.choice([b] * 8 + [None, ""])))
    rows += [(50, None, "a"), (51, "a", None), (52, head + "a" * 100, head + "b" * 100)]
    want = {}
    for g in {r[0] for r in rows}:
        own = [(a, b) for k, a, b in rows if k == g]
        tried = [(a, b) for a, b in own if a]
        ok = sum(bool(b) and 1 - distance(a, b) / max(len(a.encode()), len(b.encode())) >= 0.85 for a, b in tried)
        failed = len(own) - len(tried)
        want[g] = (ok, len(tried) - ok, failed, "Uncertain" if failed > 0.5 * len(own) or not tried else "TlsClientOk" if ok / len(tried) >= 0.7 else "ChromeCdpRequired")
    df = spark.createDataFrame(rows, "g int, gold string, other string")
    assert {r[0]: tuple(r)[1:] for r in ranking.similarity_verdict(df, "g").collect()} == want and len({v[3] for v in want.values()}) == 3


def test_verdict_of_whole_items(spark, tmp_path):
    from tarnloom.plans import registry

    same = "x" * 60
    rows = [(1, same + "a" * 100), (2, same + "a" * 99 + "b"), (3, same + "a" * 99 + "c"), (4, same + "a" * 99 + "d"), (5, same + "z" * 100)]
    spark.createDataFrame(rows, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r[0]: tuple(r)[1:] for r in registry.queries()["levenshtein_verdict"](spark, str(tmp_path)).collect()}
    assert got == {1: (3, 0, 0, "TlsClientOk"), 2: (2, 1, 0, "ChromeCdpRequired"), 3: (1, 1, 0, "ChromeCdpRequired"), 4: (0, 1, 0, "ChromeCdpRequired")}
