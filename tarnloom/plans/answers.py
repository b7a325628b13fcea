"""Queries of answers, verdicts, schemas and texts of tools; their inputs are drawn from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.functions import answers as A
from tarnloom.functions import text as X
from tarnloom.functions import urls as U
from tarnloom.operators import sites as S
from tarnloom.operators import tasks as T
from tarnloom.tables import table


def _docs(spark, d):
    return table(spark, d, "documents").where("doc_id is not null")


def _pick(values, c):
    """One of the values, by a number."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (c % len(values) + 1).cast("int"))


ANSWERS = ("null", "{}", " [ ] ", '"  "', '{"result": []}', '{"result": null, "data": {"a": 1}}', '{"content": ""}', "0", "false", '[{"x": 1}]', '{"other": 1}')
SCHEMAS = ('{"properties": {"b": {}, "a": {}}, "required": ["c", "a"]}', '{"required": ["z"]}', '[{"k": 1, "j": 2}]', "[]", "no json", '{"type": "object"}')
OUTPUTS = ("true", "false", '{"passed": true, "score": 0.5, "message": "fine"}', '{"ok": false, "error": "bad"}', '[true, 0.25, {}, "note"]', '[false, "why"]', "7", '{"score": "1.5"}')
REPORTS = ('{"status": "success", "saved_data": {"result": "r"}}', '{"message": "m", "result": "q"}', '{"status": "s", "submitted_data": "d"}', '{"status": "s", "data": "x"}', '{"result": "plain"}', "5", '{"status": "s"}')
ANNOTATIONS = (
    '{"pr_category": "bug_fix", "issue_difficulty": "easy", "issue_description_reasonable": true, "gold_patch_solves_issue": false, "test_patch_designed_for_issue": true, "requires_gpu": false}',
    '{"pr_category": "chore", "issue_difficulty": "easy", "issue_description_reasonable": true, "gold_patch_solves_issue": false, "test_patch_designed_for_issue": true, "requires_gpu": false}',
    '{"pr_category": "bug_fix", "issue_difficulty": "hard", "issue_description_reasonable": "true", "gold_patch_solves_issue": false, "test_patch_designed_for_issue": true, "requires_gpu": false}',
    '{"pr_category": "feature_request", "issue_difficulty": "medium", "issue_description_reasonable": true, "gold_patch_solves_issue": false, "test_patch_designed_for_issue": true}',
    "nothing",
)
CODES = ("return list(tools.keys())", "def solve(tools):\n    return tools['a']()", "x = 1\nreturn  x", "return [k for k in tools]", "def verify(a):\n    return True", "return isinstance(answer, list)", "return a == b")


def _answer_checks(spark, d):
    r = _docs(spark, d).select("doc_id", *(_pick(v, F.col("doc_id")).alias(n) for n, v in (("a", ANSWERS), ("s", SCHEMAS), ("r", REPORTS), ("n", ANNOTATIONS))))
    return r.select("doc_id", A.has_content(F.col("a")).alias("has_content"), F.array_join(A.expected_fields(F.col("s")), ",").alias("fields"), A.unwrapped(F.col("r")).alias("answer"), A.annotation_problem(F.col("n")).alias("problem"))


def _verifications(spark, d):
    r = _docs(spark, d).select("doc_id", A.verification(_pick(OUTPUTS, F.col("doc_id"))).alias("v"))
    return r.select("doc_id", F.col("v.verified").cast("int").alias("verified"), "v.score", "v.message")


def _trivial(spark, d):
    c = _pick(CODES, F.col("doc_id"))
    return _docs(spark, d).select("doc_id", A.is_trivial(c).alias("solution"), A.is_trivial(c, A.TRIVIAL_VERIFIER).alias("verifier"))


def _numbers(spark, d):
    e = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), "value")
    return e.select("event_id", A.backoff(F.col("k") % 9).alias("wait"), A.job_priority(F.col("k"), F.lit(10), 25, 0.3).alias("priority"), A.clamped(F.col("k") - 5, 20).alias("clamped"))


def _parents(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.avg("l_quantity").alias("mean"))
    p = table(spark, d, "part").join(li, F.col("p_partkey") == F.col("l_partkey"), "left")
    return p.select("p_partkey", A.keeps_parent(F.floor("p_retailprice"), F.coalesce("n", F.lit(0)), F.coalesce(F.col("mean"), F.lit(0.0)) * 40, 60).alias("keeps"))


def _uuids(spark, d):
    return _docs(spark, d).where("text is not null").select("doc_id", A.name_uuid(F.col("text")).alias("task_id"))


def _record_counts(spark, d):
    li = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("own"), F.collect_list(F.array_repeat(F.col("l_linestatus"), F.col("l_linenumber"))).alias("others"))
    return li.select("l_orderkey", A.record_count(F.col("own"), F.col("others")).alias("n"))


def _skeletons(spark, d):
    s = F.array(F.struct(F.col("doc_kind").alias("title"), F.col("text").alias("text"), F.when(F.col("doc_id") % 2 == 0, F.array("lang")).alias("bullets")))
    return _docs(spark, d).select("doc_id", F.to_json(A.skeleton(s)).alias("skeleton"))


def _compact(spark, d):
    f = A.compact_json(300)
    return _docs(spark, d).where("text is not null").select("doc_id", f(F.to_json(F.struct(F.col("text").alias("t"), F.split("text", " ").alias("w")))).alias("json"))


def _tool_texts(spark, d):
    u = F.col("source_url")
    r = _docs(spark, d).where("source_url is not null")
    return r.select("doc_id", X.tool_prefix(u).alias("prefix"), U.depth(u).alias("depth"), U.adjusted_depth(u, F.lit(3)).alias("deepest"), S.category(u, ("example", "test")).alias("category"))


def _engines(spark, d):
    r = _docs(spark, d).where("source_url is not null").select("doc_id", F.col("source_url").alias("url"))
    return S.forced_engine(r, [("*.example", "wild"), ("test", "plain"), ("*.invalid", "none")]).select("doc_id", "engine")


def _budgets(spark, d):
    t = F.col("text")
    return _docs(spark, d).where("text is not null").select("doc_id", F.length(X.trimmed_to_budget(t, 100)).alias("n_trimmed"), (F.length(t) > 20).alias("context"), X.without_nul(F.concat(t, F.lit("\x00x"))).alias("text"))


def _sources(spark, d):
    item = F.struct(F.when(F.col("doc_id") % 3 != 0, F.col("doc_kind")).alias("title"), F.col("source_url").alias("url"), F.col("source").alias("summary"))
    g = _docs(spark, d).groupBy((F.col("doc_id") % 50).alias("g")).agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("x")))), lambda r: r["x"]).alias("r"))
    return g.select("g", X.source_list(F.col("r")).alias("sources"))


def _paged(spark, d):
    t = F.concat(F.lit("head\n<|site-page-1-lllmstxt|>\n"), F.col("text"), F.lit("\n<|site-page-2-lllmstxt|>\n"), F.col("doc_kind"))
    r = _docs(spark, d).where("text is not null and doc_kind is not null").select("doc_id", t.alias("t"))
    return r.select("doc_id", F.size(X.split_pages(F.col("t"))).alias("n_pages"), F.element_at(X.split_pages(F.col("t")), 2).alias("second"), F.length(X.without_markers(F.col("t"))).alias("n_chars"))


def _document_texts(spark, d):
    p = table(spark, d, "pages").where("page_id is not null and markdown is not null")
    meta = F.create_map(F.lit("a"), F.coalesce("meta_title", F.lit("undefined")), F.lit("b"), F.col("markdown"))
    return p.groupBy("page_id").agg(F.max(X.document_text(F.col("markdown"), meta)).alias("document"))


def _code_blocks(spark, d):
    t = F.concat(F.lit("say\n```python\nx = "), F.col("doc_id").cast("string"), F.lit("\n```\nand\n```\ny\n\n```\n\\boxed{ "), F.col("doc_kind"), F.lit(" } \\boxed{no}"))
    r = _docs(spark, d).where("doc_kind is not null").select("doc_id", t.alias("t"))
    return r.select("doc_id", F.array_join(X.code_blocks(F.col("t")), "|").alias("blocks"), X.boxed(F.col("t")).alias("boxed"), F.length(X.without_fences(F.col("t"))).alias("n"))


def _json_texts(spark, d):
    j = F.concat(F.lit('{"id": '), F.col("doc_id").cast("string"), F.lit("}"))
    t = F.when(F.col("doc_id") % 3 == 0, j).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("Here:\n```json\n"), j, F.lit("\n```\n"))).otherwise(F.concat(F.lit("so "), j, F.lit(" it is")))
    html = F.concat(F.lit("<html><body class='x'><pre>"), j, F.lit("</pre></body></html>"))
    r = _docs(spark, d)
    return r.select("doc_id", X.fenced_json(t).alias("json"), X.inner_json(html).alias("inner"), X.json_as_markdown(F.when(F.col("doc_id") % 2 == 0, "application/JSON; charset=utf-8"), j, F.lit("md")).alias("markdown"))


def _wiki(spark, d):
    body = F.concat(F.lit('<div class="hatnote x">See <b>that</b></div><p>Town of '), F.col("doc_kind"), F.lit(" &amp; more[1] http://a.example/x lies  here.</p>\n \n\n<p>Next &lt;5&gt;</p>\nReferences\n<p>gone</p>"))
    return _docs(spark, d).where("doc_kind is not null").select("doc_id", X.wiki_text(body).alias("text"))


def _export_urls(spark, d):
    i = F.concat(F.lit("k_"), F.col("doc_id").cast("string"))
    u = F.concat(_pick(("https://docs.google.com/document/d/", "https://docs.google.com/spreadsheets/d/e/", "https://docs.google.com/presentation/d/", "https://drive.google.com/file/d/", "https://a.example/"), F.col("doc_id")), i, F.lit("/edit"))
    return _docs(spark, d).select("doc_id", U.export_url(u).alias("export"), U.repair_scheme(F.concat(F.lit("http:/b.example/"), i)).alias("repaired"))


def _verdicts(spark, d):
    lab = table(spark, d, "labels").where("doc_id is not null")
    rows = lab.select((F.col("doc_id") % 400).alias("question_id"), F.when(F.coalesce("quality", F.lit(0)) >= 4, "truth").otherwise("candidate").alias("kind"), F.when(F.col("toxic") == 1, "INCORRECT").when(F.col("quality") == 2, "no").otherwise("yes, it is").alias("verdict"))
    a, b = T.retained(rows), T.retained(rows, require_all_incorrect=False)
    return a.join(b.withColumnRenamed("retain", "retain_any"), "question_id")


def _packages(spark, d):
    tools = F.when(F.col("doc_id") % 5 != 0, F.array(F.lit("t")))
    verify = F.when(F.col("doc_id") % 7 != 0, "def verify(x): return x")
    return _docs(spark, d).select("doc_id", T.package_problem(tools, F.concat(F.when(F.col("doc_id") % 11 == 0, "sudo ").otherwise(""), F.coalesce("text", F.lit(""))), verify).alias("problem"))


def _ranked(spark, d):
    lab = table(spark, d, "labels").where("doc_id is not null")
    one = lab.groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    rows = one.select(F.col("doc_id").alias("seq"), (F.col("q") / 5).cast("string").alias("correctness"), F.when(F.col("t") == 1, "high").otherwise("0.5").alias("complexity"), F.lit(None).cast("string").alias("diversity"), F.lit("7").alias("solution_verifiability"))
    return T.ranked(rows).select("seq", F.round("composite", 6).alias("composite"), "rank")


SOLUTIONS = (
    ("def solve(tools):\n    return tools.find(q=1)", ""),
    ("def solve(tools):\n    import math\n    return tools['find'](math.floor(2.5))", ""),
    ("from .re import x\ndef solve(tools):\n    return tools.find()", "import"),
    ("import os\ndef solve(tools):\n    return tools.find()", "import"),
    ("def help():\n    pass\ndef solve(tools):\n    return tools.find()", "other function"),
    ("def solve(tools):\n    return db.rows + tools.find()", "database"),
    ("def solve(tools):\n    return print(tools.find())", "unsafe"),
    ("def solve(tools):\n    answer = str(tools.find())\n    return answer", "answer"),
    ("def solve(tools):\n    return tools.submit_result()", "answer"),
    ("def solve(tools):\n    return len([1])", "no tool call"),
    ("class A:\n    pass\ndef solve(tools):\n    return tools.find()", "class"),
    ("def solve(tools:", "syntax"),
    ("x = 1", "solve"),
    (" ", "empty"),
)
VERIFIERS = (("def verify(a):\n    return a > 1", ""), ("def verify(a):\n    return True", "constant"), ("def check(a):\n    return a", "verify"), ("def verify(a):\n    pass", "no return"), (None, "empty"))


def _checked_code(spark, d):
    r = _docs(spark, d).select("doc_id", _pick([x for x, _ in SOLUTIONS], F.col("doc_id")).alias("s"), _pick([x for x, _ in VERIFIERS], F.col("doc_id")).alias("v"))
    return T.checked_code(r, "s", "v", "doc_id").select("doc_id", "solution_reason", "verification_reason")


QUERIES = {
    "checked_code": _checked_code, "answer_checks": _answer_checks, "verifications": _verifications, "trivial_code": _trivial, "job_numbers": _numbers, "kept_parents": _parents, "task_uuids": _uuids, "record_counts": _record_counts, "file_skeletons": _skeletons,
    "compact_json": _compact, "tool_prefixes": _tool_texts, "forced_engines": _engines, "text_budgets": _budgets, "source_lists": _sources, "paged_texts": _paged, "document_texts": _document_texts, "code_blocks": _code_blocks,
    "json_texts": _json_texts, "wiki_texts": _wiki, "export_urls": _export_urls, "retained_questions": _verdicts, "package_problems": _packages, "ranked_packages": _ranked,
}

_D = "d AS (SELECT * FROM documents WHERE doc_id IS NOT NULL)"


def _case(results, c="doc_id"):
    q = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return f"(CASE {c} % {len(results)} " + " ".join(f"WHEN {i} THEN {q(r)}" for i, r in enumerate(results)) + " END)"


_JS = "'{\"id\": ' || doc_id || '}'"
_SC = lambda x: f"least(1.0, greatest(0.0, {x}))"
SQL = {
    "checked_code": f"WITH {_D} SELECT doc_id, {_case([x for _, x in SOLUTIONS])} AS solution_reason, {_case([x for _, x in VERIFIERS])} AS verification_reason FROM d",
    "answer_checks": f"WITH {_D} SELECT doc_id, {_case((False, False, False, False, False, True, False, True, True, True, True))} AS has_content, {_case(('a,b,c', 'z', 'j,k', '', '', ''))} AS fields, {_case(('r', 'q', 'd', 'x', REPORTS[4], '5', REPORTS[6]))} AS answer, {_case((None, 'pr_category', 'issue_description_reasonable', 'requires_gpu', 'json'))} AS problem FROM d",
    "verifications": f"WITH {_D} SELECT doc_id, {_case((1, 0, 1, 0, 1, 0, None, None))} AS verified, {_case((None, None, 0.5, None, 0.25, None, None, 1.5))}::DOUBLE AS score, {_case((None, None, 'fine', 'bad', 'note', 'why', None, None))} AS message FROM d",
    "trivial_code": f"WITH {_D} SELECT doc_id, {_case((True, True, False, True, False, False, False))} AS solution, {_case((False, False, False, False, True, True, False))} AS verifier FROM d",
    "job_numbers": "WITH e AS (SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events) SELECT event_id, least(pow(2.0, k % 9), 60.0) AS wait, CASE WHEN k <= 25 THEN 10 ELSE 10 + ceil((k - 25) * 0.3::DOUBLE) END::BIGINT AS priority, least(greatest(1, k - 5), 20) AS clamped FROM e",
    "kept_parents": "WITH l AS (SELECT l_partkey, count(*) AS n, avg(l_quantity) * 40 AS m FROM lineitem GROUP BY 1), j AS (SELECT p_partkey, floor(p_retailprice) AS v, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM part LEFT JOIN l ON p_partkey = l_partkey) SELECT p_partkey, n = 0 OR v < 500 OR n < 30 OR m >= v * 0.8 OR (v > 0 AND (v - m) / v < 0.2) AS keeps FROM j",
    "record_counts": "SELECT l_orderkey, (count(*) + sum(l_linenumber))::INT AS n FROM lineitem GROUP BY l_orderkey",
    "file_skeletons": f"""WITH {_D} SELECT doc_id, '[{{' || array_to_string(list_filter([CASE WHEN doc_kind IS NOT NULL THEN '"title":"' || doc_kind || '"' END, CASE WHEN text IS NOT NULL THEN '"text":"str"' END, CASE WHEN doc_id % 2 = 0 THEN '"bullets":"list[str]"' END], lambda x: x IS NOT NULL), ',') || '}}]' AS skeleton FROM d""",
    "tool_prefixes": rf"""WITH {_D}, u AS (SELECT doc_id, source_url AS url FROM d WHERE source_url IS NOT NULL),
w AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)), ':\d*$', ''), '^www\.', '') AS host, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
 list_filter(regexp_split_to_array(regexp_replace(string_split(url, '/')[-1], '(.)\.[^.]*$', '\1'), '[^a-zA-Z0-9]+'), lambda x: x <> '') AS w FROM u),
p AS (SELECT *, lower(array_to_string(CASE WHEN len(w) > 4 THEN list_concat(w[1:3], w[-1:]) ELSE w END, '_')) AS n, len(list_filter(string_split(path, '/'), lambda s: s <> '' AND s <> 'index.php' AND s <> 'index.html')) AS depth FROM w)
SELECT doc_id, CASE WHEN n = '' THEN 'data' WHEN regexp_matches(n, '^\d') THEN 'data_' || n ELSE n END AS prefix, depth::INT AS depth, depth::INT + 3 AS deepest, CASE WHEN ends_with(lower(path), '.pdf') THEN 'pdf' WHEN regexp_matches(host, '(^|\.)github\.com$') THEN 'github' WHEN regexp_matches(host, '(^|\.)(example|test)$') THEN 'research' END AS category FROM p""",
    "forced_engines": rf"WITH {_D}, h AS (SELECT doc_id, regexp_replace(lower(regexp_extract(source_url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^@/?#]*@)?([^/?#:]*)', 1)), '^www\.', '') AS host FROM d WHERE source_url IS NOT NULL) SELECT doc_id, CASE WHEN ends_with(host, '.example') THEN 'wild' WHEN regexp_matches(host, '(^|\.)test$') THEN 'plain' WHEN ends_with(host, '.invalid') THEN 'none' END AS engine FROM h",
    "text_budgets": f"WITH {_D} SELECT doc_id, CASE WHEN length(text) // 4 > 100 THEN 300 ELSE length(text) END AS n_trimmed, length(text) > 20 AS context, text || 'x' AS text FROM d WHERE text IS NOT NULL",
    "source_lists": f"""WITH {_D}, n AS (SELECT doc_id % 50 AS g, doc_id, CASE WHEN doc_id % 3 <> 0 THEN doc_kind END AS title, source_url, source, row_number() OVER (PARTITION BY doc_id % 50 ORDER BY doc_id) AS i FROM d),
s AS (SELECT g, string_agg('Source [' || i || ']:' || chr(10) || 'Title: ' || title || chr(10) || 'URL: ' || coalesce(source_url, 'No URL') || chr(10) || 'Summary: ' || coalesce(source, 'No Summary') || chr(10), '' ORDER BY i) FILTER (WHERE coalesce(title, '') <> '') AS b FROM n GROUP BY g)
SELECT g, CASE WHEN b IS NULL THEN 'Empty search results' || chr(10) ELSE 'Here are the search results/documents:' || chr(10) || chr(10) || b END AS sources FROM s""",
    "paged_texts": f"WITH {_D} SELECT doc_id, 2 AS n_pages, doc_kind AS second, length(text) + length(doc_kind) + 6 AS n_chars FROM d WHERE text IS NOT NULL AND doc_kind IS NOT NULL",
    "document_texts": "SELECT page_id, max(markdown || chr(10) || '- - - - - Page metadata - - - - -' || chr(10) || 'a: ' || substring(coalesce(meta_title, 'undefined'), 1, 250) || chr(10) || 'b: ' || substring(markdown, 1, 250)) AS document FROM pages WHERE page_id IS NOT NULL AND markdown IS NOT NULL GROUP BY page_id",
    "code_blocks": f"WITH {_D} SELECT doc_id, 'x = ' || doc_id || '|y' AS blocks, doc_kind AS boxed, length('say' || 'x = ' || doc_id || 'and' || 'y' || '\\boxed{{ ' || doc_kind || ' }} \\boxed{{no}}') + 9 AS n FROM d WHERE doc_kind IS NOT NULL",
    "json_texts": f"WITH {_D} SELECT doc_id, {_JS} AS json, {_JS} AS inner, CASE WHEN doc_id % 2 = 0 THEN '```json' || chr(10) || {_JS} || chr(10) || '```' ELSE 'md' END AS markdown FROM d",
    "wiki_texts": f"WITH {_D} SELECT doc_id, 'Town of ' || doc_kind || ' & more lies here.' || chr(10) || chr(10) || 'Next <5>' AS text FROM d WHERE doc_kind IS NOT NULL",
    "export_urls": f"WITH {_D}, k AS (SELECT doc_id, 'k_' || doc_id AS k FROM d) SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'https://docs.google.com/document/d/' || k || '/export?format=pdf' WHEN 2 THEN 'https://docs.google.com/presentation/d/' || k || '/export?format=pdf' WHEN 3 THEN 'https://drive.google.com/uc?export=download&id=' || k END AS export, 'http://b.example/' || k AS repaired FROM k",
    "retained_questions": """WITH r AS (SELECT doc_id % 400 AS question_id, coalesce(quality, 0) >= 4 AS truth, CASE WHEN toxic = 1 THEN true WHEN quality = 2 THEN false ELSE true END AS correct FROM labels WHERE doc_id IS NOT NULL),
g AS (SELECT question_id, coalesce(bool_or(correct) FILTER (WHERE truth), false) AS t, count(*) FILTER (WHERE NOT truth) AS n, coalesce(bool_and(NOT correct) FILTER (WHERE NOT truth), true) AS every, coalesce(bool_or(NOT correct) FILTER (WHERE NOT truth), false) AS anyone FROM r GROUP BY 1)
SELECT question_id, t AND (n = 0 OR every) AS retain, t AND (n = 0 OR n < 3 OR anyone) AS retain_any FROM g""",
    "package_problems": rf"WITH {_D}, t AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'sudo ' ELSE '' END || coalesce(text, '') AS c FROM d) SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'verification' WHEN regexp_matches(c, '(?i)\b(?:rm -rf|sudo|shutdown|mkfs)\b') THEN 'not runnable' WHEN len(list_filter(regexp_split_to_array(trim(c), '\s+'), lambda w: w <> '')) < 8 THEN 'too short' WHEN doc_id % 5 = 0 THEN 'no tools' END AS problem FROM t",
    "ranked_packages": f"WITH o AS (SELECT doc_id AS seq, max(quality) AS q, max(toxic) AS t FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id), c AS (SELECT seq, round(0.4 * {_SC('coalesce(q / 5.0, 0.6)')} + 0.25 * CASE WHEN t = 1 THEN 0 ELSE 0.5 END + 0.2 * 0.6 + 0.15, 6) AS composite FROM o) SELECT seq, composite, row_number() OVER (ORDER BY composite DESC, seq) AS rank FROM c",
}
