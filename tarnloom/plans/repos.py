"""Queries of repositories, pull requests and runs; their inputs are drawn from the tables of texts, parts and order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.functions import text as X
from tarnloom.operators import history as H
from tarnloom.operators import repos as R
from tarnloom.tables import table

_EXT = (".py", ".js", ".ts", ".java", ".go", ".rs", ".md", "_test.py")


def _hex(c, at=1):
    return F.conv(F.substring(F.md5(c), at, 1), 16, 10).cast("int")


def _pulls(spark, d):
    """Pull requests: the problem statements among the documents."""
    t = table(spark, d, "documents").where("doc_kind = 'pr_problem' and doc_id is not null")
    issues = F.when(F.col("doc_id") % 3 == 0, F.array()).otherwise(F.array(F.col("doc_id").cast("string"))).cast("array<string>")
    return t.select("doc_id", F.coalesce("source", F.lit("none")).alias("repo"), "text", F.when(F.col("doc_id") % 4 != 0, F.col("collected_at")).alias("merged_at"), issues.alias("resolved_issues"))


def _valid_pulls(spark, d):
    return R.valid_pulls(_pulls(spark, d)).select("doc_id")


def _valid_instances(spark, d):
    rows = _pulls(spark, d).select("doc_id", F.when(F.col("doc_id") % 5 != 0, "x").alias("patch"), F.col("text").alias("problem_statement"), F.when(F.col("doc_id") % 7 == 0, "  ").otherwise("t").alias("test_patch"))
    return R.valid_instances(rows).select("doc_id")


def _kept_repos(spark, d):
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.concat(F.col("p_brand"), F.lit("/"), F.col("p_name")).alias("full_name"), F.col("p_name").alias("name"), F.col("p_type").alias("description"), F.array("p_brand").alias("topics"), F.when(F.col("p_partkey") % 9 != 0, (F.col("p_retailprice") * 100).cast("bigint")).alias("bytes"))
    return R.kept_repos(p, ["Brand#11/small"], ["steel"], ["brand#13"], 2000, 3500).select("id")


def _files(spark, d):
    """Files of repositories: one for each order line."""
    n = F.col("l_linenumber")
    li = table(spark, d, "lineitem")
    ext = F.element_at(F.array(*map(F.lit, _EXT)), (F.col("l_partkey") % len(_EXT) + 1).cast("int"))
    folder = F.when(n == 1, F.concat(F.lit("s"), F.col("l_suppkey"))).when(n == 2, "Tests").otherwise("src")
    return li.select(F.concat(F.lit("o/s"), F.col("l_suppkey")).alias("repo"), F.concat(folder, F.lit("/f"), F.col("l_partkey"), ext).alias("path"), n.alias("n"), F.sha2(F.col("l_quantity").cast("int").cast("string"), 256).alias("sha"), "l_orderkey").where("l_suppkey is not null")


def _existing_files(spark, d):
    f = _files(spark, d)
    lists = f.groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("path")).alias("files"))
    return R.with_existing_files(lists, f.where("n = 2")).select("id", F.array_join("files", ",").alias("files"))


def _shapes(spark, d):
    return R.repo_shapes(_files(spark, d).where("l_orderkey % 3 = 0").select("repo", "path").distinct())


def _crawl_totals(spark, d):
    return R.crawl_totals(_pulls(spark, d))


def _outcomes(spark, d):
    lab = table(spark, d, "labels").select(F.when(F.col("quality").isNull(), "skipped").when(F.col("toxic") == 1, "failed").otherwise("annotated").alias("outcome"))
    return R.outcome_counts(lab, "outcome", ["annotated", "failed", "skipped"])


def _task_counts(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null").groupBy("job_id").agg(F.max(F.col("status") == "completed").alias("done"))
    return R.outcome_counts(q.select(F.when(F.col("done"), "submitted").otherwise("open").alias("outcome")), "outcome", ["submitted"])


def _selftests(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("tool"), (F.col("value") > 50).alias("ok"), F.json_object_keys("props").alias("fields"))
    return R.merged_selftests(e).select("tool", "ok", F.array_join("fields", ",").alias("fields"))


def _last_state(files):
    return files.groupBy("repo", "path").agg(F.max(F.struct("l_orderkey", "n", "sha"))["sha"].alias("sha"))


def _snapshots(spark, d):
    f = _last_state(_files(spark, d))
    return R.snapshot_hash(f)


def _snapshot_changes(spark, d):
    f = _files(spark, d)
    return R.snapshot_changes(_last_state(f.where("n < 4")), _last_state(f.where("n > 2"))).groupBy("repo", "change").agg(F.count("*").alias("n"), F.min("path").alias("first"))


def _problems(spark, d):
    li = table(spark, d, "lineitem")
    issues = li.select(F.col("l_orderkey").alias("pull"), F.col("l_linenumber").alias("number"), F.concat(F.lit("part "), F.col("l_partkey")).alias("title"), F.when(F.col("l_linenumber") % 2 == 1, F.col("l_returnflag")).alias("body"))
    comments = li.select(F.col("l_orderkey").alias("pull"), F.struct("l_shipdate", "l_linenumber").alias("at"), F.when(F.col("l_linestatus") == "O", F.concat(F.lit("ships "), F.col("l_suppkey"))).alias("text"))
    return R.problem_statements(issues, comments)


def _costs(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("task"), F.col("ts").alias("started_at"), F.col("ts").alias("ended_at"), F.get_json_object("props", "$.k").cast("bigint").alias("tokens"), F.col("value").alias("cost"))
    return R.run_costs(e).select("task", F.round("elapsed", 3).alias("elapsed"), "tokens", F.round("cost", 2).alias("cost"))


def _tool_files(spark, d):
    s = table(spark, d, "documents").where("source_url is not null and doc_id is not null").select(X.tool_prefix(F.col("source_url")).alias("prefix")).distinct()
    tools = table(spark, d, "part").select(F.concat(F.when(F.col("p_partkey") % 2 == 0, "get_").otherwise("list_"), F.lower(F.regexp_replace("p_name", r"[^A-Za-z0-9]+", "_"))).alias("tool")).distinct()
    more = s.select(F.concat(F.lit("get_"), F.regexp_replace("prefix", r"_\d+$", "")).alias("tool"))
    return R.files_of_tools(tools.unionAll(more), s.select(F.concat(F.lit("data/"), F.col("prefix")).alias("path"), "prefix")).groupBy("tool").agg(F.count("*").alias("n"), F.min("path").alias("first"))


def _numbered(spark, d):
    t = table(spark, d, "documents").where("doc_id is not null and text is not null")
    return t.select("doc_id", R.numbered(F.regexp_replace("text", "\r", ""), 6).alias("log"))


def _research(spark, d):
    e = table(spark, d, "events").select("user_id", F.struct("ts", "event_id").alias("at"), F.when(F.col("event_type") != "click", F.array("event_type")).alias("activities"), F.when(F.col("value") > 50, F.col("value")).alias("status"))
    return R.merged_research(e, "user_id", ["activities"], ["status"]).select("user_id", F.array_join("activities", ",").alias("activities"), F.round("status", 2).alias("status"), F.col("updated.event_id").alias("updated"))


def _requirements(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.lower(F.regexp_replace("p_name", r"[^A-Za-z0-9]+", "-")).alias("a"), F.lower(F.regexp_replace("p_type", r"[^A-Za-z0-9]+", "-")).alias("b"))
    kind = F.col("p_partkey") % 5
    path = F.element_at(F.array(*map(F.lit, ("requirements-dev.txt", "x/setup.py", "pyproject.toml", "environment.yml", "package.json"))), (kind + 1).cast("int"))
    text = (
        F.when(kind == 0, F.concat(F.lit("# needs\n"), F.col("a"), F.lit(">=1.2 # why\n\n"), F.col("b"), F.lit("[all]==3\n-r other.txt\n")))
        .when(kind == 1, F.concat(F.lit("setup(install_requires=['"), F.col("a"), F.lit(">=2', \""), F.col("b"), F.lit("\"], name='n')")))
        .when(kind == 2, F.concat(F.lit("dependencies = [\n \""), F.col("a"), F.lit("\",\n \""), F.col("b"), F.lit("~=1\",\n]\n")))
        .when(kind == 3, F.concat(F.lit("name: e\ndependencies:\n  - "), F.col("a"), F.lit("=1\n  - "), F.col("b"), F.lit("\n")))
        .otherwise(F.concat(F.lit('{"dependencies": {"'), F.col("a"), F.lit('": "1"}, "devDependencies": {"'), F.col("b"), F.lit('": "2"}}')))
    )
    return p.select("p_partkey", F.array_join(R.dependencies(path, text), ",").alias("names"))


def _crossing(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return H.take_while(e, "user_id", ["ts", "event_id"], F.col("event_type") != "purchase", with_crossing=True).select("user_id", "event_id")


def _diffs(spark, d):
    """Unified diffs made of order lines: a source file and, for some, a test file."""
    li = table(spark, d, "lineitem")
    part = lambda path: F.concat(F.lit("diff --git a/"), path, F.lit(" b/"), path, F.lit("\n--- a/"), path, F.lit("\n+++ b/"), path, F.lit("\n@@ -1 +1 @@\n-x\n+y\n"))
    src, test = F.concat(F.lit("src/f"), F.col("l_partkey"), F.lit(".py")), F.concat(F.lit("tests/t"), F.col("l_suppkey"), F.lit(".py"))
    return li.select("l_orderkey", "l_linenumber", F.concat(part(src), F.when(F.col("l_linenumber") % 2 == 0, part(test)).otherwise("")).alias("diff"))


def _patches(spark, d):
    p = _diffs(spark, d).select("l_orderkey", "l_linenumber", X.split_patch(F.col("diff")).alias("p"), F.array_join(X.changed_files(F.col("diff")), ",").alias("files"))
    return p.select("l_orderkey", "l_linenumber", F.length("p.fix").alias("fix"), F.length("p.test").alias("test"), "files")


def _issues(spark, d):
    t = table(spark, d, "documents").where("doc_id is not null and text is not null")
    said = F.concat(F.lit("Fixes #"), F.col("doc_id"), F.lit(", see <!-- closes #1 --> and RESOLVED #7; prefixes #9. "), F.col("text"))
    return t.select("doc_id", F.array_join(X.resolved_issues(said), ",").alias("issues"))


QUERIES = {
    "valid_pulls": _valid_pulls, "valid_instances": _valid_instances, "kept_repos": _kept_repos, "existing_files": _existing_files, "repo_shapes": _shapes, "pull_totals": _crawl_totals, "annotation_outcomes": _outcomes,
    "task_counts": _task_counts, "merged_selftests": _selftests, "snapshot_hashes": _snapshots, "snapshot_changes": _snapshot_changes, "problem_statements": _problems, "run_costs": _costs, "files_of_tools": _tool_files,
    "numbered_logs": _numbered, "merged_research": _research, "dependencies": _requirements, "take_while_crossing": _crossing, "split_patches": _patches, "resolved_issues": _issues,
}

_PR = "p AS (SELECT doc_id, coalesce(source, 'none') AS repo, text, doc_id % 4 <> 0 AND collected_at IS NOT NULL AS merged, doc_id % 3 <> 0 AS linked FROM documents WHERE doc_kind = 'pr_problem' AND doc_id IS NOT NULL)"
_EXTS = "['" + "', '".join(_EXT) + "']"
_F = f"f AS (SELECT 'o/s' || l_suppkey AS repo, CASE l_linenumber WHEN 1 THEN 's' || l_suppkey WHEN 2 THEN 'Tests' ELSE 'src' END || '/f' || l_partkey || {_EXTS}[l_partkey % {len(_EXT)} + 1] AS path, l_linenumber AS n, sha256(l_quantity::INT::VARCHAR) AS sha, l_orderkey FROM lineitem WHERE l_suppkey IS NOT NULL)"
_NAME = "lower(string_split(path, '/')[-1])"
_LAST = lambda where="": f"(SELECT repo, path, max((l_orderkey, n, sha))[3] AS sha FROM f {where} GROUP BY repo, path)"
_PREFIX_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(string_split(regexp_replace(source_url, '^data/', ''), '/')[-1], '(.)\.[^.]*$', '\1'), '[^a-zA-Z0-9]+'), lambda w: w <> '')"
_PREFIX = "CASE WHEN n = '' THEN 'data' WHEN regexp_matches(n, '^\\d') THEN 'data_' || n ELSE n END"

SQL = {
    "valid_pulls": f"WITH {_PR} SELECT doc_id FROM p WHERE merged AND linked",
    "valid_instances": f"WITH {_PR} SELECT doc_id FROM p WHERE doc_id % 5 <> 0 AND coalesce(text, '') <> '' AND doc_id % 7 <> 0",
    "kept_repos": "WITH p AS (SELECT *, (p_retailprice * 100)::DECIMAL(18, 6) AS b FROM part) SELECT p_partkey AS id FROM p WHERE lower(p_brand || '/' || p_name) <> 'brand#11/small' AND NOT contains(lower(concat_ws(' ', p_name, p_type, p_brand)), 'steel') AND lower(p_brand) <> 'brand#13' AND (p_partkey % 9 = 0 OR floor(trunc(b) / 45) BETWEEN 2000 AND 3500)",
    "existing_files": f"WITH {_F}, l AS (SELECT DISTINCT l_orderkey AS id, path FROM f), e AS (SELECT DISTINCT path FROM f WHERE n = 2) SELECT id, string_agg(path, ',' ORDER BY path) AS files FROM l SEMI JOIN e USING (path) GROUP BY id",
    "repo_shapes": rf"""WITH {_F}, u AS (SELECT DISTINCT repo, path FROM f WHERE l_orderkey % 3 = 0),
g AS (SELECT repo, bool_or(len(list_filter(string_split(lower(path), '/'), lambda s: s IN ('tests', 'test', 'pytest.ini', 'conftest.py', 'tox.ini', 'setup.cfg'))) > 0 OR regexp_matches({_NAME}, '^test_.*\.py$|_test\.py$')) AS has_tests,
 bool_or(lower(string_split(path, '/')[1]) = lower(string_split(repo, '/')[-1])) AS has_package, count(*) AS n_files, count(*) FILTER (WHERE ends_with(path, '.py')) AS py, count(*) FILTER (WHERE ends_with(path, '.js')) AS js, count(*) FILTER (WHERE ends_with(path, '.ts')) AS ts, count(*) FILTER (WHERE ends_with(path, '.java')) AS jv, count(*) FILTER (WHERE ends_with(path, '.go')) AS go, count(*) FILTER (WHERE ends_with(path, '.rs')) AS rs FROM u GROUP BY repo)
SELECT repo, has_tests, has_package, n_files, py AS n_python, CASE greatest(py, js, ts, jv, go, rs) WHEN 0 THEN 'unknown' WHEN py THEN 'python' WHEN js THEN 'javascript' WHEN ts THEN 'typescript' WHEN jv THEN 'java' WHEN go THEN 'go' ELSE 'rust' END AS language FROM g""",
    "pull_totals": f"WITH {_PR} SELECT coalesce(repo, '*') AS repo, count(*) AS pulls, count(*) FILTER (WHERE merged) AS merged, count(*) FILTER (WHERE linked) AS linked, count(*) FILTER (WHERE merged AND linked) AS valid FROM p GROUP BY ROLLUP (p.repo)",
    "annotation_outcomes": "SELECT count(*) AS total, count(*) FILTER (WHERE quality IS NOT NULL AND toxic IS DISTINCT FROM 1) AS annotated, count(*) FILTER (WHERE quality IS NOT NULL AND toxic = 1) AS failed, count(*) FILTER (WHERE quality IS NULL) AS skipped FROM labels",
    "task_counts": "SELECT count(DISTINCT job_id) AS total, count(DISTINCT job_id) FILTER (WHERE status = 'completed') AS submitted FROM queue_scrape WHERE job_id IS NOT NULL",
    "merged_selftests": "WITH e AS (SELECT event_type AS tool, value > 50 AS ok, unnest(json_keys(props)) AS k FROM events) SELECT tool, coalesce(bool_or(ok), false) AS ok, string_agg(DISTINCT k, ',' ORDER BY k) AS fields FROM e GROUP BY tool",
    "snapshot_hashes": f"""WITH {_F}, l AS {_LAST()} SELECT repo, sha256('{{' || string_agg('"' || path || '":"' || sha || '"', ',' ORDER BY path) || '}}') AS snapshot FROM l GROUP BY repo""",
    "snapshot_changes": f"""WITH {_F}, a AS {_LAST('WHERE n < 4')}, b AS {_LAST('WHERE n > 2')}, j AS (SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.path, b.path) AS path, a.sha AS x, b.sha AS y FROM a FULL JOIN b ON a.repo = b.repo AND a.path = b.path)
SELECT repo, CASE WHEN x IS NULL THEN 'new' WHEN y IS NULL THEN 'removed' ELSE 'changed' END AS change, count(*) AS n, min(path) AS first FROM j WHERE x IS DISTINCT FROM y GROUP BY ALL""",
    "problem_statements": "SELECT l_orderkey AS pull, string_agg('part ' || l_partkey || chr(10) || CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag ELSE '' END || chr(10), '' ORDER BY l_linenumber, 'part ' || l_partkey || chr(10) || CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag ELSE '' END || chr(10)) AS problem_statement, coalesce(string_agg('ships ' || l_suppkey, chr(10) ORDER BY l_shipdate, l_linenumber, 'ships ' || l_suppkey) FILTER (WHERE l_linestatus = 'O'), '') AS hints FROM lineitem GROUP BY l_orderkey",
    "run_costs": "SELECT user_id AS task, round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 3) AS elapsed, coalesce(sum(json_extract_string(props, '$.k')::BIGINT), 0)::BIGINT AS tokens, round(sum(coalesce(value, 0)), 2) AS cost FROM events GROUP BY user_id",
    "files_of_tools": rf"""WITH w AS (SELECT DISTINCT {_PREFIX_WORDS} AS w FROM documents WHERE source_url IS NOT NULL AND doc_id IS NOT NULL), j AS (SELECT lower(array_to_string(CASE WHEN len(w) > 4 THEN list_concat(w[1:3], w[-1:]) ELSE w END, '_')) AS n FROM w),
s AS (SELECT DISTINCT {_PREFIX} AS prefix FROM j),
t AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'get_' ELSE 'list_' END || lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g')) AS tool FROM part UNION SELECT 'get_' || regexp_replace(prefix, '_\d+$', '') FROM s),
n AS (SELECT tool, regexp_replace(tool, '^(get|list)_', '') AS name FROM t WHERE regexp_matches(tool, '^(get|list)_.')),
m AS (SELECT tool, prefix FROM n, s WHERE name = prefix OR ((contains(name, prefix) OR contains(prefix, name)) AND len(list_intersect(string_split(name, '_'), string_split(prefix, '_'))) >= 2))
SELECT tool, count(*) AS n, min('data/' || prefix) AS first FROM m GROUP BY tool""",
    "numbered_logs": """WITH t AS (SELECT doc_id, string_split(replace(text, chr(13), ''), chr(10)) AS x FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL), n AS (SELECT doc_id, x, len(x) AS n, length(len(x)::VARCHAR) AS w FROM t),
f AS (SELECT doc_id, n, w, list_transform(range(1, n + 1), lambda i: lpad(i::VARCHAR, w::INT, ' ') || '   ' || x[i]) AS f FROM n)
SELECT doc_id, CASE WHEN n <= 6 THEN array_to_string(f, chr(10)) ELSE array_to_string(list_concat(f[1:3], [repeat(' ', w) || '   [..., ' || (n - 6) || ' lines omitted ...]'], f[-3:]), chr(10)) END AS log FROM f""",
    "merged_research": "SELECT user_id, coalesce(string_agg(event_type, ',' ORDER BY ts, event_id) FILTER (WHERE event_type <> 'click'), '') AS activities, round(last(value ORDER BY ts, event_id) FILTER (WHERE value > 50), 2) AS status, last(event_id ORDER BY ts, event_id) AS updated FROM events GROUP BY user_id",
    "dependencies": "WITH p AS (SELECT p_partkey, lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '-', 'g')) AS a, lower(regexp_replace(p_type, '[^A-Za-z0-9]+', '-', 'g')) AS b FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct([a, b])), ',') AS names FROM p",
    "take_while_crossing": "WITH e AS (SELECT user_id, event_id, coalesce(sum((event_type = 'purchase')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events) SELECT user_id, event_id FROM e WHERE before = 0",
    "split_patches": """WITH d AS (SELECT l_orderkey, l_linenumber, 'src/f' || l_partkey || '.py' AS s, 'tests/t' || l_suppkey || '.py' AS t FROM lineitem)
SELECT l_orderkey, l_linenumber, 4 * length(s) + length('diff --git a/ b/' || '--- a/' || '+++ b/' || '@@ -1 +1 @@' || '-x' || '+y') + 6 AS fix, CASE WHEN l_linenumber % 2 = 0 THEN 4 * length(t) + length('diff --git a/ b/' || '--- a/' || '+++ b/' || '@@ -1 +1 @@' || '-x' || '+y') + 6 ELSE 0 END AS test, CASE WHEN l_linenumber % 2 = 0 THEN s || ',' || t ELSE s END AS files FROM d""",
    "resolved_issues": r"""WITH t AS (SELECT doc_id, regexp_replace(text, '(?s)<!--.*?-->', '', 'g') AS x FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat([doc_id::VARCHAR, '7'], regexp_extract_all(x, '(?i)\b(?:close|closes|closed|fix|fixes|fixed|resolve|resolves|resolved)\s+#(\d+)', 1)))), ',') AS issues FROM t""",
}
