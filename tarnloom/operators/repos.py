"""Repositories, pull requests, their files, logs and runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BYTES_A_LINE = 45
#: Endings of languages, in the order in which ties are decided; marks of test files.
LANGUAGES = ((".py", "python"), (".js", "javascript"), (".ts", "typescript"), (".java", "java"), (".go", "go"), (".rs", "rust"))
TEST_MARKS = ("tests", "test", "pytest.ini", "conftest.py", "tox.ini", "setup.cfg")


def valid_pulls(pulls: DataFrame) -> DataFrame:
    """Merged pull requests that resolve an issue. pulls: merged_at, resolved_issues."""
    return pulls.where(F.col("merged_at").isNotNull() & (F.coalesce(F.size("resolved_issues"), F.lit(0)) >= 1))


def valid_instances(rows: DataFrame) -> DataFrame:
    """Instances with a patch, a problem statement and a test patch that is not blank."""
    return rows.where((F.coalesce("patch", F.lit("")) != "") & (F.coalesce("problem_statement", F.lit("")) != "") & (F.trim(F.coalesce("test_patch", F.lit(""))) != ""))


def kept_repos(repos: DataFrame, exclude: Sequence[str] = (), keywords: Sequence[str] = (), topics: Sequence[str] = (), least: int | None = None, most: int | None = None) -> DataFrame:
    """Repositories that no rule excludes. repos: full_name, name, description, topics, bytes (NULL passes the size rule).

    exclude: full names, whatever their case; keywords: parts of name, description or a topic; topics: whole topics.
    """
    said = F.lower(F.concat_ws(" ", "name", "description", F.array_join("topics", " ")))
    own = F.transform(F.coalesce("topics", F.array().cast("array<string>")), F.lower)
    lines = F.floor(F.col("bytes") / BYTES_A_LINE)
    rules = [F.lower("full_name").isin(*(x.lower() for x in exclude)) if exclude else F.lit(False)]
    rules += [F.contains(said, F.lit(k.lower())) for k in keywords] + [F.array_contains(own, t.lower()) for t in topics]
    rules += [lines < least] * (least is not None) + [lines > most] * (most is not None)
    return repos.where(~F.coalesce(reduce(lambda a, b: a | b, (F.coalesce(r, F.lit(False)) for r in rules)), F.lit(False)))


def with_existing_files(records: DataFrame, files: DataFrame, key: str = "id") -> DataFrame:
    """Records with at least one file that exists, their list cut to those, in order. records: key, files (array); files: path."""
    each = records.select(key, F.posexplode("files").alias("at", "path"))
    there = each.join(files.select("path").distinct(), "path", "left_semi").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "path"))), lambda x: x["path"]).alias("files"))
    return records.drop("files").join(there, key)


def repo_shapes(files: DataFrame) -> DataFrame:
    """Per repo: whether it has tests, a main package, how many files, Python files and its main language. files: repo, path."""
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    top = F.lower(F.element_at(F.split("path", "/"), 1))
    test = reduce(lambda a, b: a | b, (F.array_contains(F.split(F.lower("path"), "/"), m) for m in TEST_MARKS)) | name.rlike(r"^test_.*\.py$") | name.rlike(r"_test\.py$")
    package = (top == F.lower(F.element_at(F.split("repo", "/"), -1))) & F.contains("path", F.lit("/"))
    counts = [F.count_if(F.endswith(F.lower("path"), F.lit(e))).alias(n) for e, n in LANGUAGES]
    g = files.groupBy("repo").agg(F.bool_or(test).alias("has_tests"), F.bool_or(package).alias("has_package"), F.count("*").alias("n_files"), *counts)
    best = F.array_max(F.array(*(F.struct(F.col(n).alias("n"), F.lit(-i).alias("i"), F.lit(n).alias("name")) for i, (_, n) in enumerate(LANGUAGES))))
    return g.select("repo", "has_tests", "has_package", "n_files", F.col("python").alias("n_python"), F.when(best["n"] > 0, best["name"]).otherwise("unknown").alias("language"))


def crawl_totals(pulls: DataFrame) -> DataFrame:
    """Per repo and, under '*', in all: pulls, merged, with issues, valid. pulls: repo, merged_at, resolved_issues."""
    merged, linked = F.col("merged_at").isNotNull(), F.coalesce(F.size("resolved_issues"), F.lit(0)) >= 1
    g = pulls.rollup("repo").agg(F.grouping("repo").alias("_all"), F.count("*").alias("pulls"), F.count_if(merged).alias("merged"), F.count_if(linked).alias("linked"), F.count_if(merged & linked).alias("valid"))
    return g.select(F.when(F.col("_all") == 1, "*").otherwise(F.coalesce("repo", F.lit("-"))).alias("repo"), "pulls", "merged", "linked", "valid")


def outcome_counts(rows: DataFrame, outcome: str, outcomes: Sequence[str]) -> DataFrame:
    """total, and one count for each named outcome: one row."""
    return rows.agg(F.count("*").alias("total"), *(F.count_if(F.col(outcome) == o).alias(o) for o in outcomes))


def merged_selftests(tests: DataFrame, key: str = "tool") -> DataFrame:
    """Per tool: whether any test passed, and the fields that its tests met. tests: key, ok, fields."""
    return tests.groupBy(key).agg(F.coalesce(F.bool_or("ok"), F.lit(False)).alias("ok"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("fields")))).alias("fields"))


def snapshot_hash(files: DataFrame, key: str = "repo") -> DataFrame:
    """Per repo one hash of its paths and their contents' hashes, whatever the order. files: repo, path, sha."""
    entries = F.array_sort(F.collect_set(F.struct("path", "sha")))
    return files.groupBy(key).agg(F.sha2(F.to_json(F.map_from_entries(entries)), 256).alias("snapshot"))


def snapshot_changes(before: DataFrame, after: DataFrame, key: str = "repo") -> DataFrame:
    """repo, path, change (new, changed, removed) between two states of files (repo, path, sha)."""
    a, b = before.select(key, "path", F.col("sha").alias("a")), after.select(key, "path", F.col("sha").alias("b"))
    j = a.join(b, [key, "path"], "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return j.select(key, "path", F.when(F.col("a").isNull(), "new").when(F.col("b").isNull(), "removed").otherwise("changed").alias("change"))


def problem_statements(issues: DataFrame, comments: DataFrame, key: str = "pull") -> DataFrame:
    """Per pull: title and body of its issues, and its comments as hints, each in order. issues: pull, number, title, body; comments: pull, at, text."""
    text = F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")), F.lit("\n"))
    joined = lambda rows, order, what: F.transform(F.array_sort(F.collect_list(F.struct(*order, what.alias("x")))), lambda r: r["x"])
    p = issues.groupBy(key).agg(F.array_join(joined(issues, ["number"], text), "").alias("problem_statement"))
    h = comments.where("text is not null").groupBy(key).agg(F.array_join(joined(comments, ["at"], F.col("text")), "\n").alias("hints"))
    return p.join(h, key, "left").withColumn("hints", F.coalesce("hints", F.lit("")))


def run_costs(steps: DataFrame, key: str = "task") -> DataFrame:
    """Per task: elapsed seconds, tokens and cost. steps: task, started_at, ended_at, tokens, cost; NULLs count as nothing."""
    elapsed = F.unix_micros(F.max("ended_at").cast("timestamp")) - F.unix_micros(F.min("started_at").cast("timestamp"))
    return steps.groupBy(key).agg((elapsed / 1e6).alias("elapsed"), F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"), F.round(F.sum(F.coalesce("cost", F.lit(0.0))), 6).alias("cost"))


def files_of_tools(tools: DataFrame, files: DataFrame, least: int = 2) -> DataFrame:
    """tool, path: data files that a tool's name (get_… or list_…) stands for. tools: tool; files: path, prefix.

    The prefix is the name, or one contains the other and they share at least two tokens. The longer one is cut into
    those of its substrings that share as many tokens with it, and these are looked up among the shorter ones: every
    pair that meets is a result, however many strings have tokens in common.
    """
    named = tools.select("tool", F.regexp_extract("tool", r"^(?:get|list)_(.+)$", 1).alias("name")).where("name != ''").distinct()
    data = files.select("path", "prefix").distinct()
    names, prefixes = named.select("name").distinct(), data.where("prefix is not null").select("prefix").distinct()
    shared = lambda x, y: F.size(F.array_intersect(F.split(x, "_"), F.split(y, "_")))

    def within(short: DataFrame, a: str, long: DataFrame, b: str) -> DataFrame:
        rest = F.expr(f"substring({b}, start)")
        whole = F.split(rest, "_")  # tokens shared by what starts here: whole ones, and one that may be cut at its end
        spread = long.repartition(int(long.sparkSession.conf.get("spark.sql.shuffle.partitions")))  # few bytes, much work: in turn, which is neither dropped nor coalesced
        starts = spread.select(b, F.explode(F.expr(f"sequence(1, length({b}))")).alias("start"))
        starts = starts.where(F.size(F.array_intersect(F.slice(whole, 1, F.size(whole) - 1), F.split(b, "_"))) >= least - 1)
        ends = F.transform(F.sequence(F.lit(0), F.length(rest)), lambda n: F.substring(F.col(b), F.col("start"), n))
        parts = starts.where(F.length(rest) > 0).select(b, F.explode(F.transform(F.filter(ends, lambda x: shared(x, F.col(b)) >= least), lambda x: F.xxhash64(x))).alias("h")).distinct()
        return short.select(a, F.xxhash64(a).alias("h")).join(parts, "h").where(F.contains(b, a) & (shared(F.col(a), F.col(b)) >= least)).select("name", "prefix")

    least = max(least, 1)
    equal = names.join(prefixes, F.col("name") == F.col("prefix"))
    alike = within(names, "name", prefixes, "prefix").unionAll(within(prefixes, "prefix", names, "name")).unionAll(equal).distinct()
    return alike.join(named, "name").join(data, "prefix").select("tool", "path")


def numbered(text: Column, most: int) -> Column:
    """Lines with right-aligned numbers; of more than `most`, the first and last halves around a line that tells how many are left out."""
    lines = F.split(text, "\n")
    n = F.size(lines)
    width = F.length(n.cast("string"))
    full = F.transform(lines, lambda x, i: F.concat(F.lpad((i + 1).cast("string"), width, F.lit(" ")), F.lit("   "), x))
    head, tail = most // 2, most - most // 2
    gap = F.concat(F.repeat(F.lit(" "), width), F.lit("   [..., "), (n - most).cast("string"), F.lit(" lines omitted ...]"))
    return F.when(n <= most, F.array_join(full, "\n")).otherwise(F.array_join(F.concat(F.slice(full, 1, head), F.array(gap), F.slice(full, n - tail + 1, F.lit(tail))), "\n"))


def merged_research(updates: DataFrame, key: str, appended: Sequence[str], replaced: Sequence[str], order: str = "at") -> DataFrame:
    """State of each research after its partial updates in order: lists grow, the last value of the others that is not NULL stays."""
    lists = [F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("x"))))), lambda r: r["x"])).alias(c) for c in appended]
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(order, c))).alias(c) for c in replaced]
    return updates.groupBy(key).agg(*lists, *last, F.max(order).alias("updated"))


#: Fixed forms in which dependency files name a package, by the file's name.
_REQUIREMENT = r"(?m)^\s*([A-Za-z0-9][A-Za-z0-9._-]*)\s*(?:\[[^\]]*\])?\s*(?:[<>=!~;@].*)?$"
_QUOTED = r"[\"']([A-Za-z0-9][A-Za-z0-9._-]*)\s*(?:\[[^\]]*\])?\s*(?:[<>=!~;][^\"']*)?[\"']"


def dependencies(path: Column, content: Column) -> Column:
    """Sorted distinct packages that a dependency file names: requirements, setup.py, pyproject, conda and package.json files."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    every = lambda text, pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    bare = F.regexp_replace(content, r"(?m)\s*#.*$", "")
    block = F.regexp_extract(content, r"(?s)(?:install_requires|dependencies)\s*=\s*\[(.*?)\]", 1)
    conda = F.regexp_extract(bare, r"(?s)dependencies:\s*\n(.*)", 1)
    parts = F.concat(F.json_object_keys(F.get_json_object(content, "$.dependencies")), F.coalesce(F.json_object_keys(F.get_json_object(content, "$.devDependencies")), F.array().cast("array<string>")))
    found = (
        F.when(name.rlike(r"^requirements.*\.txt$"), every(bare, _REQUIREMENT))
        .when(name.isin("setup.py", "pyproject.toml"), every(block, _QUOTED))
        .when(name.isin("environment.yml", "environment.yaml", "conda.yml"), every(conda, r"(?m)^\s*-\s*([A-Za-z0-9][A-Za-z0-9._-]*)"))
        .when(name == "package.json", parts)
    )
    return F.array_sort(F.array_distinct(F.coalesce(found, F.array().cast("array<string>"))))
