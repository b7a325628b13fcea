"""Task records: validation, scoring, retention and assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions import codecheck
from tarnloom.operators.html import map_columns

WEIGHTS = {"correctness": 0.4, "complexity": 0.25, "diversity": 0.2, "solution_verifiability": 0.15}


def score(value: Column) -> Column:
    """A criterion: numbers and numeric text as they are, other text 0, NULL the default 0.6; within 0 and 1."""
    number = F.when(value.isNull(), F.lit(0.6)).otherwise(F.coalesce(value.try_cast("double"), F.lit(0.0)))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), number))


def composite(*, prefix: str = "", columns: dict[str, str] | None = None) -> Column:
    """Weighted sum of the criteria; columns names those that are held under another name."""
    total = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        total = total + score(F.col(prefix + (columns or {}).get(name, name))) * F.lit(weight)
    return F.round(total, 6)


def ranked(tasks: DataFrame, seq: str = "seq") -> DataFrame:
    """tasks with composite and rank 1..n (best first, then seq); exact ranks by counting equal scores, not by one sorted partition."""
    short = {n: n.removeprefix("solution_") for n in WEIGHTS if n not in tasks.columns}
    scored = tasks.withColumn("composite", composite(columns=short))
    levels = scored.groupBy("composite").agg(F.count("*").alias("n"))  # at most as many as distinct scores
    above = levels.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("composite")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    w = Window.partitionBy("composite").orderBy(seq)
    return scored.join(above, "composite").withColumn("rank", F.col("before") + F.row_number().over(w)).drop("before")


def retained(verdicts: DataFrame, require_all_incorrect: bool = True) -> DataFrame:
    """question_id, retain: the true answer must be correct; then no candidates, or all (any of three) incorrect.

    verdicts: question_id, kind (truth or candidate), verdict text; a verdict that contains YES or CORRECT counts as
    correct, INCORRECT included.
    """
    correct = F.upper("verdict").rlike("YES|CORRECT")
    g = verdicts.groupBy("question_id").agg(
        F.bool_or(F.when(F.col("kind") == "truth", correct)).alias("truth"),
        F.count_if(F.col("kind") == "candidate").alias("n"),
        F.bool_and(F.when(F.col("kind") == "candidate", ~correct)).alias("all_wrong"),
        F.bool_or(F.when(F.col("kind") == "candidate", ~correct)).alias("any_wrong"),
    )
    rest = F.coalesce("all_wrong", F.lit(True)) if require_all_incorrect else (F.col("n") < 3) | F.coalesce("any_wrong", F.lit(False))
    return g.select("question_id", (F.coalesce("truth", F.lit(False)) & ((F.col("n") == 0) | rest)).alias("retain"))


def package_problem(tools: Column, content: Column, verification: Column) -> Column:
    """NULL for a valid package, else its last failing rule."""
    return (
        F.when(~F.contains(F.coalesce(verification, F.lit("")), F.lit("verify")), "verification")
        .when(F.coalesce(content, F.lit("")).rlike(r"(?i)\b(?:rm -rf|sudo|shutdown|mkfs)\b"), "not runnable")
        .when(F.size(F.filter(F.split(F.trim(F.coalesce(content, F.lit(""))), r"\s+"), lambda w: w != "")) < 8, "too short")
        .when(F.coalesce(F.size(tools), F.lit(0)) <= 0, "no tools")
    )


def checked_code(rows: DataFrame, solution: str, verification: str, key: str) -> DataFrame:
    """key, solution_ok, solution_reason, verification_ok, verification_reason, tool_calls."""

    def check(s: str | None, v: str | None) -> tuple:
        return (*codecheck.check_solution(s), *codecheck.check_verifier(v), codecheck.tool_calls(s or ""))

    return map_columns(rows, check, [solution, verification], [key], "solution_ok boolean, solution_reason string, verification_ok boolean, verification_reason string, tool_calls array<string>")


def filtered_by_annotations(pulls: DataFrame, annotations: DataFrame, criteria: dict, require: bool = False, key: str = "instance_id", seq: str = "seq") -> DataFrame:
    """Pull requests that meet the criteria of their first annotation; those without one stay unless required.

    criteria: column → list (membership), bool (equality) or (least, most) with None for an open bound.
    """
    w = Window.partitionBy(key).orderBy(seq)
    first = annotations.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", seq).withColumn("_a", F.lit(True))
    j = pulls.join(first, key, "left")
    ok = F.lit(True)
    for name, want in criteria.items():
        if isinstance(want, bool):
            ok = ok & (F.col(name) == want)
        elif isinstance(want, tuple):
            least, most = want
            if least is not None:
                ok = ok & (F.col(name) >= least)
            if most is not None:
                ok = ok & (F.col(name) <= most)
        else:
            ok = ok & F.col(name).isin(*want)
    return j.where(F.when(F.col("_a").isNull(), F.lit(not require)).otherwise(F.coalesce(ok, F.lit(False)))).drop("_a")


def assembled(environment: DataFrame, tools: DataFrame, tasks: DataFrame, key: str = "env_id") -> DataFrame:
    """One JSON document per environment: distinct tools (the first of a name), tasks with a verifier and without an error."""
    w = Window.partitionBy(key, "name").orderBy("seq")
    one = tools.withColumn("_n", F.row_number().over(w)).where("_n = 1")
    t = one.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "name", "description"))), lambda x: F.struct(x["name"].alias("name"), x["description"].alias("description"))).alias("tools"))
    good = tasks.where(F.contains("verification", F.lit("def verify")) & F.col("error").isNull())
    k = good.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "title", "content"))), lambda x: F.struct(x["title"].alias("title"), x["content"].alias("content"))).alias("tasks"))
    doc = environment.join(t, key, "left").join(k, key, "left")
    body = F.struct(F.struct(*(F.col(c) for c in environment.columns)).alias("environment"), "tools", "tasks", F.struct(F.coalesce(F.size("tools"), F.lit(0)).alias("n_tools"), F.coalesce(F.size("tasks"), F.lit(0)).alias("n_tasks"), F.lit("1.2").alias("version")).alias("metadata"))
    return doc.select(key, F.to_json(body).alias("document"))
