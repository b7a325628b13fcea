"""Answers, verdicts and schemas that come as JSON text, and small scores of jobs and entities, as Column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WRAPPERS = ("result", "data", "answer", "content")  # fixed values
PASS_KEYS = ("passed", "success", "ok", "result")
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"  # the namespace of the uuid standard for names of hosts
COMPACTIONS = ((6, 200), (4, 120), (2, 80), (1, 60))  # list items and signs that are kept, step by step
#: Fixed patterns of code that only seems to solve or to verify.
TRIVIAL_SOLUTION = (r"return\s+list\(tools\.keys\(\)\)", r"return\s+tools\.keys\(\)", r"return\s+\[.*tools", r"return\s+tools")
TRIVIAL_VERIFIER = (r"return\s+isinstance\(answer,\s*list\)", r"return\s+True")


def json_kind(text: Column) -> Column:
    """object, array, string, number, boolean, null; NULL for text that is no JSON."""
    t = F.regexp_replace(text, r"^\s+|\s+$", "")
    sign = F.substring(t, 1, 1)
    kind = F.when(sign == "{", "object").when(sign == "[", "array").when(sign == '"', "string").when(t.isin("true", "false"), "boolean").when(t == "null", "null").otherwise("number")
    return F.when(F.try_parse_json(t).isNotNull() & (t != ""), kind)


def has_content(answer: Column) -> Column:
    """An answer (JSON text) that is not null, and neither are it or what its first filled wrapper key holds empty or blank."""
    a = F.regexp_replace(answer, r"^\s+|\s+$", "")
    inner = F.coalesce(*(F.when(json_kind(a) == "object", F.get_json_object(a, f"$.{k}")) for k in WRAPPERS), a)
    bare = F.regexp_replace(inner, r"\s", "")
    return F.coalesce((a != "null") & ~bare.isin("", "{}", "[]", '""'), F.lit(False))


def expected_fields(schema: Column) -> Column:
    """Sorted fields that a result's form asks for: properties and required of a schema, or the keys of a list's first item."""
    none = F.array().cast("array<string>")
    keys = F.coalesce(F.json_object_keys(F.get_json_object(schema, "$.properties")), none)
    required = F.coalesce(F.from_json(F.get_json_object(schema, "$.required"), "array<string>"), none)
    kind = json_kind(schema)
    out = F.when(kind == "object", F.array_union(keys, required)).when(kind == "array", F.coalesce(F.json_object_keys(F.get_json_object(schema, "$[0]")), none))
    return F.array_sort(F.coalesce(out, none))


def verification(output: Column) -> Column:
    """struct(verified, score, message) of a verifier's output: a boolean, an object, or a list (verified, score or message, details, message)."""
    kind = json_kind(output)
    first = F.coalesce(*(F.get_json_object(output, f"$.{k}") for k in PASS_KEYS))
    truth = F.when(first.isNull(), F.lit(None).cast("boolean")).otherwise(~F.lower(first).isin("false", "0", "0.0", "", "[]", "{}"))
    item = lambda i: F.get_json_object(output, f"$[{i}]")
    number = lambda c: c.try_cast("double")
    verified = F.when(kind == "boolean", F.regexp_replace(output, r"\s", "") == "true").when(kind == "object", truth).when(kind == "array", F.when(item(0).isin("true", "false"), item(0) == "true"))
    score = F.when(kind == "object", number(F.get_json_object(output, "$.score"))).when(kind == "array", number(item(1)))
    said = F.when(number(item(1)).isNull() & item(1).isNotNull(), item(1)).otherwise(item(3))
    message = F.when(kind == "object", F.coalesce(F.get_json_object(output, "$.message"), F.get_json_object(output, "$.error"))).when(kind == "array", said)
    return F.struct(verified.alias("verified"), score.alias("score"), message.alias("message"))


def unwrapped(value: Column) -> Column:
    """What a submission's report (an object with status or message) wraps: saved_data (or its result), result, submitted_data or data; else the value."""
    at = lambda k: F.get_json_object(value, f"$.{k}")
    report = (json_kind(value) == "object") & (at("status").isNotNull() | at("message").isNotNull())
    return F.when(report, F.coalesce(at("saved_data.result"), at("saved_data"), at("result"), at("submitted_data"), at("data"), value)).otherwise(value)


def skeleton(sections: Column) -> Column:
    """Sections (title, text, bullets) with the kinds of their parts in place of the content."""
    kind = lambda c, name: F.when(c.isNotNull(), F.lit(name))
    return F.transform(sections, lambda s: F.struct(s["title"].alias("title"), kind(s["text"], "str").alias("text"), kind(s["bullets"], "list[str]").alias("bullets")))


def name_uuid(name: Column, namespace: str = DNS_NAMESPACE) -> Column:
    """The version 5 uuid of a name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    part = lambda a, n: F.substring(h, a, n)
    digit = F.lower(F.hex((F.conv(part(17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), digit, part(18, 3), F.lit("-"), part(21, 12))


def record_count(context: Column, candidates: Column) -> Column:
    """Records of a context and of all its candidates' contexts."""
    own = lambda c: F.coalesce(F.size(c), F.lit(0))
    return own(context) + F.aggregate(F.coalesce(candidates, F.array().cast("array<array<string>>")), F.lit(0), lambda n, c: n + own(c))


def compact_json(most: int = 4000):
    """A function of JSON text: as it is where short enough, else with ever shorter lists and strings, else only a mark."""

    def shorten(v, items: int, signs: int):
        if isinstance(v, dict):
            return {k: shorten(x, items, signs) for k, x in v.items()}
        if isinstance(v, list):
            return [shorten(x, items, signs) for x in v[:items]]
        return v[:signs] + "..." if isinstance(v, str) and len(v) > signs else v

    def one(text: str | None) -> str:
        try:
            value = json.loads(text) if text is not None else {}
        except ValueError:
            return "{}"
        for step in (None, *COMPACTIONS):
            out = json.dumps(value if step is None else shorten(value, *step), ensure_ascii=False)
            if len(out) <= most:
                return out
        return json.dumps({"truncated": True})

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(one)

    return run


def backoff(attempt: Column, base: float = 1.0, factor: float = 2.0, most: float = 60.0) -> Column:
    """Seconds to wait before an attempt (0 first), without the random part of up to a quarter."""
    return F.least(F.lit(base) * F.pow(F.lit(factor), attempt), F.lit(most))


def job_priority(held: Column, base: Column, bucket: int = 25, modifier: float = 1.0) -> Column:
    """A job's priority: base while its owner holds no more than the bucket, then later with every job beyond it."""
    return F.when(held <= bucket, base).otherwise(F.ceil(base + F.ceil((held - bucket) * F.lit(modifier)))).cast("bigint")


def clamped(value: Column, most: int) -> Column:
    return F.least(F.greatest(F.lit(1), value), F.lit(most))


def keeps_parent(parent_views: Column, n_children: Column, child_mean: Column, asked: int) -> Column:
    """Whether an entity stays beside its children: little viewed, too few of them, or they are hardly less viewed."""
    views = F.coalesce(parent_views, F.lit(0))
    small = (views > 0) & ((views - child_mean) / views < 0.2)
    return (n_children == 0) | (views < 500) | (n_children < asked * 0.5) | (child_mean >= views * 0.8) | small


def is_trivial(code: Column, patterns: tuple[str, ...] = TRIVIAL_SOLUTION) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | code.rlike(p)
    return out


def annotation_problem(text: Column) -> Column:
    """NULL for a valid annotation of a pull request (JSON), else the first field that is missing or has no valid value."""
    at = lambda k: F.get_json_object(text, f"$.{k}")
    out = F.when(json_kind(text).isNull() | (json_kind(text) != "object"), F.lit("json"))
    for k, values in (("pr_category", ("bug_fix", "feature_request")), ("issue_difficulty", ("easy", "medium", "hard"))):
        out = out.when(at(k).isNull() | ~at(k).isin(*values), k)
    for k in ("issue_description_reasonable", "gold_patch_solves_issue", "test_patch_designed_for_issue", "requires_gpu"):
        # a boolean, not the text of one
        out = out.when(at(k).isNull() | ~text.rlike(rf'"{k}"\s*:\s*(?:true|false)\b'), k)
    return out
