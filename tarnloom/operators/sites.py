"""Addresses against lists of sites, and JSON columns against each other."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions import urls as U

MAX_LIST = 100_000  # entries of a site list that may be broadcast; a longer one is joined by shuffle


def _site_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))


def matched_sites(rows: DataFrame, sites: DataFrame, url: str = "url", key: str = "id") -> DataFrame:
    """rows with the first listed site (by position) that is the host or a parent domain of it; NULL where none.

    The suffix match is an equality on the host's exploded suffixes, not a comparison with every entry. sites: site,
    position, label.
    """
    listed = sites.select(F.lower("site").alias("site"), "position", "label")
    if listed.limit(MAX_LIST + 1).count() <= MAX_LIST:
        listed = F.broadcast(listed)
    suffixes = rows.select(key, F.explode(_site_suffixes(U.plain_host(F.col(url)))).alias("site")).distinct()
    best = suffixes.join(listed, "site").groupBy(key).agg(F.min(F.struct("position", "site", "label")).alias("m"))
    return rows.join(best, key, "left").select(*rows.columns, F.col("m.site").alias("site"), F.col("m.label").alias("label"))


def category(url: Column, sites: Sequence[str] = ()) -> Column:
    """pdf, github, research (a listed site or its subdomain) or NULL, the first that fits."""
    p = F.lower(U.path(url))
    h = U.plain_host(url)
    listed = F.lit(False)
    for s in sites:
        listed = listed | (h == s) | F.endswith(h, F.lit("." + s))
    return F.when(F.endswith(p, F.lit(".pdf")), "pdf").when((h == "github.com") | F.endswith(h, F.lit(".github.com")), "github").when(listed, "research")


def blocked(rows: DataFrame, blocklist: DataFrame, url: str = "url", key: str = "id", allowed: Sequence[str] = ()) -> DataFrame:
    """rows with `blocked`: an allowed keyword clears; a listed domain, a subdomain of it or its name under another suffix blocks."""
    base = lambda h: F.element_at(F.split(U.registrable_domain(h), r"\."), 1)
    names = blocklist.select(F.lower("domain").alias("domain")).distinct()
    hosts = rows.select(key, U.plain_host(F.col(url)).alias("host")).distinct()
    exact = hosts.select(key, F.explode(_site_suffixes(F.col("host"))).alias("domain")).join(names, "domain", "left_semi").select(key)
    alike = hosts.select(key, base(F.col("host")).alias("name")).join(names.select(base(F.col("domain")).alias("name")).distinct(), "name", "left_semi").select(key)
    hit = exact.unionAll(alike).distinct().withColumn("_hit", F.lit(True))
    free = F.lit(False)
    for word in allowed:
        free = free | F.contains(F.lower(F.col(url)), F.lit(word.lower()))
    return rows.join(hit, key, "left").withColumn("blocked", F.coalesce(F.col("_hit") & ~free, F.lit(False))).drop("_hit")


def forced_engine(rows: DataFrame, patterns: Sequence[tuple[str, str]], url: str = "url") -> DataFrame:
    """rows with the engine of the first pattern (exact host, *.suffix or plain suffix) that fits; a short driver-side list."""
    h = U.plain_host(F.col(url))
    out = F.lit(None).cast("string")
    for pattern, engine in reversed(list(patterns)):
        s = pattern.lower().removeprefix("*.")
        fits = F.endswith(h, F.lit("." + s)) if pattern.startswith("*.") else (h == s) | F.endswith(h, F.lit("." + s))
        out = F.when(fits, F.lit(engine)).otherwise(out)
    return rows.withColumn("engine", out)


def supported_engines(engines: DataFrame, wanted: dict[str, int]) -> DataFrame:
    """engine, score, quality of engines that support features worth at least half of what is wanted, best first.

    engines: engine, quality, features array<string>. Engines of quality 0 or less count only where no other is left.
    """
    total = sum(wanted.values())
    score = F.lit(0)
    for f, priority in wanted.items():
        score = score + F.when(F.array_contains("features", f), priority).otherwise(0)
    fit = engines.withColumn("score", score).where(F.col("score") >= total // 2)
    good = fit.agg(F.bool_or(F.col("quality") > 0).alias("good"))  # one row
    kept = fit.crossJoin(F.broadcast(good)).where((F.col("quality") > 0) | ~F.coalesce("good", F.lit(False)))
    return kept.orderBy(F.desc("score"), F.desc("quality"), "engine").select("engine", "score", "quality")


def json_changes(rows: DataFrame, previous: str, current: str, key: str) -> DataFrame:
    """key, field, previous, current: fields of two JSON objects whose values differ; NULL where a side lacks one."""
    as_map = lambda c: F.coalesce(F.from_json(F.col(c), "map<string,string>"), F.from_json(F.lit("{}"), "map<string,string>"))
    a, b = as_map(previous), as_map(current)
    both = rows.select(key, a.alias("_a"), b.alias("_b"))
    fields = both.select(key, "_a", "_b", F.explode(F.array_union(F.map_keys("_a"), F.map_keys("_b"))).alias("field"))
    out = fields.select(key, "field", F.col("_a")[F.col("field")].alias("previous"), F.col("_b")[F.col("field")].alias("current"))
    return out.where(~F.col("previous").eqNullSafe(F.col("current")))


def profile(rows: DataFrame, text: str, key: str) -> DataFrame:
    """key, kind (list, object, other) and sorted keys of a JSON column: of an object's own, or of a list's first item."""
    t = F.ltrim(F.col(text))
    first = F.get_json_object(F.col(text), "$[0]")
    kind = F.when(F.try_parse_json(F.col(text)).isNull(), "other").when(t.startswith("["), "list").when(t.startswith("{"), "object").otherwise("other")
    keys = F.when(kind == "object", F.json_object_keys(F.col(text))).when(kind == "list", F.json_object_keys(first))
    return rows.select(key, kind.alias("kind"), F.array_sort(F.coalesce(keys, F.array().cast("array<string>"))).alias("keys"))


def line_changes(before: str | None, after: str | None) -> list[tuple[str, int | None, int | None, str]]:
    """(kind, line before, line after, text) of a line diff: add, del and normal lines."""
    a, b = (before or "").splitlines(), (after or "").splitlines()
    out: list[tuple[str, int | None, int | None, str]] = []
    for op, i0, i1, j0, j1 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if op == "equal":
            out += [("normal", i + 1, j + 1, a[i]) for i, j in zip(range(i0, i1), range(j0, j1))]
        else:
            out += [("del", i + 1, None, a[i]) for i in range(i0, i1)] + [("add", None, j + 1, b[j]) for j in range(j0, j1)]
    return out


def expanded_entities(parents: DataFrame, children: DataFrame, k: int, least_words: int = 100) -> DataFrame:
    """One round of expansion: per parent the k least viewed children with enough words, of each name the least viewed.

    children: parent, name, pageview, text.
    """
    name = F.lower(F.trim("name"))
    enough = children.where(F.size(F.split(F.trim("text"), r"\s+")) > least_words).withColumn("_n", name).withColumn("pageview", F.coalesce("pageview", F.lit(0)))
    one = enough.groupBy("parent", "_n").agg(F.min_by(F.struct("name", "pageview"), F.struct("pageview", "name")).alias("c")).select("parent", "_n", "c.*")
    w = Window.partitionBy("parent").orderBy("pageview", "_n")
    picked = one.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    return picked.join(parents.select(F.col("name").alias("parent")).distinct(), "parent", "left_semi").select("parent", "name", "pageview", "place")
