"""Link filters of a crawl, site maps, robots rules and the frontier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions import urls as U
from tarnloom.session import materialize


@dataclass(frozen=True)
class LinkOptions:
    base_url: str
    max_depth: int = 10
    includes: Sequence[str] = field(default_factory=tuple)
    excludes: Sequence[str] = field(default_factory=tuple)
    regex_on_full_url: bool = False
    allow_backward: bool = False
    allow_external: bool = False
    allow_subdomains: bool = False
    limit: int | None = None


def denial_reason(link: Column, o: LinkOptions, robots_allowed: Column | None = None) -> Column:
    """NULL for a link that is kept, else the first rule of the cascade that denies it."""
    base = F.lit(o.base_url)
    target = link if o.regex_on_full_url else U.path(link)
    excluded = F.lit(False)
    for p in o.excludes:
        excluded = excluded | target.rlike(p)
    included = F.lit(not o.includes)
    for p in o.includes:
        included = included | target.rlike(p)
    internal = U.is_internal(link, base)
    backward = F.lit(not o.allow_backward) & ~F.startswith(U.path(link), U.path(base))
    robots = F.lit(True) if robots_allowed is None else F.coalesce(robots_allowed, F.lit(True))
    inside = (
        F.when(U.has_section(link), "SECTION")
        .when(backward, "BACKWARD")
        .when(excluded, "EXCLUDE")
        .when(~included, "INCLUDE")
        .when(~robots, "ROBOTS")
    )
    outside = (
        F.when(U.is_social_or_mail(link), "SOCIAL")
        .when(excluded, "EXCLUDE")
        .when(F.lit(o.allow_external) & ~U.is_external_main_page(link), F.lit(None).cast("string"))
        .when(F.lit(o.allow_subdomains) & U.is_subdomain(link, base), F.when(~included, "INCLUDE"))
        .otherwise("EXTERNAL")
    )
    return (
        F.when(link.isNull() | ~U.scheme(link).isin("http", "https") | (U.host(link) == ""), F.when(F.coalesce(U.is_non_web(link), F.lit(False)), "PROTOCOL").otherwise("PARSE"))
        .when(U.depth(link) > o.max_depth, "DEPTH")
        .when(U.is_file(U.path(link)), "FILE")
        .when(internal, inside)
        .otherwise(outside)
    )


def filter_links(links: DataFrame, o: LinkOptions, link: str = "link", seq: str = "seq") -> DataFrame:
    """All links with denial_reason; kept ones beyond the limit (in the order of seq) are denied with LIMIT.

    The limit is a global order: only the kept links' least `limit` seq values are ranked, by a top-k, never by one
    sorted partition of all links.
    """
    marked = links.withColumn("denial_reason", denial_reason(F.col(link), o))
    if o.limit is None:
        return marked
    last = marked.where("denial_reason is null").orderBy(seq).limit(o.limit).agg(F.max(seq).alias("last"))
    late = F.col("denial_reason").isNull() & (F.col(seq) > F.col("last"))
    return marked.crossJoin(F.broadcast(last)).withColumn("denial_reason", F.when(late, "LIMIT").otherwise(F.col("denial_reason"))).drop("last")  # one row


def sitemap_action(loc: Column) -> Column:
    """recurse into nested site maps, drop files, process pages."""
    p = F.lower(U.path(loc))
    return F.when(p.rlike(r"\.xml(?:\.gz)?$"), "recurse").when(U.is_file(p, fold_case=True), "drop").otherwise("process")


def sitemap_locations(maps: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per <loc> of a site map or site-map index, whatever its namespace: all columns, loc, action."""
    found = F.expr(f"xpath({xml}, '//*[local-name()=\"loc\"]/text()')")
    rows = maps.withColumn("loc", F.explode(F.transform(found, lambda x: F.trim(x))))
    return rows.withColumn("action", sitemap_action(F.col("loc")))


def parse_robots(robots: DataFrame, host: str = "host", text: str = "robots_txt", agents: Sequence[str] = ("*",)) -> DataFrame:
    """host, allow, pattern rows of the groups for the given agents (case folded)."""
    names = [a.lower() for a in agents]
    lines = robots.select(host, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("no", "raw"))
    clean = F.trim(F.regexp_replace("raw", r"#.*$", ""))
    kv = lines.select(host, "no", F.lower(F.trim(F.regexp_extract(clean, r"^([^:]+):", 1))).alias("k"), F.trim(F.regexp_extract(clean, r"^[^:]+:(.*)$", 1)).alias("v")).where("k in ('user-agent', 'allow', 'disallow')")
    w = Window.partitionBy(host).orderBy("no")
    is_agent = F.col("k") == "user-agent"
    start = is_agent & ~F.coalesce(F.lag(is_agent).over(w), F.lit(False))
    grouped = kv.withColumn("group", F.sum(start.cast("int")).over(w))
    agents_of = grouped.where(is_agent).where(F.lower("v").isin(*names)).select(host, "group").distinct()
    rules = grouped.where(~is_agent & (F.col("v") != "")).join(agents_of, [host, "group"])
    return rules.select(host, (F.col("k") == "allow").alias("allow"), F.col("v").alias("pattern"))


def robots_allowed(links: DataFrame, rules: DataFrame, link: str = "link") -> DataFrame:
    """links with `allowed`: the longest matching rule decides, allow before disallow at equal length; none allows."""
    keyed = links.withColumn("host", U.host(F.col(link)))
    target = F.concat(U.path(F.col(link)), U.query(F.col(link)))
    escaped = F.regexp_replace("pattern", r"([.+?^{}()|\[\]\\])", r"\\$1")
    rx = F.concat(F.lit("^"), F.regexp_replace(escaped, r"\*", ".*"))
    ids = keyed.withColumn("_t", target)
    per_link = ids.select(link, "host", "_t").distinct()
    hit = per_link.join(rules.withColumn("_rx", rx), "host").where(F.expr("regexp_like(_t, _rx)"))
    best = hit.groupBy(link).agg(F.max_by("allow", F.struct(F.length("pattern"), F.col("allow"))).alias("allowed"))
    return keyed.drop("host").join(best, link, "left").withColumn("allowed", F.coalesce("allowed", F.lit(True)))


def crawl_frontier(edges: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """Breadth-first visits: node, depth of each node reached from the seeds within max_depth.

    edges (src, dst); seeds (node). Every level is a join with the edges and an anti-join with what was visited, written
    to the shared folder; nothing is gathered on the driver.
    """
    visited = materialize(seeds.where("node is not null").select("node").distinct().withColumn("depth", F.lit(0)), "frontier")
    level = visited
    for d in range(1, max_depth + 1):
        step = level.join(edges, level["node"] == edges["src"]).select(F.col("dst").alias("node")).where("node is not null").distinct()
        level = materialize(step.join(visited, "node", "left_anti").withColumn("depth", F.lit(d)), "frontier")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
    return visited


def sitemap_walk(maps: DataFrame, roots: DataFrame, limit: int = 25, max_depth: int = 10) -> DataFrame:
    """Pages reached from root site maps through nested ones: each crawl reads each map once and at most `limit` maps in all.

    maps (url, xml); roots (url, and crawl where there are several). Maps are read level by level, in the order in
    which they stand. Returns crawl (if given), map_url, loc of pages to process.
    """
    seeds = roots.select(F.col("crawl") if "crawl" in roots.columns else F.lit("").alias("crawl"), F.col("url").alias("map_url")).where("map_url is not null").distinct()
    found = sitemap_locations(maps.select("url", "xml"))
    locs = materialize(found.select(F.col("url").alias("map_url"), "loc", "action", F.monotonically_increasing_id().alias("at")), "sitemap")
    nested = locs.where("action = 'recurse'").groupBy("map_url", "loc").agg(F.min("at").alias("at"))
    order = Window.partitionBy("crawl").orderBy("place", "at", "map_url")
    hit = materialize(seeds.withColumn("place", F.row_number().over(Window.partitionBy("crawl").orderBy("map_url"))).where(F.col("place") <= limit), "sitemap")
    level = hit
    for _ in range(max_depth):
        step = level.join(nested, "map_url").select("crawl", F.col("loc").alias("map_url"), "place", "at").groupBy("crawl", "map_url").agg(F.min(F.struct("place", "at")).alias("m")).select("crawl", "map_url", "m.*")
        fresh = step.join(hit.select("crawl", "map_url"), ["crawl", "map_url"], "left_anti")
        used = hit.groupBy("crawl").agg(F.count("*").alias("used"))
        placed = fresh.join(used, "crawl").withColumn("place", F.row_number().over(order) + F.col("used")).where(F.col("place") <= limit)
        level = materialize(placed.select("crawl", "map_url", F.col("place").cast("int").alias("place")), "sitemap")
        if level.isEmpty():
            break
        hit = hit.unionByName(level)
    out = locs.where("action = 'process'").join(hit.select("crawl", "map_url"), "map_url").select("crawl", "map_url", "loc").distinct()
    return out if "crawl" in roots.columns else out.drop("crawl")
