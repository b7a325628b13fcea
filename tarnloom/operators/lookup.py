"""Assembling maps of a site, looking pages up by address levels, and joining jobs and search results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions import urls as U

MAX_MAP = 100_000  # addresses of one site's map, whatever limit is asked for
NO_PAGES = (".xml", ".json", ".txt", ".rss", ".atom", ".pdf", ".zip", ".gz")  # fixed values


def of_site(url: Column, base_url: str, subdomains: bool = True, by_path: bool = False) -> Column:
    """Whether an address belongs to the site of base_url: the same domain; the same host without subdomains; under its path."""
    base = F.lit(base_url)
    keep = U.same_last_labels(url, base)
    if not subdomains:
        keep = keep & U.same_subdomain(url, base)
    if by_path:
        keep = keep & ((F.length(U.path(base)) <= 1) | F.startswith(U.path(url), U.path(base)))
    return keep


def ordered_union(parts: Sequence[DataFrame], key: str, position: str) -> DataFrame:
    """Rows of several tables one behind the other, the first row of each key: key, source (number of the table), position."""
    rows = reduce(DataFrame.unionAll, (p.select(key, F.lit(i).alias("source"), F.col(position).alias("position")) for i, p in enumerate(parts)))
    first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("source", "position")).alias("_m"))
    return first.select(key, "_m.source", "_m.position")


def merged_addresses(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per url: the place of the first, the first title that is not NULL. rows: url, title and the columns of `order`."""
    place = F.struct(*order)
    titled = F.min(F.when(F.col("title").isNotNull(), F.struct(*order, "title")))
    return rows.groupBy("url").agg(F.min(place).alias("_p"), titled["title"].alias("title")).select("url", *(F.col(f"_p.{c}").alias(c) for c in order), "title")


def map_assembly(index: DataFrame, sitemap: DataFrame, search: DataFrame, base_url: str, limit: int = 5000, search_first: bool = False, drop_query: bool = True, subdomains: bool = True, by_path: bool = True) -> DataFrame:
    """url, place, title of a site's map: what the index, the site map and a search hold of it, in this order.

    Each table has position, url, title. The sources are put one behind the other (the search first where there is a
    query), cut to the limit, brought to one spelling, filtered to the site and merged by address. What is ranked is
    bounded by the limit, itself at most MAX_MAP.
    """
    order = [search, index, sitemap] if search_first else [index, sitemap, search]
    rows = reduce(DataFrame.unionAll, (p.select(F.lit(i).alias("source"), "position", "url", "title") for i, p in enumerate(order)))
    cut = rows.orderBy("source", "position", "url").limit(min(MAX_MAP, limit))
    kept = cut.withColumn("url", U.checked(F.col("url"), drop_query)).where(F.col("url").isNotNull() & of_site(F.col("url"), base_url, subdomains, by_path))
    merged = merged_addresses(kept, ["source", "position"])
    place = F.row_number().over(Window.orderBy("source", "position", "url"))  # at most `limit` rows
    return merged.select("url", place.alias("place"), "title")


def at_level(index: DataFrame, url: str, newer_than: Column, limit: int, domain: bool = False) -> DataFrame:
    """resolved_url of indexed pages under an address (or, by its host, under a domain), newer than a time; at most limit, in order.

    index: url, resolved_url, created_at. A page is under the address if its own split of that level has the same hash.
    """
    of = (lambda c: U.domain_splits(U.plain_host(c))) if domain else (lambda c: U.url_splits(F.regexp_replace(c, r"\?[^#]*", "")))
    wanted = of(F.lit(url))
    level = F.size(wanted)
    same = U.hash_key(F.try_element_at(of(F.col("url")), level)) == U.hash_key(F.element_at(wanted, level))
    return index.where(same & (F.col("created_at") >= newer_than)).select("resolved_url").distinct().orderBy("resolved_url").limit(limit)


def job_records(ids: DataFrame, queue: DataFrame, scrapes: DataFrame, blobs: DataFrame) -> DataFrame:
    """id, status, value, options, created_at, failed_reason of jobs known to the queue or to the table of scrapes.

    The scrape's outcome decides the status, the queue's row the options, time and reason, the blob the value. queue:
    id, status, value, options, created_at, failed_reason; scrapes: id, success, options, created_at, error; blobs: id, value.
    """
    q = queue.select("id", F.struct("status", "value", "options", "created_at", "failed_reason").alias("q"))
    s = scrapes.select("id", F.struct("success", "options", "created_at", "error").alias("s"))
    b = blobs.select("id", F.col("value").alias("b"))
    j = ids.select("id").distinct().join(q, "id", "left").join(s, "id", "left").join(b, "id", "left").where("q is not null or s is not null")
    queued = F.col("q").isNotNull()
    status = F.when(F.col("s").isNotNull(), F.when(F.col("s.success"), "completed").otherwise("failed")).otherwise(F.col("q.status"))
    either = lambda mine, other: F.when(queued, F.col(f"q.{mine}")).otherwise(F.col(f"s.{other}"))
    reason = either("failed_reason", "error")
    return j.select("id", status.alias("status"), F.coalesce("b", "q.value").alias("value"), either("options", "options").alias("options"), either("created_at", "created_at").alias("created_at"), F.when(reason != "", reason).alias("failed_reason"))


def reranked(scores: DataFrame, documents: DataFrame, threshold: float = 0.6) -> DataFrame:
    """documents (url, …) whose score (url, score, reason) exceeds the threshold, best first."""
    return documents.join(scores.where(F.col("score") > threshold), "url").orderBy(F.desc("score"), "url")


def clean_results(results: DataFrame, seq: str = "seq", group: str | None = None) -> DataFrame:
    """Search results with an http address, trimmed, the first of each address whatever its case (per group)."""
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    keep = [group] if group else []
    rows = results.select(*keep, seq, t("title").alias("title"), t("url").alias("url"), t("summary").alias("summary")).where(F.col("url").rlike("^https?://"))
    first = F.min_by(F.struct("title", "url", "summary"), F.struct(seq, "url", "title", "summary"))
    return rows.groupBy(*keep, F.lower("url").alias("_k")).agg(F.min(seq).alias(seq), first.alias("_r")).select(*keep, seq, "_r.*")


def limit_per(rows: DataFrame, kind: str, order: Sequence[Column | str], limit: int) -> DataFrame:
    """At most `limit` rows of each kind, in order."""
    w = Window.partitionBy(kind).orderBy(*order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def distinct_queries(queries: DataFrame, text: str, seq: str, most: int = 10) -> DataFrame:
    """The first `most` queries that differ in more than case and blanks around them."""
    first = queries.where(F.trim(text) != "").groupBy(F.lower(F.trim(text)).alias("_k")).agg(F.min(F.struct(seq, text)).alias("r"))
    return first.select("r.*").orderBy(seq).limit(most)


def locked_urls(requests: DataFrame, visited: DataFrame, limit: int, crawl: str = "crawl", url: str = "url", seq: str = "seq") -> DataFrame:
    """Requests that a crawl may visit: the first of each key it has not visited, up to `limit` keys a crawl with those visited.

    visited: crawl, key. Only keys are counted per crawl, after copies have gone.
    """
    keyed = requests.where(F.col(url).isNotNull()).groupBy(crawl, U.crawl_key(F.col(url)).alias("key")).agg(F.min(F.struct(seq, url)).alias("r"))
    fresh = keyed.join(visited.select(crawl, "key").distinct(), [crawl, "key"], "left_anti").select(crawl, "key", "r.*")
    held = visited.select(crawl, "key").distinct().groupBy(crawl).agg(F.count("*").alias("held"))
    place = F.row_number().over(Window.partitionBy(crawl).orderBy(seq, "key"))
    return fresh.join(held, crawl, "left").withColumn("place", place + F.coalesce("held", F.lit(0))).where(F.col("place") <= limit).drop("held")


def unseen(rows: DataFrame, seen: DataFrame, key: str, order: Sequence[str], limit: int) -> DataFrame:
    """The first `limit` rows whose key was not seen before."""
    return rows.join(seen.select(key).distinct(), key, "left_anti").orderBy(*order).limit(limit)


def crawl_errors(jobs: DataFrame, skipped: Sequence[str]) -> DataFrame:
    """id, code, message of failed jobs with a reason, but for the skipped codes. jobs: id, status, failed_reason.

    A reason in JSON has its code and message; any other is a message.
    """
    code = F.get_json_object("failed_reason", "$.code")
    rows = jobs.where("status = 'failed' and failed_reason is not null").withColumn("code", code)
    return rows.where(F.col("code").isNull() | ~F.col("code").isin(*skipped)).select("id", "code", F.coalesce(F.get_json_object("failed_reason", "$.message"), "failed_reason").alias("message"))


def share_of(key: Column, seed: str = "") -> Column:
    """A number in [0, 1) drawn from a key: the same in every run and on every machine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1, 8), 16, 10).cast("double") / float(1 << 32)


def stable_sample(rows: DataFrame, key: str, rate: float = 0.1, seed: str = "") -> DataFrame:
    """Each row with probability `rate`, decided by its key alone. A sampling operator: what it leaves out is its purpose."""
    return rows.where(share_of(F.col(key), seed) < rate)


def sampled_pages(rows: DataFrame, url: str, n: int = 10, seed: str = "") -> DataFrame:
    """n addresses that are pages by their ending, drawn without replacement."""
    path = F.lower(U.path(F.col(url)))
    page = reduce(lambda a, b: a & b, (~F.endswith(path, F.lit(e)) for e in NO_PAGES))
    return rows.where(page).select(url).distinct().orderBy(F.md5(F.concat(F.lit(seed), url)), url).limit(n)


def followed(rows: DataFrame, page_size: int, max_pages: int | None = None, max_results: int | None = None, order: Sequence[str] = ("seq",)) -> DataFrame:
    """What a reader gets that follows pages of a listing until it has max_pages pages or max_results rows."""
    most = [m for m in (max_results, None if max_pages is None else max_pages * page_size) if m is not None]
    ordered = rows.orderBy(*order)
    return ordered.limit(min(most)) if most else ordered
