"""Queries of maps, index lookups, job records and search results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.functions import urls as U
from tarnloom.operators import leases as Q
from tarnloom.operators import lookup as L
from tarnloom.plans import web as W
from tarnloom.tables import table

_ROOT = "https://www.example.org/"


def _pages(spark, d):
    return table(spark, d, "pages").where("url is not null and page_id is not null")


def _base(spark, d) -> str:
    """The address of the first page, whose site is asked for."""
    r = _pages(spark, d).orderBy("page_id", "url").select("url").first()  # one row
    return r["url"] if r else _ROOT


def _path_filter(spark, d):
    base = _base(spark, d)
    u = F.col("url")
    rows = _pages(spark, d).select("url").distinct()
    return rows.select("url", L.of_site(u, base).alias("same_site"), L.of_site(u, base, subdomains=False).alias("same_host"), L.of_site(u, base, by_path=True).alias("under_path"))


def _parts(spark, d):
    p = _pages(spark, d)
    index = p.where("meta_status_code = 200").select(F.col("page_id").alias("position"), "url", F.lit(None).cast("string").alias("title"))
    sitemap = p.where("meta_source_url is not null").select(F.col("page_id").alias("position"), F.col("meta_source_url").alias("url"), F.lit(None).cast("string").alias("title"))
    search = p.where("meta_title is not null").select(F.col("page_id").alias("position"), "url", F.col("meta_title").alias("title"))
    return index, sitemap, search


def _map_site(spark, d):
    return L.map_assembly(*_parts(spark, d), _base(spark, d), limit=100_000, by_path=False)


def _map_site_searched(spark, d):
    return L.map_assembly(*_parts(spark, d), _base(spark, d), limit=100_000, search_first=True, subdomains=False, by_path=False)


def _union_urls(spark, d):
    index, sitemap, search = _parts(spark, d)
    return L.ordered_union([search, index, sitemap], "url", "position")


def _at_level(spark, d):
    p = _pages(spark, d).select("url", F.coalesce("meta_source_url", "url").alias("resolved_url"), F.col("scraped_at").alias("created_at"))
    root = "https://" + W.site_root(_base(spark, d)).split("//")[1]
    return L.at_level(p, root, F.lit("2000-01-01").cast("timestamp_ntz"), 1_000_000)


def _at_domain(spark, d):
    p = _pages(spark, d).select("url", F.coalesce("meta_source_url", "url").alias("resolved_url"), F.col("scraped_at").alias("created_at"))
    return L.at_level(p, _base(spark, d), F.lit("2000-01-01").cast("timestamp_ntz"), 1_000_000, domain=True)


def _job_records(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null")
    one = q.groupBy("job_id").agg(F.max(F.struct("created_at", "status", F.coalesce("job_data", F.lit("")).alias("job_data"), F.coalesce("failed_reason", F.lit("")).alias("failed_reason"))).alias("r")).select("job_id", "r.*")
    odd = F.conv(F.substring(F.md5("job_id"), 1, 1), 16, 10).cast("int")  # which of the three stores knows a job is drawn from its id
    queue = one.where(odd < 12).select(F.col("job_id").alias("id"), "status", F.lit("queued value").alias("value"), F.col("job_data").alias("options"), "created_at", "failed_reason")
    scrapes = one.where(odd >= 8).select(F.col("job_id").alias("id"), (F.col("status") == "completed").alias("success"), F.upper("job_data").alias("options"), "created_at", F.col("failed_reason").alias("error"))
    blobs = one.where((odd % 3) == 0).select(F.col("job_id").alias("id"), F.col("job_id").alias("value"))
    ids = one.where(odd != 5).select(F.col("job_id").alias("id"))
    return L.job_records(ids, queue, scrapes, blobs)


def _reranked(spark, d):
    p = _pages(spark, d)
    docs = p.groupBy("url").agg(F.min("page_id").alias("page_id"))
    scores = docs.select("url", L.share_of(F.col("url")).alias("score"), F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("reason"))
    return L.reranked(scores, docs).select("url", "page_id", F.round("score", 6).alias("score"), "reason")


def _clean_results(spark, d):
    docs = table(spark, d, "documents").where("doc_id is not null")
    return L.clean_results(docs.select("doc_id", F.col("doc_kind").alias("title"), F.col("source_url").alias("url"), F.col("source").alias("summary")), "doc_id").select("doc_id", "url")


def _per_type(spark, d):
    docs = table(spark, d, "documents").where("doc_id is not null and source_url is not null")
    return L.limit_per(docs.select("doc_kind", "doc_id"), "doc_kind", ["doc_id"], 10).select("doc_kind", "place", "doc_id")


def _queries(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_type").alias("query"))
    return L.distinct_queries(p, "query", "p_partkey")


def _locked(spark, d):
    q = _pages(spark, d).select(U.plain_host(F.col("url")).alias("crawl"), "url", F.col("page_id").alias("seq"))
    visited = q.where("seq % 7 = 0").select("crawl", U.crawl_key(F.col("url")).alias("key"))
    return L.locked_urls(q, visited, 20).select("crawl", "key", "place")


def _unseen(spark, d):
    p = _pages(spark, d).select(F.col("url").alias("key"), "page_id")
    seen = table(spark, d, "pages").where("meta_source_url is not null").select(F.col("meta_source_url").alias("key"))
    return L.unseen(p.groupBy("key").agg(F.min("page_id").alias("page_id")), seen, "key", ["page_id", "key"], 50)


def _errors(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null").select(F.col("job_id").alias("id"), "status", F.when(F.length("failed_reason") % 2 == 0, F.to_json(F.struct(F.col("failed_reason").alias("message"), F.upper(F.substring("failed_reason", 1, 3)).alias("code")))).otherwise(F.col("failed_reason")).alias("failed_reason"))
    return L.crawl_errors(q.distinct(), ["TIM"]).groupBy(F.coalesce("code", F.lit("-")).alias("code"), "message").agg(F.count("*").alias("n"))


def _sample(spark, d):
    return L.stable_sample(table(spark, d, "documents").where("doc_id is not null").select("doc_id"), "doc_id")


def _sampled_pages(spark, d):
    return L.sampled_pages(_pages(spark, d), "url", 10, "7")


def _followed(spark, d):
    return L.followed(_pages(spark, d).select("page_id", "url", F.col("page_id").alias("seq")).distinct(), 10, 4, 35, ("seq", "url")).select("page_id", "url")


def _promoted(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null")
    one = q.groupBy(F.col("job_id").alias("id")).agg(F.max("created_at").alias("created_at"), F.max("priority").alias("priority"))
    odd = F.conv(F.substring(F.md5("id"), 1, 1), 16, 10).cast("int")
    backlog = one.where(odd < 6).withColumn("times_out_at", F.when(odd % 2 == 0, F.col("created_at")))
    now = F.lit("2024-01-15").cast("timestamp_ntz")
    ins, left = Q.promoted(one.where(odd == 1), backlog, one.where(odd != 3), now)
    return ins.select(F.lit("queue").alias("place"), "id").unionAll(left.select(F.lit("backlog").alias("place"), "id")).groupBy("place").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


def _started(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null and owner_id is not null and created_at is not null")
    one = q.groupBy(F.col("job_id").alias("id")).agg(F.min_by(F.struct(F.lower(F.trim("owner_id")).alias("team"), F.lower(F.trim("group_id")).alias("crawl"), F.col("created_at").alias("expires")), F.struct("created_at", "status", "owner_id", "group_id")).alias("r"), F.min("status").alias("status")).select("id", "status", "r.*")
    teams = one.select("team").distinct().select("team", F.lit(5).alias("slots"))
    crawls = one.where("crawl is not null").select("crawl").distinct().select("crawl", F.lit(1).alias("slots"))
    return Q.started(one.where("status = 'queued'").drop("status"), one.where("status = 'active'").drop("status"), teams, F.lit("2000-01-01").cast("timestamp_ntz"), crawls)


def _lease_counts(spark, d):
    q = table(spark, d, "queue_scrape").where("owner_id is not null and status in ('queued', 'active')").select(F.lower(F.trim("owner_id")).alias("team"), F.when(F.col("status") == "active", "active").otherwise("waiting").alias("kind"), F.col("created_at").alias("expires"))
    plans = q.select("team").distinct().select("team", F.lit(2).alias("slots"), F.length("team").alias("other_slots"))
    return Q.lease_counts(q, plans, F.lit("2024-01-15").cast("timestamp_ntz"))


QUERIES = {
    "map_path_filter": _path_filter, "map_site": _map_site, "map_site_searched": _map_site_searched, "union_of_addresses": _union_urls, "index_at_level": _at_level, "index_at_domain": _at_domain,
    "job_records": _job_records, "reranked_documents": _reranked, "clean_results": _clean_results, "results_per_type": _per_type, "distinct_queries": _queries, "locked_urls": _locked, "unseen_links": _unseen,
    "crawl_errors": _errors, "stable_sample": _sample, "sampled_pages": _sampled_pages, "followed_pages": _followed, "promoted_backlog": _promoted, "started_jobs": _started, "lease_counts": _lease_counts,
}

_P = "p AS (SELECT * FROM pages WHERE url IS NOT NULL AND page_id IS NOT NULL)"


def _of(template: str, u: str) -> str:
    """An expression over `url` stated over another column."""
    return template.replace("(url,", f"({u},").replace("(url)", f"({u})").replace("trim(url)", f"trim({u})")


_HOST_OF = lambda u: _of(W._PH, u)
_PATH_OF = lambda u: _of(W._PATH, u)
_TWO = lambda u: f"(CASE WHEN len(string_split({_HOST_OF(u)}, '.')) >= 2 THEN array_to_string(string_split({_HOST_OF(u)}, '.')[-2:], '.') END)"
_SUB = lambda u: rf"regexp_replace({_HOST_OF(u)}, '\.?[^.]+\.[^.]+$', '')"
_B = "b AS (SELECT url AS base FROM p ORDER BY page_id, url LIMIT 1)"
_SITE = f"coalesce({_TWO('url')} = {_TWO('base')}, false)"
_SAMEHOST = f"({_SITE} AND {_SUB('url')} = {_SUB('base')})"
_UNDER = f"({_SITE} AND (length({_PATH_OF('base')}) <= 1 OR starts_with({_PATH_OF('url')}, {_PATH_OF('base')})))"
_CHK = W._checked_sql().replace("url", "bare")


def _map_sql(order: tuple[int, int, int], keep: str) -> str:
    i, s, q = order
    return rf"""WITH {_P}, {_B},
u AS (SELECT {i} AS source, page_id AS position, url, NULL AS title FROM p WHERE meta_status_code = 200 UNION ALL SELECT {s}, page_id, meta_source_url, NULL FROM p WHERE meta_source_url IS NOT NULL UNION ALL SELECT {q}, page_id, url, meta_title FROM p WHERE meta_title IS NOT NULL),
t AS (SELECT * FROM u ORDER BY source, position, url LIMIT 100000),
x AS (SELECT source, position, title, CASE WHEN regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN regexp_replace(trim(url), '\?.*$', '') ELSE regexp_replace('http://' || trim(url), '\?.*$', '') END AS bare FROM t),
c AS (SELECT source, position, title, {_CHK} AS url FROM x),
k AS (SELECT source, position, title, url FROM c, b WHERE url IS NOT NULL AND {keep}),
m AS (SELECT url, min((source, position)) AS spot, min((source, position, title)) FILTER (WHERE title IS NOT NULL) AS t FROM k GROUP BY url)
SELECT url, row_number() OVER (ORDER BY spot, url) AS place, t[3] AS title FROM m"""


_SPLIT_ROOT = rf"regexp_replace({W._NAKED}, ':\d*$', '')"
_ODD = "('0x' || substr(md5(job_id), 1, 1))::INT"
_JOBS = f"o AS (SELECT job_id, max((created_at, status, coalesce(job_data, ''), coalesce(failed_reason, ''))) AS r FROM queue_scrape WHERE job_id IS NOT NULL GROUP BY job_id), q AS (SELECT job_id, r[1] AS created_at, r[2] AS status, r[3] AS job_data, r[4] AS failed_reason, {_ODD} AS odd FROM o)"
_SHARE = lambda u: f"(('0x' || substr(md5({u}), 1, 8))::BIGINT / 4294967296.0)"
_CRAWL_KEY = f"(regexp_replace(url, '[?#].*$', '') || {W._SQ} || {W._RF})"
_NO = "|".join(e.replace(".", r"\.") for e in L.NO_PAGES)

SQL = {
    "map_path_filter": f"WITH {_P}, {_B}, u AS (SELECT DISTINCT url FROM p) SELECT url, {_SITE} AS same_site, {_SAMEHOST} AS same_host, {_UNDER} AS under_path FROM u, b",
    "map_site": _map_sql((0, 1, 2), _SITE),
    "map_site_searched": _map_sql((1, 2, 0), _SAMEHOST),
    "union_of_addresses": f"WITH {_P}, u AS (SELECT 1 AS source, page_id AS position, url FROM p WHERE meta_status_code = 200 UNION ALL SELECT 2, page_id, meta_source_url FROM p WHERE meta_source_url IS NOT NULL UNION ALL SELECT 0, page_id, url FROM p WHERE meta_title IS NOT NULL) SELECT url, source, position FROM u QUALIFY row_number() OVER (PARTITION BY url ORDER BY source, position) = 1",
    "index_at_level": f"WITH {_P}, {_B}, r AS (SELECT {_SPLIT_ROOT} AS root FROM (SELECT base AS url FROM b)) SELECT DISTINCT coalesce(meta_source_url, url) AS resolved_url FROM p, r WHERE {_SPLIT_ROOT} = root AND scraped_at >= TIMESTAMP '2000-01-01'",
    "index_at_domain": rf"WITH {_P}, {_B}, w AS (SELECT {_HOST_OF('base')} AS h FROM b) SELECT DISTINCT coalesce(meta_source_url, url) AS resolved_url FROM p, w WHERE ({W._PH} = h OR ends_with({W._PH}, '.' || h)) AND scraped_at >= TIMESTAMP '2000-01-01'",
    "job_records": f"""WITH {_JOBS}
SELECT job_id AS id, CASE WHEN odd >= 8 THEN CASE WHEN q.status = 'completed' THEN 'completed' ELSE 'failed' END ELSE q.status END AS status, CASE WHEN odd % 3 = 0 THEN job_id WHEN odd < 12 THEN 'queued value' END AS value,
CASE WHEN odd < 12 THEN job_data ELSE upper(job_data) END AS options, created_at, nullif(q.failed_reason, '') AS failed_reason FROM q WHERE odd <> 5""",
    "reranked_documents": f"WITH {_P}, g AS (SELECT url, min(page_id) AS page_id FROM p GROUP BY url) SELECT url, page_id, round({_SHARE('url')}, 6) AS score, 'page ' || page_id AS reason FROM g WHERE {_SHARE('url')} > 0.6",
    "clean_results": "WITH r AS (SELECT doc_id, trim(coalesce(doc_kind, '')) AS title, trim(coalesce(source_url, '')) AS url, trim(coalesce(source, '')) AS summary FROM documents WHERE doc_id IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY lower(url) ORDER BY doc_id, url, title, summary) AS n FROM r WHERE regexp_matches(url, '^https?://')) SELECT doc_id, url FROM k WHERE n = 1",
    "results_per_type": "SELECT doc_kind, row_number() OVER (PARTITION BY doc_kind ORDER BY doc_id)::INT AS place, doc_id FROM documents WHERE doc_id IS NOT NULL AND source_url IS NOT NULL QUALIFY place <= 10",
    "distinct_queries": "SELECT p_partkey, p_type AS query FROM part WHERE trim(p_type) <> '' QUALIFY row_number() OVER (PARTITION BY lower(trim(p_type)) ORDER BY p_partkey) = 1 ORDER BY p_partkey LIMIT 10",
    "locked_urls": f"""WITH {_P}, q AS (SELECT {W._PH} AS crawl, {_CRAWL_KEY} AS key, page_id AS seq FROM p), v AS (SELECT DISTINCT crawl, key FROM q WHERE seq % 7 = 0),
h AS (SELECT crawl, count(*) AS held FROM v GROUP BY crawl), f AS (SELECT crawl, key, min(seq) AS seq FROM q GROUP BY crawl, key), n AS (SELECT * FROM f ANTI JOIN v USING (crawl, key))
SELECT crawl, key, row_number() OVER (PARTITION BY crawl ORDER BY seq, key) + coalesce(held, 0) AS place FROM n LEFT JOIN h USING (crawl) QUALIFY place <= 20""",
    "unseen_links": f"WITH {_P} SELECT url AS key, min(page_id) AS page_id FROM p WHERE url NOT IN (SELECT meta_source_url FROM pages WHERE meta_source_url IS NOT NULL) GROUP BY url ORDER BY page_id, key LIMIT 50",
    "crawl_errors": "WITH q AS (SELECT DISTINCT job_id, failed_reason AS m, CASE WHEN length(failed_reason) % 2 = 0 THEN upper(substr(failed_reason, 1, 3)) END AS code FROM queue_scrape WHERE job_id IS NOT NULL AND status = 'failed' AND failed_reason IS NOT NULL) SELECT coalesce(code, '-') AS code, m AS message, count(*) AS n FROM q WHERE code IS NULL OR code <> 'TIM' GROUP BY ALL",
    "stable_sample": f"SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND {_SHARE('doc_id::VARCHAR')} < 0.1",
    "sampled_pages": rf"WITH {_P} SELECT DISTINCT url FROM p WHERE NOT regexp_matches(lower({W._PATH}), '({_NO})$') ORDER BY md5('7' || url), url LIMIT 10",
    "followed_pages": f"WITH {_P} SELECT DISTINCT page_id, url FROM p ORDER BY page_id, url LIMIT 35",
    "promoted_backlog": f"""WITH o AS (SELECT job_id, max(created_at) AS created_at, {_ODD} AS odd FROM queue_scrape WHERE job_id IS NOT NULL GROUP BY job_id),
l AS (SELECT job_id AS id, odd FROM o WHERE odd < 6 AND (odd % 2 = 1 OR created_at > TIMESTAMP '2024-01-15'))
SELECT CASE WHEN odd = 3 THEN 'backlog' ELSE 'queue' END AS place, count(*) AS n, min(id) AS first, max(id) AS last FROM l WHERE odd <> 1 GROUP BY 1""",
    "started_jobs": """WITH o AS (SELECT job_id AS id, first((lower(trim(owner_id)), lower(trim(group_id)), created_at) ORDER BY created_at, status, owner_id, group_id NULLS FIRST) AS r, min(status) AS status FROM queue_scrape WHERE job_id IS NOT NULL AND owner_id IS NOT NULL AND created_at IS NOT NULL GROUP BY job_id),
x AS (SELECT id, status, r[1] AS team, r[2] AS crawl, r[3] AS expires FROM o), a AS (SELECT * FROM x WHERE status = 'active'), w AS (SELECT * FROM x WHERE status = 'queued'),
ca AS (SELECT crawl, count(*) AS used FROM a WHERE crawl IS NOT NULL GROUP BY crawl), ta AS (SELECT team, count(*) AS used FROM a GROUP BY team),
c AS (SELECT w.*, row_number() OVER (PARTITION BY crawl ORDER BY expires, id) AS p, 1 - coalesce(used, 0) AS free FROM w LEFT JOIN ca USING (crawl)),
k AS (SELECT * FROM c WHERE crawl IS NULL OR p <= free)
SELECT id, team, crawl, row_number() OVER (PARTITION BY team ORDER BY expires, id)::INT AS place, FROM k LEFT JOIN ta USING (team) QUALIFY place <= 5 - coalesce(ta.used, 0)""",
    "lease_counts": "WITH q AS (SELECT lower(trim(owner_id)) AS team, status, created_at FROM queue_scrape WHERE owner_id IS NOT NULL AND status IN ('queued', 'active')) SELECT team, count(*) FILTER (WHERE status = 'active' AND created_at >= TIMESTAMP '2024-01-15') AS active, count(*) FILTER (WHERE status = 'queued' AND created_at >= TIMESTAMP '2024-01-15') AS waiting, greatest(2, length(team))::INT AS max_concurrency FROM q GROUP BY team",
}
