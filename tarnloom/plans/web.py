"""Queries over URLs, links and the crawl frontier."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnloom.functions import dom
from tarnloom.functions import urls as U
from tarnloom.operators import links as L
from tarnloom.operators.html import map_columns
from tarnloom.tables import table


def _pages(spark, d):
    return table(spark, d, "pages").select("page_id", "url", "meta_source_url", "scraped_at", "meta_title").where("url is not null")



def _url_keys(spark, d):
    u = F.col("url")
    return _pages(spark, d).select("url").distinct().select(
        "url", U.record_key(u).alias("record_key"), U.index_key(u).alias("index_key"), U.hash_key(u).alias("hash_key"), U.crawl_key(u).alias("crawl_key"),
        U.crawl_key(u, True).alias("crawl_key_bare"), U.permutation_key(u).alias("permutation_key"), U.depth(u).alias("depth"), U.plain(u).alias("plain"), U.plain_host(u).alias("plain_host"),
        U.registrable_domain(U.plain_host(u)).alias("domain"), U.is_base_domain(u).alias("is_base"), U.is_file(U.path(u)).alias("is_file"), U.checked(u).alias("checked"),
    )


_SQ = r"regexp_extract(url, '^[^?#]*(\?[^#]*)', 1)"
_SF = r"regexp_extract(url, '^[^#]*(#.*)$', 1)"
_RF = f"(CASE WHEN regexp_matches({_SF}, '^#!?/') AND length({_SF}) > 2 THEN {_SF} ELSE '' END)"
_AUTH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
_SCH = r"lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1))"
_HOST = rf"regexp_replace(lower(regexp_replace({_AUTH}, '^[^@]*@', '')), ':\d*$', '')"
_PH = rf"regexp_replace({_HOST}, '^www\.', '')"
_P1 = rf"regexp_replace({_PATH}, ';[^/]*$', '')"
_NAKED = rf"regexp_replace(lower({_AUTH}), '^www\.', '')"
_IDXP = rf"(CASE WHEN regexp_replace({_PATH}, '/index\.(?:html|php|htm|shtml|xml)$', '/') = '' THEN '/' ELSE regexp_replace({_PATH}, '/index\.(?:html|php|htm|shtml|xml)$', '/') END)"
_IDX = rf"('https://' || regexp_replace(regexp_replace(lower({_AUTH}), ':(?:80|443)$', ''), '^www\.', '') || {_IDXP} || {_SQ} || {_RF})"
_IDXK = rf"(CASE WHEN {_SQ} || {_RF} = '' THEN regexp_replace({_IDX}, '/$', '') ELSE {_IDX} END)"
_LAB = f"string_split({_PH}, '.')"
_DOM = rf"(CASE WHEN regexp_matches(array_to_string({_LAB}[-2:], '.'), '^(ac|co|com|edu|gen|gob|gouv|gov|govt|go|ltd|mil|ne|net|nhs|nom|or|org|plc|police|sch)\.[a-z][a-z]$') THEN array_to_string({_LAB}[-3:], '.') ELSE array_to_string({_LAB}[-2:], '.') END)"
_FULL = r"(CASE WHEN regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN trim(url) ELSE 'http://' || trim(url) END)"
_EXT = ", ".join(f"'{e}'" for e in U.FILE_EXTENSIONS)
_DEPTH = f"len(list_filter(string_split({_PATH}, '/'), lambda s: s <> '' AND s <> 'index.php' AND s <> 'index.html'))"
_ISFILE = rf"(regexp_extract({_PATH}, '(\.[^./]*)$', 1) IN ({_EXT}))"


def _checked_sql():
    auth = rf"regexp_extract({_FULL}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"
    host = rf"regexp_replace(lower(regexp_replace({auth}, '^[^@]*@', '')), ':\d*$', '')"
    sch = rf"lower(regexp_extract({_FULL}, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1))"
    return rf"(CASE WHEN {sch} IN ('http', 'https') AND regexp_matches({host}, '^[^.\s]+(?:\.[^.\s]+)+$') THEN regexp_replace({_FULL}, '/$', '') END)"


_U = "WITH p AS (SELECT DISTINCT url FROM pages WHERE url IS NOT NULL)"
_URL_KEYS = rf"""{_U}
SELECT url,
  CASE WHEN trim(url) = '' THEN '' ELSE (CASE WHEN {_SCH} = '' THEN 'https' ELSE {_SCH} END) || '://' || lower({_AUTH}) || (CASE WHEN {_P1} = '/' THEN {_P1} ELSE regexp_replace({_P1}, '/$', '') END) END AS record_key,
  {_IDXK} AS index_key, '\x' || sha256(url) AS hash_key,
  regexp_replace(url, '[?#].*$', '') || {_SQ} || {_RF} AS crawl_key, regexp_replace(url, '[?#].*$', '') || {_RF} AS crawl_key_bare,
  'http://www.' || {_NAKED} || regexp_replace({_PATH}, '/(?:index\.(?:html|php))?$', '') || '/index.html' || {_SQ} AS permutation_key,
  {_DEPTH}::INT AS depth, regexp_replace(regexp_replace(url, '^https?://(?:www\.)?', ''), '/$', '') AS plain, {_PH} AS plain_host,
  {_DOM} AS domain, {_DOM} = {_PH} AS is_base, {_ISFILE} AS is_file, {_checked_sql()} AS checked
FROM p"""


def _url_splits(spark, d):
    return _pages(spark, d).select("url").distinct().select("url", F.posexplode(U.url_splits(F.col("url"))).alias("level", "prefix")).withColumn("prefix_hash", U.hash_key(F.col("prefix")))


_URL_SPLITS = rf"""{_U},
k AS (SELECT url, {_IDXK} AS key, {_NAKED} AS host FROM p),
s AS (SELECT url, key, 'https://' || regexp_replace(host, ':\d*$', '') AS base, list_filter(string_split(regexp_extract(key, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM k),
e AS (SELECT url, key, len(parts) AS n, i, base || (CASE WHEN i > 0 THEN '/' || array_to_string(parts[1:i], '/') ELSE '' END) AS prefix FROM (SELECT *, unnest(range(0, len(parts) + 1)) AS i FROM s)),
a AS (SELECT url, i, prefix FROM e UNION ALL SELECT DISTINCT url, n + 1, key FROM e),
f AS (SELECT url, prefix, min(i) AS i FROM a GROUP BY url, prefix)
SELECT url, (row_number() OVER (PARTITION BY url ORDER BY i) - 1)::INT AS level, prefix, '\x' || sha256(prefix) AS prefix_hash FROM f"""


def _domain_levels(spark, d):
    h = U.plain_host(F.col("url"))
    return _pages(spark, d).select(h.alias("host")).distinct().where("host != ''").select("host", F.posexplode(U.domain_splits(F.col("host"))).alias("level", "domain"))


_DOMAIN_LEVELS = rf"""WITH h AS (SELECT DISTINCT {_PH} AS host FROM pages WHERE url IS NOT NULL),
l AS (SELECT host, string_split(host, '.') AS x FROM h WHERE host <> ''),
m AS (SELECT host, x, CASE WHEN regexp_matches(array_to_string(x[-2:], '.'), '^(ac|co|com|edu|gen|gob|gouv|gov|govt|go|ltd|mil|ne|net|nhs|nom|or|org|plc|police|sch)\.[a-z][a-z]$') THEN least(3, len(x)) ELSE least(2, len(x)) END AS first FROM l)
SELECT host, (k - first)::INT AS level, array_to_string(x[len(x) - k + 1:], '.') AS domain FROM (SELECT host, x, first, unnest(range(first, len(x) + 1)) AS k FROM m)"""


def _link_denials(spark, d):
    pages = _pages(spark, d).select(F.col("page_id").alias("seq"), F.col("url").alias("link")).distinct()
    base = pages.orderBy("seq").limit(1).first()
    o = L.LinkOptions(base_url=site_root(base["link"]) if base else "https://example.org/", excludes=("-[0-9]*5[0-9]*$",), allow_subdomains=True, allow_external=True, max_depth=1, limit=100)
    return L.filter_links(pages, o).groupBy(F.coalesce("denial_reason", F.lit("KEPT")).alias("outcome")).agg(F.count("*").alias("n_links"))


def site_root(url: str) -> str:
    """Root of a URL's site."""
    import re

    return re.sub(r"^([a-zA-Z]+://[^/?#]*).*$", r"\1/", url)


_LINK_DENIALS = rf"""WITH p AS (SELECT DISTINCT page_id AS seq, url FROM pages WHERE url IS NOT NULL),
b AS (SELECT regexp_replace(url, '^([a-zA-Z]+://[^/?#]*).*$', '\1/') AS url FROM (SELECT url FROM p ORDER BY seq LIMIT 1)),
bh AS (SELECT regexp_replace({_HOST}, '^(?:www\.)+', '') AS bhost, {_DOM} AS bdom FROM b),
r AS (SELECT seq, url, CASE
  WHEN {_SCH} NOT IN ('http', 'https') OR {_HOST} = '' THEN 'PARSE'
  WHEN {_DEPTH} > 1 THEN 'DEPTH'
  WHEN {_ISFILE} THEN 'FILE'
  WHEN regexp_replace({_HOST}, '^(?:www\.)+', '') = bhost THEN CASE
    WHEN {_SF} <> '' AND NOT (contains({_SF}, '/') AND length({_SF}) > 2) THEN 'SECTION'
    WHEN NOT starts_with({_PATH}, '/') THEN 'BACKWARD'
    WHEN regexp_matches({_PATH}, '-[0-9]*5[0-9]*$') THEN 'EXCLUDE' END
  ELSE CASE
    WHEN regexp_matches(url, 'facebook\.com|twitter\.com|linkedin\.com|instagram\.com|pinterest\.com|github\.com|calendly\.com|discord\.gg|discord\.com') THEN 'SOCIAL'
    WHEN regexp_matches({_PATH}, '-[0-9]*5[0-9]*$') THEN 'EXCLUDE'
    WHEN len(list_filter(string_split({_PATH}, '/'), lambda s: s <> '')) > 0 THEN NULL
    WHEN {_DOM} = bdom THEN NULL ELSE 'EXTERNAL' END
  END AS reason FROM p, bh),
k AS (SELECT seq, reason, sum((reason IS NULL)::INT) OVER (ORDER BY seq) AS kept FROM r)
SELECT coalesce(CASE WHEN reason IS NULL AND kept > 100 THEN 'LIMIT' ELSE reason END, 'KEPT') AS outcome, count(*) AS n_links FROM k GROUP BY 1"""


def _domain_frequency(spark, d):
    return _pages(spark, d).groupBy(U.plain_host(F.col("url")).alias("domain")).agg(F.count("*").alias("frequency"))


def _top_domains(spark, d):
    return _domain_frequency(spark, d).orderBy(F.desc("frequency"), "domain").limit(20)


def _domain_stats(spark, d):
    f = _domain_frequency(spark, d)
    return f.agg(F.count("*").alias("total_domains"), F.sum("frequency").alias("total_requests"), F.round(F.avg("frequency")).cast("bigint").alias("average_requests"))


def _prefer_https(spark, d):
    """One URL per address, https before http, bare before www., then the first."""
    u = F.col("url")
    key = F.concat(U.plain_host(u), U.path(u), U.query(u), U.fragment(u))
    w = Window.partitionBy("key").orderBy(U.scheme(u) != "https", U.host(u).rlike(r"^www\."), "page_id", "url")
    rows = _pages(spark, d).select("page_id", F.col("meta_source_url").alias("url")).where("url is not null").distinct().withColumn("key", key)
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").select("key", "page_id", "url")


_PREFER = rf"""WITH p AS (SELECT DISTINCT page_id, meta_source_url AS url FROM pages WHERE url IS NOT NULL AND meta_source_url IS NOT NULL),
k AS (SELECT page_id, p.url, ({_PH} || {_PATH} || {_SQ} || {_SF}) AS key, {_SCH} <> 'https' AS a, regexp_matches({_HOST}, '^www\.') AS b FROM p)
SELECT key, page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY a, b, page_id, url) AS n FROM k) WHERE n = 1"""


def _map_documents_whole(spark, d):
    """Links of a site map merged by address: the first place of each, the first title that is not NULL; every address."""
    rows = _pages(spark, d).select(U.record_key(F.col("url")).alias("key"), "page_id", "scraped_at", "meta_title")
    best = F.struct(F.col("meta_title").isNull().alias("a"), "page_id", "scraped_at", "meta_title")
    return rows.groupBy("key").agg(F.min("page_id").alias("position"), F.min(best)["meta_title"].alias("title"))


_MAP = rf"""WITH k AS (SELECT CASE WHEN trim(url) = '' THEN '' ELSE (CASE WHEN {_SCH} = '' THEN 'https' ELSE {_SCH} END) || '://' || lower({_AUTH}) || (CASE WHEN {_P1} = '/' THEN {_P1} ELSE regexp_replace({_P1}, '/$', '') END) END AS key, page_id, scraped_at, meta_title FROM pages WHERE url IS NOT NULL),
t AS (SELECT key, meta_title, row_number() OVER (PARTITION BY key ORDER BY meta_title IS NULL, page_id, scraped_at, meta_title) AS n, min(page_id) OVER (PARTITION BY key) AS position FROM k)
SELECT key, position, meta_title AS title FROM t WHERE n = 1"""


def _first_wins(spark, d):
    w = Window.partitionBy("key").orderBy("page_id", "scraped_at")
    rows = _pages(spark, d).select(U.record_key(F.col("meta_source_url")).alias("key"), "page_id", "scraped_at").where("key is not null")
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").select("key", "page_id")


_FIRST = rf"""WITH u AS (SELECT meta_source_url AS url, page_id, scraped_at FROM pages WHERE url IS NOT NULL AND meta_source_url IS NOT NULL),
k AS (SELECT CASE WHEN trim(u.url) = '' THEN '' ELSE (CASE WHEN {_SCH} = '' THEN 'https' ELSE {_SCH} END) || '://' || lower({_AUTH}) || (CASE WHEN {_P1} = '/' THEN {_P1} ELSE regexp_replace({_P1}, '/$', '') END) END AS key, page_id FROM u)
SELECT key, min(page_id) AS page_id FROM k GROUP BY key"""


def _page_links(spark, d):
    """Distinct absolute links of each page: by pattern where all anchors have the plain form, else from the document tree."""
    p = table(spark, d, "pages").where("html is not null and page_id is not null and url is not null").groupBy("page_id").agg(F.max_by(F.struct("html", "url"), F.struct("scraped_at", "url")).alias("v")).select("page_id", "v.url", "v.html")
    plain = F.expr("size(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) = size(regexp_extract_all(html, '(?i)<a[\\\\s/>]', 0)) and not html rlike '(?i)<base[\\\\s]|<!--|<script|<template'")
    fast = p.where(plain).select("page_id", "url", F.explode(F.array_distinct(F.expr("regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"))).alias("href"))
    fast = fast.select("page_id", U.resolve(F.col("href"), F.col("url")).alias("link"))
    tree = map_columns(p.where(~plain), lambda h, u: (dom.absolute_links(h, u),), ["html", "url"], ["page_id"], "links array<string>")
    return fast.unionAll(tree.select("page_id", F.explode("links").alias("link"))).where("link != ''").distinct()


_PAGE_LINKS = rf"""WITH o AS (SELECT page_id, url, html, row_number() OVER (PARTITION BY page_id ORDER BY scraped_at DESC NULLS LAST, url DESC) AS r FROM pages WHERE html IS NOT NULL AND page_id IS NOT NULL AND url IS NOT NULL),
h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM o WHERE r = 1)
SELECT DISTINCT page_id, CASE WHEN starts_with(trim(href), '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*:)', 1) || '//' || {_AUTH} || trim(href) ELSE trim(href) END AS link FROM h WHERE trim(href) <> '' AND NOT starts_with(trim(href), '#')"""


def _frontier(spark, d):
    """Breadth-first levels over the site graph page host → link path → hosts with that path."""
    links = _page_links(spark, d).join(_pages(spark, d).select("page_id", U.plain_host(F.col("url")).alias("host")).distinct(), "page_id")
    path = U.path(F.col("link"))
    e = links.select("host", path.alias("path")).distinct()
    out = e.select(F.concat(F.lit("h:"), F.col("host")).alias("src"), F.concat(F.lit("p:"), F.col("path")).alias("dst"))
    back = e.select(F.concat(F.lit("p:"), F.col("path")).alias("src"), F.concat(F.lit("h:"), F.col("host")).alias("dst"))
    seed = e.agg(F.min("host").alias("host")).select(F.concat(F.lit("h:"), F.col("host")).alias("node"))
    return L.crawl_frontier(out.unionAll(back), seed, 3)


_FRONTIER = rf"""WITH RECURSIVE l AS ({_PAGE_LINKS}),
ph AS (SELECT DISTINCT page_id, {_PH} AS host FROM pages WHERE url IS NOT NULL),
e AS (SELECT DISTINCT host, regexp_extract(link, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path FROM l JOIN ph USING (page_id)),
g AS (SELECT 'h:' || host AS src, 'p:' || path AS dst FROM e UNION ALL SELECT 'p:' || path, 'h:' || host FROM e),
w AS (SELECT 'h:' || (SELECT min(host) FROM e) AS node, 0 AS depth UNION SELECT g.dst, w.depth + 1 FROM w JOIN g ON g.src = w.node WHERE w.depth < 3)
SELECT node, min(depth)::INT AS depth FROM w GROUP BY node"""

QUERIES = {
    "url_keys": _url_keys, "url_splits": _url_splits, "domain_levels": _domain_levels, "link_denials": _link_denials, "domain_frequency": _domain_frequency, "top_domains": _top_domains,
    "domain_stats": _domain_stats, "prefer_https": _prefer_https, "map_documents_whole": _map_documents_whole, "record_first_wins": _first_wins, "page_links": _page_links, "crawl_frontier": _frontier,
}
_FREQ = f"SELECT {_PH} AS domain, count(*) AS frequency FROM pages WHERE url IS NOT NULL GROUP BY 1"
SQL = {
    "url_keys": _URL_KEYS, "url_splits": _URL_SPLITS, "domain_levels": _DOMAIN_LEVELS, "link_denials": _LINK_DENIALS, "domain_frequency": _FREQ,
    "top_domains": f"SELECT * FROM ({_FREQ}) ORDER BY frequency DESC, domain LIMIT 20",
    "domain_stats": f"SELECT count(*) AS total_domains, sum(frequency)::BIGINT AS total_requests, round(avg(frequency))::BIGINT AS average_requests FROM ({_FREQ})",
    "prefer_https": _PREFER, "map_documents_whole": _MAP, "record_first_wins": _FIRST, "page_links": _PAGE_LINKS, "crawl_frontier": _FRONTIER,
}
