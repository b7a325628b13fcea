"""Queries of addresses against lists, and of JSON columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnloom.operators import sites as S
from tarnloom.plans.web import _PH
from tarnloom.tables import table


def _urls(spark, d):
    return table(spark, d, "documents").where("source_url is not null and doc_id is not null").select(F.col("doc_id").alias("id"), F.col("source_url").alias("url"))


def _sites(spark):
    return spark.createDataFrame([("example", 2, "any"), ("test", 3, "trial"), ("invalid", 1, "none")], "site string, position int, label string")


def _matched(spark, d):
    return S.matched_sites(_urls(spark, d), _sites(spark)).groupBy("label").agg(F.count("*").alias("n")).select(F.coalesce("label", F.lit("-")).alias("label"), "n")


def _blocked(spark, d):
    first = _urls(spark, d).orderBy("id").limit(5).select(F.expr("regexp_replace(regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), ':[0-9]+$', ''), '^www[.]', '')").alias("domain"))
    return S.blocked(_urls(spark, d), first, allowed=("guide",)).where("blocked").select("id")


def _job_profile(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null").groupBy("job_id").agg(F.max("job_data").alias("job_data"))
    p = S.profile(q, "job_data", "job_id")
    return p.groupBy("kind", F.array_join("keys", ",").alias("keys")).agg(F.count("*").alias("n"))


def _job_modes(spark, d):
    q = table(spark, d, "queue_scrape").where("job_id is not null")
    return q.groupBy(F.coalesce(F.get_json_object("job_data", "$.mode"), F.lit("-")).alias("mode"), F.coalesce(F.get_json_object("job_data", "$.origin"), F.lit("-")).alias("origin")).agg(F.count("*").alias("n"))


def _props_changes(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").select("event_id", "user_id", F.lag("props").over(w).alias("before"), "props").where("before is not null")
    return S.json_changes(e, "before", "props", "event_id")


QUERIES = {"site_labels": _matched, "blocked_urls": _blocked, "job_profile": _job_profile, "job_modes": _job_modes, "props_changes": _props_changes}
_U = "u AS (SELECT doc_id AS id, source_url AS url FROM documents WHERE source_url IS NOT NULL AND doc_id IS NOT NULL)"
_LAST = f"array_to_string(string_split({_PH}, '.')[-2:], '.')"
SQL = {
    "site_labels": f"WITH {_U}, h AS (SELECT {_PH} AS host FROM u) SELECT CASE WHEN regexp_matches(host, '(^|\\.)invalid$') THEN 'none' WHEN regexp_matches(host, '(^|\\.)example$') THEN 'any' WHEN regexp_matches(host, '(^|\\.)test$') THEN 'trial' ELSE '-' END AS label, count(*) AS n FROM h GROUP BY 1",
    "job_profile": "WITH q AS (SELECT job_id, max(job_data) AS j FROM queue_scrape WHERE job_id IS NOT NULL GROUP BY job_id) SELECT CASE WHEN j IS NULL OR NOT json_valid(j) THEN 'other' WHEN ltrim(j)[1] = '[' THEN 'list' WHEN ltrim(j)[1] = '{' THEN 'object' ELSE 'other' END AS kind, coalesce(array_to_string(list_sort(json_keys(j)), ','), '') AS keys, count(*) AS n FROM q GROUP BY 1, 2",
    "job_modes": "SELECT coalesce(json_extract_string(job_data, '$.mode'), '-') AS mode, coalesce(json_extract_string(job_data, '$.origin'), '-') AS origin, count(*) AS n FROM queue_scrape WHERE job_id IS NOT NULL GROUP BY 1, 2",
    "props_changes": "WITH e AS (SELECT event_id, lag(props) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b, props AS p FROM events) SELECT event_id, 'k' AS field, json_extract_string(b, '$.k') AS previous, json_extract_string(p, '$.k') AS current FROM e WHERE b IS NOT NULL AND json_extract_string(b, '$.k') IS DISTINCT FROM json_extract_string(p, '$.k')",
    "blocked_urls": f"WITH {_U}, h AS (SELECT id, url, {_PH} AS host, string_split({_LAST}, '.')[1] AS name FROM u), b AS (SELECT host, name FROM h ORDER BY id LIMIT 5) SELECT id FROM h WHERE NOT contains(lower(url), 'guide') AND (name IN (SELECT name FROM b) OR EXISTS (SELECT 1 FROM b WHERE h.host = b.host OR ends_with(h.host, '.' || b.host)))",
}
