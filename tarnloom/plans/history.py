"""Queries over histories: versions of pages, events in order, jobs of a queue."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnloom.functions import urls as U
from tarnloom.operators import history as H
from tarnloom.tables import table


def _versions(spark, d):
    v = table(spark, d, "page_versions").where("source_url is not null and captured_at is not null")
    return v.withColumn("key", U.plain(F.lower(F.regexp_replace("source_url", r"[?#].*$", ""))))


_V = r"""v AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_replace(source_url, '[?#].*$', '')), '^https?://(?:www\.)?', ''), '/$', '') AS key FROM page_versions WHERE source_url IS NOT NULL AND captured_at IS NOT NULL)"""


def _change_status(spark, d):
    return H.change_status(_versions(spark, d), "key", ["captured_at", "version_id"]).select("version_id", "change")


_CHANGE = rf"""WITH {_V},
s AS (SELECT version_id, key, captured_at, status_code, CASE WHEN length(trim(markdown)) > 0 THEN md5(array_to_string(list_sort(string_split(regexp_replace(regexp_replace(markdown, '<iframe[^>]*>', '', 'g'), '\s', '', 'g'), '')), '')) END AS g FROM v),
b AS (SELECT *, last_value(g IGNORE NULLS) OVER (PARTITION BY key ORDER BY captured_at, version_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM s)
SELECT version_id, CASE WHEN status_code = 404 THEN 'removed' WHEN p IS NULL THEN 'new' WHEN g = p THEN 'same' ELSE 'changed' END AS change FROM b"""


def _previous_version(spark, d):
    """As-of join: each failed capture with the latest good one before it."""
    v = _versions(spark, d)
    failed = v.where("not success or success is null").select("version_id", "key", "captured_at")
    good = v.where("success").select("key", F.col("captured_at").alias("good_at"), F.col("version_id").alias("good_id"))
    return H.as_of(failed, good, "key", "captured_at", "good_at", ["good_id"]).select("version_id", "good_id", "as_of_good_at")


_PREVIOUS = rf"""WITH {_V}, f AS (SELECT version_id, key, captured_at FROM v WHERE success IS NOT TRUE),
j AS (SELECT f.version_id, g.version_id AS good_id, g.captured_at AS good_at, row_number() OVER (PARTITION BY f.version_id ORDER BY g.captured_at DESC, g.version_id DESC) AS n FROM f JOIN v g ON g.key = f.key AND g.success AND g.captured_at <= f.captured_at)
SELECT f.version_id, j.good_id, j.good_at AS as_of_good_at FROM f LEFT JOIN j ON j.version_id = f.version_id AND j.n = 1"""


def _cache_pick(spark, d):
    good = F.col("status_code").between(200, 299)
    return H.newest_good(_versions(spark, d), "key", [F.desc("captured_at"), F.desc("version_id")], good).select("key", "version_id", "position", F.coalesce("status_code", F.lit(0)).alias("status_code"))


_PICK = rf"""WITH {_V}, n AS (SELECT key, version_id, status_code, row_number() OVER (PARTITION BY key ORDER BY captured_at DESC, version_id DESC) - 1 AS position FROM v),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY (status_code BETWEEN 200 AND 299) IS NOT TRUE, position) AS r FROM n WHERE position < 3)
SELECT key, version_id, position::INT AS position, coalesce(status_code, 0) AS status_code FROM p WHERE r = 1"""


def _recent_facts(spark, d):
    """Interval join: for each error event the three newest events of the user in the hour before."""
    e = table(spark, d, "events")
    errors = e.where("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("ts").alias("at"))
    facts = e.where("event_type != 'error'").select("user_id", "ts", "event_id")
    return H.within_interval(errors, facts, "user_id", "at", "ts", "6 hours", 3).select("error_id", F.col("fact_event_id").alias("event_id"), "rank")


_RECENT = """WITH j AS (SELECT e.event_id AS error_id, f.event_id, row_number() OVER (PARTITION BY e.event_id ORDER BY f.ts DESC, f.event_id) AS rank
FROM events e JOIN events f ON e.user_id = f.user_id AND f.ts <= e.ts AND f.ts > e.ts - INTERVAL 6 HOUR WHERE e.event_type = 'error' AND f.event_type <> 'error')
SELECT error_id, event_id, rank::INT AS rank FROM j WHERE rank <= 3"""


def _page_cut(spark, d):
    docs = table(spark, d, "documents").where("text is not null and source is not null")
    return H.byte_cut(docs, "source", ["doc_id"], F.octet_length("text"), 100_000).select("source", "doc_id", "running")


_CUT = """WITH r AS (SELECT source, doc_id, sum(strlen(text)) OVER w AS running, row_number() OVER w AS n FROM documents WHERE text IS NOT NULL AND source IS NOT NULL WINDOW w AS (PARTITION BY source ORDER BY doc_id))
SELECT source, doc_id, running::BIGINT AS running FROM r WHERE running <= 100000 OR n = 1"""


def _step_parent(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, d, "events").select("event_id", "user_id", F.lag("event_id", 1, -1).over(w).alias("parent_id"), F.row_number().over(w).alias("step_no"))


def _repeat_runs(spark, d):
    return H.runs(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type")


_RUNS = """WITH t AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run_no FROM t)
SELECT user_id, run_no::BIGINT AS run_no, event_type, count(*) AS n_rows, min(ts) AS first, max(ts) AS last FROM n GROUP BY user_id, run_no, event_type"""


def _until_first_error(spark, d):
    return H.take_while(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") != "error").select("user_id", "event_id")


_UNTIL = """WITH f AS (SELECT *, max((event_type <> 'error') IS NOT TRUE) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS failed FROM events) SELECT user_id, event_id FROM f WHERE NOT failed"""


def _last_events(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return table(spark, d, "events").withColumn("n", F.row_number().over(w)).where("n <= 50").select("user_id", "event_id", "n")


def _crawl_budget(spark, d):
    """A budget shared out to domains by the root of their pages, scaled to 10..50, and to pages within each domain."""
    p = table(spark, d, "pages").where("url is not null").select("page_id", U.plain_host(F.col("url")).alias("domain"), F.coalesce("meta_credits_used", F.lit(1)).alias("weight")).distinct()
    by = p.groupBy("domain").agg(F.count_distinct("page_id").alias("n_pages"), F.sum("weight").alias("weight")).withColumn("priority", F.sqrt("n_pages"))
    limits = by.agg(F.min("priority").alias("lo"), F.max("priority").alias("hi"), F.sum("priority").alias("total"))  # one row
    scaled = by.crossJoin(F.broadcast(limits))
    budget = F.when(F.col("hi") == F.col("lo"), F.lit(10)).otherwise(F.round(10 + (F.col("priority") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 40))
    return scaled.select("domain", "n_pages", budget.cast("bigint").alias("urls"), F.round(F.col("priority") / F.col("total"), 9).alias("share"))


_BUDGET = rf"""WITH p AS (SELECT DISTINCT page_id, regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1), '^[^@]*@', '')), ':\d*$', ''), '^www\.', '') AS domain, coalesce(meta_credits_used, 1) AS weight FROM pages WHERE url IS NOT NULL),
b AS (SELECT domain, count(DISTINCT page_id) AS n_pages, sqrt(count(DISTINCT page_id)) AS priority FROM p GROUP BY domain),
l AS (SELECT min(priority) AS lo, max(priority) AS hi, sum(priority) AS total FROM b)
SELECT domain, n_pages, (CASE WHEN hi = lo THEN 10 ELSE round(10 + (priority - lo) / (hi - lo) * 40) END)::BIGINT AS urls, round(priority / total, 9) AS share FROM b, l"""

QUERIES = {
    "change_status": _change_status, "previous_version": _previous_version, "cache_pick": _cache_pick, "recent_facts": _recent_facts, "page_cut_bytes": _page_cut, "step_parent": _step_parent,
    "repeat_runs": _repeat_runs, "until_first_error": _until_first_error, "last_events": _last_events, "crawl_budget": _crawl_budget,
}
SQL = {
    "change_status": _CHANGE, "previous_version": _PREVIOUS, "cache_pick": _PICK, "recent_facts": _RECENT, "page_cut_bytes": _CUT,
    "step_parent": "SELECT event_id, user_id, lag(event_id, 1, -1) OVER w AS parent_id, (row_number() OVER w)::INT AS step_no FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)",
    "repeat_runs": _RUNS, "until_first_error": _UNTIL,
    "last_events": "SELECT user_id, event_id, n::INT AS n FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 50",
    "crawl_budget": _BUDGET,
}
