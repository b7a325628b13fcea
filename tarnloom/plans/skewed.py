"""Queries of problem 7."""

from __future__ import annotations

from tarnloom.operators import skew
from tarnloom.tables import table

_CLEAN = "nullif(lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')), '')"


def _owner_stats(spark, sf_dir):
    return skew.per_key(table(spark, sf_dir, "queue_scrape"), "owner_id")


def _group_stats(spark, sf_dir):
    return skew.per_key(table(spark, sf_dir, "queue_scrape"), "group_id")


def _found(spark, sf_dir):
    return skew.found(table(spark, sf_dir, "queue_scrape"))


QUERIES = {"p7_found": _found, "p7_owner_stats": _owner_stats, "p7_group_stats": _group_stats}

_FOUND = f"""
WITH k AS (SELECT DISTINCT job_id, {_CLEAN.format('owner_id')} AS o, {_CLEAN.format('group_id')} AS g FROM queue_scrape WHERE job_id IS NOT NULL),
t AS (SELECT count(DISTINCT job_id) AS n FROM k)
SELECT 'owner_id' AS key_field, o AS key_value FROM k, t WHERE o IS NOT NULL GROUP BY o, n HAVING count(DISTINCT job_id) >= 0.02 * n
UNION ALL
SELECT 'group_id', g FROM k, t WHERE g IS NOT NULL GROUP BY g, n HAVING count(DISTINCT job_id) >= 0.02 * n
"""


def _stats(field: str) -> str:
    return f"""
WITH d AS (
  SELECT job_id, status, created_at, finished_at, coalesce(stalls, 0) AS stalls, {_CLEAN.format(field)} AS k,
    row_number() OVER (PARTITION BY job_id ORDER BY coalesce(finished_at, locked_at, created_at) DESC NULLS LAST, status DESC NULLS LAST, coalesce(stalls, 0) DESC, created_at DESC NULLS LAST) AS r
  FROM queue_scrape WHERE job_id IS NOT NULL),
j AS (SELECT * FROM d WHERE r = 1),
t AS (SELECT count(*) AS n FROM j),
s AS (SELECT k, count(*) AS n_jobs, count(*) FILTER (WHERE status = 'queued') AS n_queued, count(*) FILTER (WHERE status = 'active') AS n_active,
    count(*) FILTER (WHERE status = 'completed') AS n_completed, count(*) FILTER (WHERE status = 'failed') AS n_failed,
    sum(stalls)::BIGINT AS stalls,
    sum(epoch_us(finished_at) - epoch_us(created_at)) FILTER (WHERE finished_at >= created_at) AS took,
    count(*) FILTER (WHERE finished_at >= created_at) AS timed,
    min(created_at) AS first_created, max(finished_at) AS last_finished
  FROM j WHERE k IS NOT NULL GROUP BY k)
SELECT k AS {field}, n_jobs >= 0.02 * n AS heavy, n_jobs, n_queued, n_active, n_completed, n_failed, n_completed AS credits, stalls,
  CASE WHEN timed > 0 THEN round(took::DOUBLE / timed / 1e6, 3) END AS mean_seconds, first_created, last_finished
FROM s, t
"""


SQL = {"p7_found": _FOUND, "p7_owner_stats": _stats("owner_id"), "p7_group_stats": _stats("group_id")}
