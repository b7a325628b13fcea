"""Queries over the job queue, its groups and metered events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarnloom.operators.skew import clean_key, distinct_jobs
from tarnloom.tables import table


def _jobs(spark, d):
    return distinct_jobs(table(spark, d, "queue_scrape"))


def _groups(spark, d):
    return table(spark, d, "group_crawl").withColumn("group_id", clean_key(F.col("group_id")))


_CK = r"nullif(lower(regexp_replace({0}, '^\s+|\s+$', '', 'g')), '')"
_J = f"""d AS (SELECT *, {_CK.format('owner_id')} AS o, {_CK.format('group_id')} AS g, row_number() OVER (PARTITION BY job_id ORDER BY coalesce(finished_at, locked_at, created_at) DESC NULLS LAST, status DESC NULLS LAST, coalesce(stalls, 0) DESC, created_at DESC NULLS LAST) AS rn FROM queue_scrape WHERE job_id IS NOT NULL),
j AS (SELECT job_id, status, created_at, locked_at, finished_at, coalesce(stalls, 0) AS stalls, o AS owner_id, g AS group_id FROM d WHERE rn = 1),
gr AS (SELECT {_CK.format('group_id')} AS group_id, status, created_at, ttl, expires_at, owner_id FROM group_crawl)"""


def _status_counts(spark, d):
    jobs = _jobs(spark, d).groupBy("status").agg(F.count("*").alias("n"))
    groups = _groups(spark, d).where("status = 'active'").agg(F.count("*").alias("n")).select(F.lit("backlog").alias("status"), "n")
    return jobs.unionAll(groups)


def _queue_gauge(spark, d):
    """Counts of the states asked for, 0 where there is none."""
    states = spark.createDataFrame([("queued",), ("active",), ("stalled",)], "status string")
    counts = _jobs(spark, d).groupBy("status").agg(F.count("*").alias("n"))
    return states.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def _finished_groups(spark, d):
    """Active groups without a queued or active job."""
    open_jobs = _jobs(spark, d).where("status in ('queued', 'active') and group_id is not null").select("group_id").distinct()
    return _groups(spark, d).where("status = 'active'").join(open_jobs, "group_id", "left_anti").select("group_id", "created_at")


def _jobs_of_ended_groups(spark, d):
    ended = _groups(spark, d).where("status != 'active'").select("group_id")
    return _jobs(spark, d).join(ended, "group_id", "left_semi").groupBy("status").agg(F.count("*").alias("n"))


def _group_progress(spark, d):
    """Groups with their jobs: a left join of pre-aggregated sides, so a group of many jobs is one row before it."""
    per = _jobs(spark, d).where("group_id is not null").groupBy("group_id").agg(F.count("*").alias("jobs"), F.sum((F.col("status").isin("completed", "failed")).cast("bigint")).alias("done"), F.max("finished_at").alias("last_finished"))
    g = _groups(spark, d).join(per, "group_id", "left")
    expired = F.expr("timestampadd(MILLISECOND, ttl, coalesce(last_finished, created_at))")
    return g.select("group_id", "status", F.coalesce("jobs", F.lit(0)).alias("jobs"), F.coalesce("done", F.lit(0)).alias("done"), (F.coalesce("jobs", F.lit(0)) == F.coalesce("done", F.lit(0))).alias("all_done"), expired.alias("expires"))


def _dequeue(spark, d):
    q = table(spark, d, "queue_scrape").where("status = 'queued'").groupBy("job_id").agg(F.min(F.struct("priority", "created_at")).alias("k"))
    return q.select("job_id", "k.priority", "k.created_at").orderBy("priority", "created_at", "job_id").limit(500)


def _listing(spark, d):
    return _jobs(spark, d).where("status = 'completed' and finished_at is not null").orderBy("finished_at", "created_at", "job_id").offset(100).limit(50).select("job_id", "finished_at")


def _retained(spark, d):
    """What a retention of 30 days (completed) and 90 days (failed) would keep, counted from the latest end."""
    j = _jobs(spark, d)
    now = j.agg(F.max("finished_at").alias("now"))  # one row
    old = F.expr("(status = 'completed' and finished_at < now - interval 30 days) or (status = 'failed' and finished_at < now - interval 90 days)")
    return j.crossJoin(F.broadcast(now)).groupBy("status", F.coalesce(old, F.lit(False)).alias("expired")).agg(F.count("*").alias("n"))


def _usage_groups(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id", "event_type").agg(F.round(F.sum("value"), 6).alias("units"), F.count("*").alias("ops"))


def _usage_periods(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.date_format(F.date_trunc("week", "ts"), "yyyy-MM-dd").alias("start")).agg(F.round(F.sum("value"), 4).alias("units"), F.count_distinct("user_id").alias("users")).orderBy("start")


def _cost_split(spark, d):
    v = F.coalesce(F.nanvl("value", F.lit(0.0)), F.lit(0.0))
    e = table(spark, d, "events")
    kinds = ("click", "error", "purchase")
    return e.groupBy("user_id").agg(F.round(F.sum(v), 6).alias("total"), *(F.round(F.sum(F.when(F.col("event_type") == k, v).otherwise(0.0)), 6).alias(f"cost_{k}") for k in kinds), *(F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in kinds))


def _limit_crossed(spark, d):
    """The event at which a user's running total first exceeds the limit."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    run = table(spark, d, "events").withColumn("total", F.sum(F.coalesce("value", F.lit(0.0))).over(w))
    over = run.where("total > 1000").withColumn("n", F.row_number().over(w)).where("n = 1")
    return over.select("user_id", "event_id", F.round("total", 4).alias("total"))


def _rate_limit(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.window("ts", "60 seconds").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n", (F.col("n") > 2).alias("limited"))


def _sessions(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("units")).select("user_id", F.col("w.start").alias("start"), "n", "units")


def _sliding(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.window("ts", "1 day", "12 hours").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def _trailing_views(spark, d):
    """Per user, day by day: the total of the seven days that end the day before."""
    day = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("user_id").orderBy(F.unix_date("day")).rangeBetween(-7, -1)
    return day.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce(F.sum("n").over(w), F.lit(0)).alias("trailing"))


def _props(spark, d):
    """Sum of a number inside a JSON column, by type."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count(k).alias("k_known"))


QUERIES = {
    "status_counts": _status_counts, "queue_gauge": _queue_gauge, "finished_groups": _finished_groups, "jobs_of_ended_groups": _jobs_of_ended_groups, "group_progress": _group_progress,
    "dequeue_order": _dequeue, "job_listing": _listing, "retention": _retained, "usage_groups": _usage_groups, "usage_periods": _usage_periods, "cost_split": _cost_split, "limit_crossed": _limit_crossed,
    "rate_limit_60s": _rate_limit, "user_sessions": _sessions, "sliding_counts": _sliding, "trailing_views": _trailing_views, "json_sums": _props,
}
_V0 = "coalesce(CASE WHEN isnan(value) THEN 0.0 ELSE value END, 0.0)"
_KINDS = ("click", "error", "purchase")
SQL = {
    "status_counts": f"WITH {_J} SELECT status, count(*) AS n FROM j GROUP BY status UNION ALL SELECT 'backlog', count(*) FROM gr WHERE status = 'active'",
    "queue_gauge": f"WITH {_J} SELECT s.status, count(j.job_id) AS n FROM (VALUES ('queued'), ('active'), ('stalled')) s(status) LEFT JOIN j ON j.status = s.status GROUP BY s.status",
    "finished_groups": f"WITH {_J} SELECT group_id, created_at FROM gr WHERE status = 'active' AND NOT EXISTS (SELECT 1 FROM j WHERE j.group_id = gr.group_id AND j.status IN ('queued', 'active'))",
    "jobs_of_ended_groups": f"WITH {_J} SELECT status, count(*) AS n FROM j WHERE group_id IN (SELECT group_id FROM gr WHERE status <> 'active') GROUP BY status",
    "group_progress": f"WITH {_J}, p AS (SELECT group_id, count(*) AS jobs, count(*) FILTER (WHERE status IN ('completed', 'failed')) AS done, max(finished_at) AS lf FROM j GROUP BY group_id) SELECT gr.group_id, gr.status, coalesce(jobs, 0) AS jobs, coalesce(done, 0) AS done, coalesce(jobs, 0) = coalesce(done, 0) AS all_done, coalesce(lf, gr.created_at) + to_milliseconds(ttl) AS expires FROM gr LEFT JOIN p ON p.group_id = gr.group_id",
    "dequeue_order": "WITH q AS (SELECT job_id, priority, created_at, row_number() OVER (PARTITION BY job_id ORDER BY priority NULLS FIRST, created_at NULLS FIRST) AS n FROM queue_scrape WHERE status = 'queued') SELECT job_id, priority, created_at FROM q WHERE n = 1 ORDER BY priority NULLS FIRST, created_at NULLS FIRST, job_id NULLS FIRST LIMIT 500",
    "job_listing": f"WITH {_J} SELECT job_id, finished_at FROM j WHERE status = 'completed' AND finished_at IS NOT NULL ORDER BY finished_at, created_at NULLS FIRST, job_id LIMIT 50 OFFSET 100",
    "retention": f"WITH {_J}, n AS (SELECT max(finished_at) AS now FROM j) SELECT status, coalesce((status = 'completed' AND finished_at < now - INTERVAL 30 DAY) OR (status = 'failed' AND finished_at < now - INTERVAL 90 DAY), false) AS expired, count(*) AS n FROM j, n GROUP BY 1, 2",
    "usage_groups": "SELECT user_id, event_type, round(sum(value), 6) AS units, count(*) AS ops FROM events GROUP BY user_id, event_type",
    "usage_periods": "SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS start, round(sum(value), 4) AS units, count(DISTINCT user_id) AS users FROM events GROUP BY 1 ORDER BY 1",
    "cost_split": "SELECT user_id, round(sum(" + _V0 + "), 6) AS total, " + ", ".join(f"round(sum(CASE WHEN event_type = '{k}' THEN {_V0} ELSE 0.0 END), 6) AS cost_{k}, count(*) FILTER (WHERE event_type = '{k}') AS n_{k}" for k in _KINDS) + " FROM events GROUP BY user_id",
    "limit_crossed": "WITH r AS (SELECT user_id, event_id, ts, sum(coalesce(value, 0.0)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM events), o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM r WHERE total > 1000) SELECT user_id, event_id, round(total, 4) AS total FROM o WHERE n = 1",
    "rate_limit_60s": "SELECT user_id, time_bucket(INTERVAL 60 SECOND, ts) AS start, count(*) AS n, count(*) > 2 AS limited FROM events GROUP BY 1, 2",
    "user_sessions": "WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS turn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM g) SELECT user_id, min(ts) AS start, count(*) AS n, round(sum(value), 6) AS units FROM s GROUP BY user_id, s.s",
    "sliding_counts": "SELECT start, event_type, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS start, event_type FROM events) GROUP BY 1, 2",
    "trailing_views": "WITH d AS (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, strftime(day, '%Y-%m-%d') AS day, coalesce(sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0)::BIGINT AS trailing FROM d",
    "json_sums": "SELECT event_type, sum(try_cast(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS k_sum, count(try_cast(json_extract_string(props, '$.k') AS BIGINT)) AS k_known FROM events GROUP BY event_type",
}
