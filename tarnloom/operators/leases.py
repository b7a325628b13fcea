"""Backlogs and limits of running jobs: promotion, slots per team and crawl, leases that run out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def promoted(queue: DataFrame, backlog: DataFrame, ids: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(jobs to insert, backlog that is left): asked-for jobs leave the backlog, those whose id the queue lacks enter it.

    Jobs of the backlog that have timed out leave it without entering the queue. All tables have id; backlog has
    times_out_at (NULL for never).
    """
    live = backlog.where(F.col("times_out_at").isNull() | (F.col("times_out_at") > now))
    asked = live.join(ids.select("id").distinct(), "id", "left_semi")
    return asked.join(queue.select("id").distinct(), "id", "left_anti"), live.join(ids.select("id").distinct(), "id", "left_anti")


def started(waiting: DataFrame, active: DataFrame, limits: DataFrame, now: Column, crawl_limits: DataFrame | None = None) -> DataFrame:
    """Waiting jobs that may start: as many per team, and per crawl with a limit, as live leases leave free.

    waiting: id, team, crawl, expires (jobs that have waited too long are dropped); active: id, team, crawl, expires;
    limits: team, slots; crawl_limits: crawl, slots (a crawl with a delay has 1). The soonest to expire start first.
    """
    live = lambda df: df.where(F.col("expires") >= now)
    rows = live(waiting)
    order = ["expires", "id"]
    if crawl_limits is not None:
        used = live(active).where("crawl is not null").groupBy("crawl").agg(F.count("*").alias("used"))
        free = crawl_limits.select("crawl", "slots").join(used, "crawl", "left").select("crawl", (F.col("slots") - F.coalesce("used", F.lit(0))).alias("_c"))
        bound, open_ = rows.join(free, "crawl"), rows.join(free, "crawl", "left_anti")
        place = F.row_number().over(Window.partitionBy("crawl").orderBy(*order))
        rows = bound.withColumn("_p", place).where("_p <= _c").select(*rows.columns).unionByName(open_)
    used = live(active).groupBy("team").agg(F.count("*").alias("used"))
    free = limits.select("team", "slots").join(used, "team", "left").select("team", (F.col("slots") - F.coalesce("used", F.lit(0))).alias("_t"))
    place = F.row_number().over(Window.partitionBy("team").orderBy(*order))
    return rows.join(free, "team").withColumn("place", place).where("place <= _t").select("id", "team", "crawl", "place")


def lease_counts(leases: DataFrame, plans: DataFrame, now: Column) -> DataFrame:
    """Per team: active and waiting leases that are live, and the larger of its two plans' slots. leases: team, kind, expires; plans: team, slots, other_slots."""
    live = leases.where(F.col("expires") >= now).groupBy("team").agg(F.count_if(F.col("kind") == "active").alias("active"), F.count_if(F.col("kind") == "waiting").alias("waiting"))
    most = F.greatest(F.coalesce("slots", F.lit(0)), F.coalesce("other_slots", F.lit(0)))
    return plans.join(live, "team", "left").select("team", F.coalesce("active", F.lit(0)).alias("active"), F.coalesce("waiting", F.lit(0)).alias("waiting"), most.alias("max_concurrency"))


def apply_lease_events(held: dict[str, float], events: list[tuple[float, str, str]], slots: int, ttl: float = 30.0) -> tuple[dict[str, float], list[tuple[float, str, str, bool]]]:
    """Holders of a team's semaphore (holder → when its lease ends) after events (time, kind, holder) in order, and each event's answer.

    acquire succeeds while fewer than `slots` leases are live, and renews its own; beat extends a lease that is live;
    release ends one.
    """
    out = []
    for at, kind, holder in sorted(events):
        held = {h: end for h, end in held.items() if end > at}
        ok = holder in held if kind in ("beat", "release") else holder in held or len(held) < slots
        if kind == "release":
            held.pop(holder, None)
        elif ok:
            held[holder] = at + ttl
        out.append((at, kind, holder, ok))
    return held, out
