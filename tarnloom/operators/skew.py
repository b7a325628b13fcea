"""Problem 7: per-key results although a few keys hold most records.

Heavy keys are found with a sketch of fixed size (counts per hash bucket: a key that holds a share of the rows lies
in a bucket that holds at least as much, so none is missed), then confirmed by an exact count of the few keys in
those buckets. Their rows meet the key's attributes by broadcast join (at most 1/share keys) and are aggregated in
salted parts; all other rows take an ordinary shuffle; the two results are united.

Defined results: repeated deliveries of a job_id count once, with the values of the latest one (by finished_at,
locked_at, created_at, then status and stalls; the keys are those of that delivery); NULL or blank keys form no key; NULL
job_id rows are left out; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnloom.session import materialize

SHARE = 0.02
BUCKETS = 4096
SALTS = 32
FIELDS = ("owner_id", "group_id")


def clean_key(key: Column) -> Column:
    """Trimmed, lower case; NULL when blank."""
    k = F.lower(F.regexp_replace(key, r"(?U)^\s+|\s+$", ""))
    return F.when(k != "", k)


def distinct_jobs(queue: DataFrame) -> DataFrame:
    """One row per job_id: its latest delivery, keys cleaned. job_id is spread evenly, so this shuffle is too."""
    value = F.struct(
        "status",
        "created_at",
        "locked_at",
        "finished_at",
        F.coalesce("stalls", F.lit(0)).alias("stalls"),
        *(clean_key(F.col(f)).alias(f) for f in FIELDS),
    )
    order = F.struct(F.coalesce("finished_at", "locked_at", "created_at"), "status", F.coalesce("stalls", F.lit(0)), "created_at", *(clean_key(F.col(f)) for f in FIELDS))
    return queue.where(F.col("job_id").isNotNull()).groupBy("job_id").agg(F.max_by(value, order).alias("v")).select("job_id", "v.*")


def job_keys(queue: DataFrame) -> DataFrame:
    """Every distinct (job_id, owner_id, group_id) as cleaned."""
    return queue.where(F.col("job_id").isNotNull()).select("job_id", *(clean_key(F.col(f)).alias(f) for f in FIELDS)).distinct()


def heavy_keys(jobs: DataFrame, share: float = SHARE, buckets: int = BUCKETS) -> DataFrame:
    """key_field, key_value, n_jobs of each key carried by at least `share` of all distinct jobs.

    jobs: a table with job_id and the fields, a job_id once for each combination of keys it carries.
    """
    bucket = lambda f: F.pmod(F.xxhash64(f), F.lit(buckets))
    sketch = (
        jobs.select(F.explode(F.array(*(F.struct(F.lit(f).alias("key_field"), F.when(F.col(f).isNotNull(), bucket(f)).alias("bucket")) for f in FIELDS))).alias("k"))
        .groupBy("k.key_field", "k.bucket")
        .agg(F.count("*").alias("n"))
    )
    rows = sketch.collect()  # at most fields × (buckets + 1) rows, whatever the input
    total_rows = sum(r["n"] for r in rows if r["key_field"] == FIELDS[0])
    total = jobs.agg(F.count_distinct("job_id").alias("n")).first()["n"] if total_rows else 0
    parts = []
    for f in FIELDS:
        hot = [r["bucket"] for r in rows if r["key_field"] == f and r["bucket"] is not None and r["n"] >= share * total]
        parts.append(jobs.where(bucket(f).isin(hot) if hot else F.lit(False)).select(F.lit(f).alias("key_field"), F.col(f).alias("key_value"), "job_id"))
    candidates = parts[0].unionAll(parts[1])
    # A job_id counts once per key: pre-aggregated by (key, salt of the job), never one task per key.
    salted = candidates.groupBy("key_field", "key_value", F.pmod(F.xxhash64("job_id"), F.lit(SALTS)).alias("salt")).agg(F.count_distinct("job_id").alias("n"))
    return salted.groupBy("key_field", "key_value").agg(F.sum("n").alias("n_jobs")).where(F.col("n_jobs") >= F.lit(share * total))


def found(queue: DataFrame) -> DataFrame:
    """p7_found: key_field, key_value."""
    jobs = materialize(job_keys(queue), "job-keys")
    return heavy_keys(jobs).select("key_field", "key_value")


def _credits() -> Column:
    """Credits of a job: one per completed job, none for others."""
    return (F.col("status") == "completed").cast("bigint")


def _sums() -> list[Column]:
    took = F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp"))
    return [
        F.count("*").alias("n_jobs"),
        *(F.sum((F.col("status") == s).cast("bigint")).alias(f"n_{s}") for s in ("queued", "active", "completed", "failed")),
        F.sum(_credits()).alias("credits"),
        F.sum("stalls").alias("stalls"),
        F.sum(F.when(took >= 0, took)).alias("took_us"),
        F.sum((took >= 0).cast("bigint")).alias("n_timed"),
        F.min("created_at").alias("first_created"),
        F.max("finished_at").alias("last_finished"),
    ]


def _merge() -> list[Column]:
    add = ["n_jobs", "n_queued", "n_active", "n_completed", "n_failed", "credits", "stalls", "took_us", "n_timed"]
    return [*(F.sum(c).cast("bigint").alias(c) for c in add), F.min("first_created").alias("first_created"), F.max("last_finished").alias("last_finished")]


def per_key(queue: DataFrame, field: str, share: float = SHARE) -> DataFrame:
    """Per value of `field`: jobs by status, credits, stalls, times, and how large the key is among all jobs.

    Heavy keys: broadcast join to the (at most 1/share) heavy keys, aggregated by (key, salt), then merged.
    Others: an ordinary shuffle on the key. Both are united.
    """
    jobs = materialize(distinct_jobs(queue), "jobs")
    heavy = heavy_keys(jobs, share).where(F.col("key_field") == field).select(F.col("key_value").alias(field)).collect()
    keys = [r[field] for r in heavy]  # at most 1/share values
    spark = queue.sparkSession
    table = F.broadcast(spark.createDataFrame([(k, True) for k in keys], f"`{field}` string, heavy boolean"))
    known = jobs.where(F.col(field).isNotNull()).join(table, field, "left")
    salt = F.pmod(F.xxhash64("job_id"), F.lit(SALTS))
    hot = known.where("heavy").groupBy(field, salt.alias("salt")).agg(*_sums()).groupBy(field).agg(*_merge()).withColumn("heavy", F.lit(True))
    rest = known.where("heavy is null").groupBy(field).agg(*_sums()).withColumn("heavy", F.lit(False))
    both = hot.unionByName(rest)
    mean = F.when(F.col("n_timed") > 0, F.round(F.col("took_us") / F.col("n_timed") / F.lit(1e6), 3)).alias("mean_seconds")
    return both.select(field, "heavy", "n_jobs", "n_queued", "n_active", "n_completed", "n_failed", "credits", "stalls", mean, "first_created", "last_finished")
