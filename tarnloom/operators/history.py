"""What was known before: change status, as-of and interval lookups, cache picks, take-while and running cuts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


_IFRAME = re.compile(r"<iframe[^>]*>")
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")


@F.pandas_udf(StringType())
def text_signature(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Equal for texts with the same signs in any order, white space and iframe marks apart: a hash of the sorted signs."""

    def sign(text: str | None) -> str | None:
        if text is None:
            return None
        signs = np.frombuffer(_BLANKS.sub("", _IFRAME.sub("", text)).encode("utf-32-le", "surrogatepass"), "<u4")
        return blake2b(np.sort(signs).tobytes(), digest_size=16).hexdigest()

    for b in batches:
        yield b.map(sign, na_action="ignore").astype(object)


def change_status(versions: DataFrame, key: str, order: list[str], text: str = "markdown", status: str = "status_code") -> DataFrame:
    """Adds `change`: new, same, changed or removed (404), against the last earlier version of the key that has text."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    signed = versions.withColumn("_s", F.when(F.length(F.trim(F.col(text))) > 0, text_signature(F.col(text))))
    before = F.last("_s", ignorenulls=True).over(w)
    change = F.when(F.col(status) == 404, "removed").when(before.isNull(), "new").when(F.col("_s") == before, "same").otherwise("changed")
    return signed.withColumn("change", change).drop("_s")


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: list[str]) -> DataFrame:
    """Each left row with the values of the latest right row of its key at or before its time (NULL where none).

    One union and one window over (key, time) instead of a join on inequalities: linear in the rows of a key.
    """
    cols = left.columns
    a = left.select(*cols, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *(F.lit(None).cast(right.schema[v].dataType).alias(f"_v_{v}") for v in value), F.lit(None).cast(right.schema[right_time].dataType).alias("_v_time"))
    b = right.select(*(F.col(key) if c == key else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), *(F.col(v).alias(f"_v_{v}") for v in value), F.col(right_time).alias("_v_time"))
    w = Window.partitionBy(key).orderBy("_t", "_side", *(f"_v_{v}" for v in value)).rowsBetween(Window.unboundedPreceding, 0)
    packed = F.struct(*(F.col(f"_v_{v}").alias(v) for v in value), F.col("_v_time").alias(right_time))
    both = a.unionByName(b).withColumn("_last", F.last(F.when(F.col("_side") == 0, packed), ignorenulls=True).over(w))
    return both.where("_side = 1").select(*cols, *(F.col(f"_last.{v}").alias(v) for v in value), F.col(f"_last.{right_time}").alias(f"as_of_{right_time}"))


def newest_good(rows: DataFrame, key: str, order: list[Column], good: Column, within: int = 3) -> DataFrame:
    """Per key the newest good row if it is among the `within` newest, else the newest row. Adds `position` (0 first)."""
    w = Window.partitionBy(key).orderBy(*order)
    near = rows.withColumn("position", F.row_number().over(w) - 1).where(F.col("position") < within)
    pick = Window.partitionBy(key).orderBy(F.when(good, 0).otherwise(1), "position")
    return near.withColumn("_n", F.row_number().over(pick)).where("_n = 1").drop("_n")


def within_interval(events: DataFrame, facts: DataFrame, key: str, at: str, time: str, back: str, most: int) -> DataFrame:
    """Per event the `most` newest facts of its key in (at - back, at]; one row per pair with `rank`.

    Joined on key and slot of time, so a busy key does not pair all its events with all its facts. NULL times match nothing.
    """
    mine = [c for c in facts.columns if c != key]
    # times are cut into slots as long as the interval: what an event asks for lies in its own slot or the one before
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    slot = lambda c: F.floor(micros(F.col(c)) / (micros(zero + F.expr(f"interval {back}")) - micros(zero)))
    wanted = events.select(*events.columns, F.explode(F.array(slot(at), slot(at) - 1)).alias("_slot"))
    held = facts.select(key, slot(time).alias("_slot"), *(F.col(c).alias(f"fact_{c}") for c in mine))
    near = wanted.join(held, [key, "_slot"]).drop("_slot").where(F.expr(f"fact_{time} <= {at} and fact_{time} > {at} - interval {back}"))
    w = Window.partitionBy(*(F.col(c) for c in events.columns)).orderBy(F.desc(f"fact_{time}"), *(f"fact_{c}" for c in mine))
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


def take_while(rows: DataFrame, key: str | None, order: list[str], condition: Column, with_crossing: bool = False) -> DataFrame:
    """Rows before the first that fails the condition, per key, in order; a NULL condition fails.

    With with_crossing the row that fails first is kept too. Without a key the first failing place is found by an
    aggregate, so no task sorts all rows.
    """
    fails = ~F.coalesce(condition, F.lit(False))
    if key is None:
        place = F.struct(*order)
        first = rows.agg(F.min(F.when(fails, place)).alias("_f"))  # one row
        before = place <= F.col("_f") if with_crossing else place < F.col("_f")
        return rows.crossJoin(F.broadcast(first)).where(F.col("_f").isNull() | before).drop("_f")
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if with_crossing else 0)
    failed = F.coalesce(F.max(fails.cast("int")).over(w), F.lit(0))
    return rows.withColumn("_f", failed).where("_f = 0").drop("_f")


def byte_cut(rows: DataFrame, key: str, order: list[str], size: Column, limit: int) -> DataFrame:
    """Rows of a page of at most `limit` bytes: up to the row that overflows, which is dropped unless it is the first."""
    w = Window.partitionBy(key).orderBy(*order)
    upto = rows.withColumn("bytes", size).withColumn("running", F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.row_number().over(w))
    return upto.where((F.col("running") <= limit) | (F.col("_n") == 1)).drop("_n")


def runs(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Consecutive rows of equal value (NULL equals NULL): key, run_no, value, n_rows, first and last of the first order column."""
    w = Window.partitionBy(key).orderBy(*order)
    turn = F.when(F.row_number().over(w) == 1, 1).when(F.lag(value).over(w).eqNullSafe(F.col(value)), 0).otherwise(1)
    marked = rows.withColumn("_turn", turn).withColumn("run_no", F.sum("_turn").over(w))
    return marked.groupBy(key, "run_no", value).agg(F.count("*").alias("n_rows"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))
