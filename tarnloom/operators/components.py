"""Connected components of an edge list, distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnloom.session import materialize


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, component (its least node) for every node of an edge table (a, b).

    Alternating large-star and small-star rounds: each node's neighbours are hung on the least node among them until
    nothing changes; the number of rounds grows with the logarithm of the longest path. Every round is written to the
    shared folder, so plans stay short and survive lost executors. Neither edges nor components reach the driver.
    Defined results: NULL ends and self-loops are left out, repeated edges count once, an empty table gives no rows.
    """
    e = edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "edges")
    state = _state(e)
    for _ in range(max_rounds):
        e = materialize(_small_star(_large_star(e)), "edges")
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    tree = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tree.unionAll(tree.select(F.col("component").alias("node"), "component")).distinct()


def _state(e: DataFrame) -> tuple:
    r = e.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")).first()
    return r["n"], r["h"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return hung.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
