"""Sinks: partitioned JSON, append-only tables, idempotent micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_packages(packages: DataFrame, root: str) -> None:
    """One folder per agent_type and task_id."""
    packages.write.mode("append").partitionBy("agent_type", "task_id").json(root)


def append_rows(rows: DataFrame, path: str) -> None:
    """Appends without reading what is there."""
    rows.write.mode("append").parquet(path)


def idempotent_batches(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that overwrites the batch's own folder: a repeated batch leaves one copy."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def new_keys(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows with a valid key (a UUID) not known yet, one of each."""
    ok = F.col(key).rlike(r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[1-8][0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}$")
    return rows.where(ok).dropDuplicates([key]).join(known.select(key).distinct(), key, "left_anti")


def write_steps(steps: DataFrame, root: str, run: str = "run_id") -> None:
    """Traces of runs: one folder a run, one JSON line a step, in the order of `seq`."""
    steps.repartition(run).sortWithinPartitions(run, "seq").write.mode("append").partitionBy(run).json(root)
