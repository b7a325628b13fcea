"""Session defaults and the shared folder in which lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings for a session that this library starts itself; a session that is handed in keeps its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_written: list[tuple[SparkSession, str]] = []


def local_session(cores: int = 8, memory: str = "8g", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tarnloom").config("spark.driver.memory", memory)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores)).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Only a local master may fall back to a temporary folder of the machine; on a cluster an unset
    folder is an error, since no other executor could read what one wrote.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="tarnloom-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed with the tables of this process."""
    path = f"{shared_folder(spark)}/tarnloom/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write df once to the shared folder and read it back: a short lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


@atexit.register
def _remove_written() -> None:
    """Drop the tables this process wrote; results may still read them until it ends."""
    for spark, path in _written:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session is gone: nothing is left to ask
            return
