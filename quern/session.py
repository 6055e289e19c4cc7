"""Session helpers shared by the whole package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: Python workers give large freed blocks back to the system, rather than keep them for later.
WORKER_MEMORY = {"MALLOC_ARENA_MAX": "2", "MALLOC_MMAP_THRESHOLD_": "2097152", "MALLOC_TRIM_THRESHOLD_": "8388608", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quern")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers and give the session a checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as it is; a temporary one is set only
    where the setting is missing on a single machine, and on a cluster that is an error.
    """
    context = spark.sparkContext
    context.environment.update(WORKER_MEMORY)
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quern-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/quern-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return it reread: lineage ends there."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table that ``materialize`` wrote for ``df``; nothing that is still to run may read it."""
    remove(df.sparkSession, df._written_at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in a task for each core at least, for callers whose work on a row costs far more than to move it.

    Rows of a table that has as many tasks as there are cores, as any large one has, stay where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
