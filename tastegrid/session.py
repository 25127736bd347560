"""Session helpers: a local session for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **conf) -> SparkSession:
    """Session for one machine.  On a cluster the submitter brings the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tastegrid")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tastegrid-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tastegrid/{label}-{uuid.uuid4().hex}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives lost executors, and (unlike an RDD checkpoint) the reread is columnar:
    later consumers read only their columns and the planner sees real sizes.  The shuffle files of the
    write are removed as soon as it is done: nothing reads them again, and else they stay until the
    driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("error").parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, amount: int, share: int) -> int:
    """Partitions for ``amount`` rows or products at ``share`` a task, no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(amount) // share))


def tasks_beyond(spark: SparkSession, rows: int, share: int) -> int:
    """Partitions for ``rows`` at ``share`` a task; 0 if that is no more than adaptive execution leaves anyway.

    However many shuffle partitions the session has, adaptive execution joins small ones until each
    core has one, so the rows of a task would grow with the table up to its advisory size in bytes,
    which is millions of narrow rows.
    """
    tasks = -(-int(rows) // share)
    left = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return tasks if tasks > left else 0


ROWS = 300_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as ``rows`` at ``ROWS`` a task need; as it is if that is no more than a task for each core.

    For sorts and aggregates of nearly distinct keys, whose memory grows with the rows of a task.
    """
    tasks = tasks_beyond(df.sparkSession, rows, ROWS)
    return df.repartition(tasks, *keys) if tasks else df
