"""Session settings the library relies on.

The library never creates a cluster session on its own; ``configure`` applies
the SQL settings whose defaults would change results (ANSI arithmetic, UTC
timestamps, text partition values) and the adaptive-execution settings that
let the runtime pick join strategies from measured sizes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import SparkSession

# SQL settings that change results or plans; applied to every session we touch.
SQL_SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Partition directories such as trade_date=20240102 must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (security_id, trade_date) may reuse a partitioning on security_id
    # alone, so the bar spine, its per-security windows and the security-keyed
    # lookups share one exchange per input.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pitspark", checkpoints: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark (UI off, no ports beyond Spark's own).

    ``checkpoints`` names its checkpoint folder where the Spark configuration names none.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("PITSPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    java_opts = os.environ.get("PITSPARK_DRIVER_JAVA_OPTS")
    if java_opts:
        builder = builder.config("spark.driver.extraJavaOptions", java_opts)
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    if checkpoints and not SparkConf().contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", checkpoints)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


ROWS_A_PARTITION = 250_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Raise the number of shuffle partitions, and with it that of buckets, until one holds about ``ROWS_A_PARTITION`` rows.

    The session's own number stays where it is enough.  With a fixed number a task's sorts grow with the input until they spill;
    the adaptive planner joins partitions that turn out small.
    """
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_A_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which the driver and all executors share.

    There is no fallback: a folder of one machine would lose the other executors' files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return configured


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the commands inside go when a command ends, not when the driver happens to collect its garbage.

    Only for frames that nothing reads a second time: Spark would shuffle them anew.
    """
    with setting(spark, DROP_SHUFFLES, "true"):
        yield


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df):
    """Reliable checkpoint of ``df`` into ``spark.checkpoint.dir`` (eager).

    Used where one intermediate frame feeds many branches of a plan: the
    branches then scan the checkpoint files instead of re-running the shared
    subtree, and a lost executor recomputes from those files.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
