"""Session helpers: local sessions for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spellcast")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Joins on the row key reuse the provider partitioning of the look-back frames.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Candidate fits that run at the same time share the cores.
        .config("spark.scheduler.mode", "FAIR")
        # Checkpoints of results that nothing refers to any more are deleted.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    A session inside one machine without it gets a temporary folder; on a cluster that is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if shared is None:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="spellcast-checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the session's reliable checkpoint folder (see ``shared_folder``)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder by columns, for wide rows: much smaller than a checkpoint."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
