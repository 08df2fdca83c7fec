"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "civicspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the library is planned around.

    Adaptive execution decides broadcast sides from measured sizes and splits skewed
    join partitions, so no operator here carries a broadcast hint.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.showConsoleProgress": "false",
        # Certificates have some ninety columns; without this the JVM leaves the large
        # methods Spark generates for them uncompiled.
        "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, reachable from every executor.

    ``spark.checkpoint.dir`` names it.  Only a local session without that setting gets
    a folder of its own; a cluster without it is an error, because a machine-local
    folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="civicspark-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table of this library once nothing reads it any more."""
    if not path.startswith(shared_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (runs a job): later stages re-read it if an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
