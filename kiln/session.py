"""Session helpers: a tuned local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every kiln job relies on. Cluster sessions keep their own values for anything set
# by the operator; these are only applied when kiln builds the session itself.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "kiln", shuffle_partitions: int | None = None,
              driver_memory: str = "8g") -> SparkSession:
    """Return the active session, or build a local one with kiln's defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app).master(master or "local[8]")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (it must be on shared
    storage; kiln refuses to run without it). Only a local-mode session without one – a test
    run – gets a folder under the system temp directory, registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: kiln writes "
                               "intermediate tables and streaming state there")
        conf_dir = tempfile.mkdtemp(prefix="kiln-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch folder."""
    base = scratch_dir(spark)
    return base.rstrip("/") + f"/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint in the shared folder.

    Used where a result feeds several later jobs and recomputing it would repeat a shuffle;
    a reliable checkpoint survives executor loss, unlike a local one.
    """
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def spread(df: DataFrame, min_bytes: int = 8 << 20) -> DataFrame:
    """Spread a large input that arrives in fewer files than there are cores.

    A file with one row group is read by one task, and every per-row step before the first
    shuffle (tokenising, parsing) then runs in that task too. Such an input is repartitioned
    round-robin to the session's parallelism; inputs already split over many files – the normal
    case on a cluster – and small inputs are returned unchanged.
    """
    sc = df.sparkSession.sparkContext
    par = sc.defaultParallelism
    try:
        files = len(df.inputFiles())
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001  (statistics unavailable: leave the plan alone)
        return df
    if files >= par or size < min_bytes:
        return df
    return df.repartition(par)
