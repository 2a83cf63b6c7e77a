"""Session settings and the reliable checkpoint used by the iterative operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # files go when the frames that need them go
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the submitter brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cartloom")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master == "local" or context.master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="cartloom-checkpoint-")  # one process: driver and tasks share its disk
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that a lost executor costs no recomputation."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"
