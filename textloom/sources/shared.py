"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids that are broadcast at most; longer lists are joined by shuffle.
BROADCAST_IDS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; where it is unset, a fresh local folder under a local master, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isEmpty():
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
            found = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = found.get()
    return path


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: later plans see one fixed result and no lineage."""
    path = f"{shared_dir(df.sparkSession)}/textloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_batches(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (on a cluster without that path, --py-files
    does), and bound Arrow batches to 4 MB where their bound has its default."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "67108864", "67108864b", "64m", "64MB"):
        spark.conf.set(key, "4m")


def semi(df: DataFrame, ids: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of df whose key is among the n ids."""
    return df.join(F.broadcast(ids) if n <= BROADCAST_IDS else ids, key, "left_semi")
