"""Helpers shared by the training-data operators: shared storage, size-checked broadcasts, hashing."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an id list that may be broadcast: a hashed relation takes some tens of bytes a row, so about 10 MB at most.
#: Larger lists are joined by shuffle.
BROADCAST_IDS = 200_000

#: Bytes of an Arrow batch sent to a Python worker (at least one row each); memory then follows the longest row.
BATCH_BYTES = "4m"


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; on a cluster without that path, --py-files does."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by bytes, unless they are bounded lower already."""
    reach_workers(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "67108864", "67108864b", "64m", "64MB"):
        spark.conf.set(key, BATCH_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's spark.checkpoint.dir. If it is unset, a fresh local one
    under a local master, as in tests, and an error on a cluster, whose executors couldn't see it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="textloom-")
        spark.sparkContext.setCheckpointDir(path)
        return shared_dir(spark)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back; cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._textloom_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables made by materialise() that no later plan reads."""
    for df in frames:
        path = getattr(df, "_textloom_path", None)
        if path:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def semi_by_id(df: DataFrame, ids: DataFrame, key: str, n_ids: int | None = None) -> DataFrame:
    """Rows of df whose key is in ids; the id list is broadcast only when its counted size is within BROADCAST_IDS."""
    n = ids.count() if n_ids is None else n_ids
    side = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    return df.join(side, key, "left_semi")


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it, so that df has no such column in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def strings(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit words."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def pieces(offsets: np.ndarray, limit: int):
    """(first, last) row ranges whose texts together hold at most limit bytes; a longer single text is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
