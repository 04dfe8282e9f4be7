"""Session preparation."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers of a single-machine session import this package from
    where the driver has it. On a cluster the package is installed on every node
    or passed with ``--py-files``. Batches for Python are bounded in bytes unless
    the session says how large they may be."""
    # Arrow batches by bytes, so a worker's memory doesn't follow the length of texts
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, 4 << 20)
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, have)])
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that ``spark.checkpoint.dir`` names, which all
    executors reach; only in a local session that names none, a temporary one. It goes
    when the session ends."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="siftloom-")
        sc.setCheckpointDir(root)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/siftloom/{name}-{uuid.uuid4().hex}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()
