"""Session, folder and column helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import prepare


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the session names it in
    ``spark.checkpoint.dir``. Only where that is unset (single-machine tests)
    is a fresh folder made and set."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="siftloom-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/siftloom/{name}-{uuid.uuid4().hex}"


def expire(spark: SparkSession, path: str) -> None:
    """Let a path go when the session ends, if nobody removes it before."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back: later stages don't
    depend on executors that may be lost. Returns the table and its path. Results
    are lazy and may still read it, so it goes when the session ends, or earlier
    by :func:`remove`."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    expire(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def positional(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """Rename columns to ``_c0.._cn`` so that no extra column of a caller can
    clash with a working column, whatever its name or case. Returns the renamed
    frame and the working names of ``names``."""
    prepare(df.sparkSession)
    for n in names:
        if n not in df.columns:
            raise ValueError(f"column {n!r} is missing")
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), [f"_c{df.columns.index(n)}" for n in names]


def identity(doc_id: str, text: str):
    """64-bit identity of a document: of its id, or of its text where the id is
    null, so that rows of one id count as one document."""
    return F.when(F.col(doc_id).isNotNull(), F.xxhash64(F.lit(0), F.col(doc_id))).otherwise(
        F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit("")))
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
