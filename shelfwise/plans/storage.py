"""Shared scratch space for jobs.

Intermediate tables are written under the folder the cluster names in
``spark.checkpoint.dir`` (shared storage, survives executor loss).  Only where
the session names none is the caller's fallback folder used; the session's own
settings are never changed.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The session's checkpoint folder, else ``fallback``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or fallback
    if not root:
        raise ValueError("spark.checkpoint.dir is not set and no fallback folder was given")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str, fallback: str | None = None) -> str:
    return f"{checkpoint_root(spark, fallback)}/shelfwise-{label}-{uuid.uuid4().hex[:12]}"


def written_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: several readers share one
    computation, and a lost executor costs no more than a read."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop file system API.  A store that refuses
    leaves the folder behind; the job's result does not depend on it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Py4JJavaError as refused:
        print(f"[WARN] {path} was not removed: {refused.java_exception}")


def parent_of(path: str, levels: int = 1) -> str:
    parts = path.rstrip("/").split("/")
    return "/".join(parts[:-levels]) or "/"
