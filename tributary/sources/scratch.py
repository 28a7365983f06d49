"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where that is unset, a temporary folder serves in local mode; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _LOCAL[app] = tempfile.mkdtemp(prefix="tributary-")
    return _LOCAL[app]


def materialise(df: DataFrame, label: str, replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, so no later step depends on a lost executor.

    ``replaces`` is a table made here that nothing reads any more once the new one is written; its files are deleted.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if replaces is not None:
        _drop(replaces)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def _drop(made: DataFrame) -> None:
    spark = made.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(made.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
