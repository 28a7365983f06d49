"""What the operators of this subpackage share: tables, names of columns, and cutting lineage in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import materialise, shared_dir

__all__ = ["materialise", "numbered", "restored", "shared_dir", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ..., so none clashes with those that an operator adds, whatever their names."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns c0, c1, ... of ``rows`` under the names of ``docs``."""
    return rows.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
