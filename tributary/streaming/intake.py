"""Incremental intake of catalog updates: a file stream that is drained and upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.catalog import upsert_latest
from ..sources.buckets import BUCKETS, upsert_buckets
from ..sources.io import read_catalog, write_catalog


def drain_updates(spark: SparkSession, updates: str, schema: str, catalog: str, checkpoint: str) -> None:
    """Apply all update files not applied before. A batch that is repeated after a failure gives the same catalog."""

    def apply(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            write_catalog(upsert_latest(read_catalog(spark, catalog), batch), catalog)

    spark.readStream.schema(schema).parquet(updates).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start().awaitTermination()


def drain_into_buckets(spark: SparkSession, updates: str, schema: str, catalog: str, checkpoint: str, key: str = "asset_id", buckets: int = BUCKETS) -> None:
    """As ``drain_updates``, into a table of ``sources.buckets``: a batch rewrites the buckets of its keys, so what is written follows the batch and not the catalog."""

    def apply(batch: DataFrame, _: int) -> None:
        upsert_buckets(batch, catalog, key, buckets)

    spark.readStream.schema(schema).parquet(updates).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(apply).start().awaitTermination()
