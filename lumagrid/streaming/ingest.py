"""Incremental ingest of images into the image table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lumagrid.sources import table


def ingest_stream(
    images: DataFrame, path: str, checkpoint: str, buckets: int = table.BUCKETS, order: str | None = None
) -> StreamingQuery:
    """Take what has arrived into the table at ``path`` and stop.

    Each micro-batch is an upsert by key, published under a mark made of the query's id, which its checkpoint keeps, and
    the number of the batch. A batch that is replayed after a failure finds its mark and writes nothing, and an
    empty one writes nothing either. ``order`` names the column that decides between rows
    of one key in a batch; without it a batch that repeats a key fails.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query_id = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        table.ingest(spark, path, batch, buckets, order, f"{query_id.replace('-', '')}.{number}")

    return (
        images.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
