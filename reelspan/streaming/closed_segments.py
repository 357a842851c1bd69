"""Export of segments as their recordings are closed: a stream of files, a batch each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import ExportConfig
from ..plans import episodes


def follow(spark: SparkSession, path: str, schema: str, config: ExportConfig, sink: Callable[[DataFrame, DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run the episode plan on each batch of new signal files below ``path``.

    A file holds whole segments, as recordings do. ``sink(samples, status,
    batch_id)`` may see a batch again after a failure and must replace it by its id.
    """
    if config.cameras:
        raise ValueError("the stream carries no frames, but the configuration names cameras")

    def batch(signals: DataFrame, batch_id: int) -> None:
        built = episodes.build(signals, config)
        sink(built.samples, built.status, batch_id)

    return spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
