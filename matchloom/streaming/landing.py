"""Landed shards folded into a fact as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import facts
from ..sources import schemas
from ..sources.fact_store import FactStore
from ..sources.landing import small_reads, unsorted_folders


def fold(spark: SparkSession, landing: str, patches: DataFrame, out: str, checkpoint: str, fact=facts.players) -> None:
    """Reads the shards that are new since the last call and appends their rows to the fact at `out`, by patch. The release table is static:
    after a change to it, publish the facts anew, or use fold_into and restate the store, also for more
    releases than asof broadcasts. Exactly once, by the checkpoint and the sink's own log."""
    raw = spark.readStream.schema(schemas.RAW).option("mode", "FAILFAST").json(landing)
    writer = fact(raw, patches).writeStream.format("parquet").partitionBy("patch").option("compression", "zstd").option("path", out)
    with unsorted_folders(spark), small_reads(spark):  # the stream takes the session's settings when it starts
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start().awaitTermination()


def fold_into(store: FactStore, landing: str, patches: DataFrame, checkpoint: str, fact=facts.players) -> None:
    """fold into a store that can be restated after a change to the release table. Exactly once: the store takes each batch by its number."""
    raw = store.spark.readStream.schema(schemas.RAW).option("mode", "FAILFAST").json(landing)
    writer = raw.writeStream.foreachBatch(lambda rows, batch: store.append(fact(rows, patches), batch))
    with small_reads(store.spark):
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
