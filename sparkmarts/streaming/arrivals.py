"""Load the order facts as new order files land, with Structured Streaming.

A file stream over the landing folder of raw orders feeds ``foreachBatch``.
Every arriving order is loaded, whatever its date: a micro-batch's orders are
enriched and rolled up with their own lines, then replace or extend the stored
facts by key. The stream's checkpoint records which files were processed, so
a replayed micro-batch applies the same keyed replacement again and the facts
end up as after one clean run. Empty micro-batches are skipped. Line items,
customers and the other tables are listed anew for each micro-batch; an order's
lines must have landed with or before it (an order that arrives again takes the
lines that have landed since)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from sparkmarts.operators import staging
from sparkmarts.plans import loads
from sparkmarts.plans.warehouse import Warehouse


def start_order_fact_stream(
    spark: SparkSession,
    warehouse: Warehouse,
    landing_orders_dir: str,
    out_root: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    schema: StructType | str | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed
    and stops (``query.awaitTermination()``), else it keeps running.
    ``schema``: the raw orders schema; taken from the landed files when not
    given (the folder must then hold at least one file)."""
    if schema is None:
        schema = spark.read.parquet(landing_orders_dir).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_orders_dir)
    out = out_root.rstrip("/")

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        wh = warehouse.fresh()
        orders = wh.enrich_orders(staging.stage(batch, "orders", wh.fill_missing))
        loads.store_fct_orders(spark, orders, wh.line_items, f"{out}/fct_orders", True)
        more = (True, wh.enrich_line_items)
        loads.store_fct_order_items(spark, orders, wh.line_items, f"{out}/fct_order_items", *more)
        loads.store_fct_returns(spark, orders, wh.line_items, f"{out}/fct_returns", *more)

    writer = stream.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
