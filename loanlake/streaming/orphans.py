"""Orphan flags of a payment stream whose installments may land after it.

A payment whose installment is not there yet is held, not flagged: the two streams meet in an outer join on the
installment id, and a payment comes out as an orphan only once the watermark says that its installment can no
longer land within ``wait``. Both sides' state is bounded: payments leave it when they match or their wait is over,
installments when no payment can reach back to them (``reach`` after they landed). The query's checkpoint
holds state and progress, so a restart goes on where the last micro-batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle_orphans(payments: DataFrame, installments: DataFrame, landed_at: str = "landed_at", wait: str = "3 days",
                   reach: str = "730 days", delay: str = "1 hour") -> DataFrame:
    """The payments of a stream, each once, with ``orphan_installment``.

    ``payments`` has ``installment_id`` and ``loaded_at``, ``installments`` has ``installment_id`` and its stamp
    ``landed_at``; rows of either may be up to ``delay`` older than the newest one seen before. Spark's watermark
    drops older ones from a stream: choose ``delay`` by the landing process, or load such rows with the incremental
    job, which takes rows of any age. A payment is no orphan if
    its installment lands at most ``wait`` after it, or landed at most ``reach`` before. A payment
    without an installment id is no orphan and waits for nothing, like one without a stamp, which cannot wait: it
    is an orphan if it has an id. An installment that lands again within ``delay`` counts once.
    """
    columns = payments.columns
    waits = F.col("installment_id").isNotNull() & F.col("loaded_at").isNotNull()
    known = (installments.where(f"installment_id IS NOT NULL AND {landed_at} IS NOT NULL")
             .select(F.col("installment_id").alias("_id"), F.col(landed_at).cast("timestamp").alias("_landed"))
             .withWatermark("_landed", delay).dropDuplicatesWithinWatermark(["_id"]))
    # the watermark is told by all payments, so the filter looks at it: Spark moves one that does not below it
    timed = payments.withColumn("_at", F.col("loaded_at").cast("timestamp")).withWatermark("_at", delay)
    held = timed.where(F.when(F.col("_at").isNull(), F.lit(False)).otherwise(F.col("installment_id").isNotNull()))
    met = held.join(known, F.expr(
        f"installment_id = _id AND _landed <= _at + INTERVAL {wait} AND _landed >= _at - INTERVAL {reach}"), "left_outer")
    settled = met.select(*columns, F.col("_id").isNull().alias("orphan_installment"))
    at_once = payments.where(~waits).select(*columns, F.col("installment_id").isNotNull().alias("orphan_installment"))
    return settled.unionByName(at_once)


def write_settled(settled: DataFrame, path: str, checkpoint: str):
    """Append what is settled by now to the Parquet table at ``path`` (exactly once, by the sink's own log) and
    stop when all input that is there has been read."""
    query = (settled.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query
