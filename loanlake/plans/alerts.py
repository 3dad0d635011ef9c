"""Operational datasets: zero-activity days and per-stage row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _calendar(df: DataFrame, day: str) -> DataFrame:
    """Every calendar day between the min and max of ``day`` (one row per day; the size is bounded
    by the date span, not by the data volume)."""
    bounds = df.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi")).alias("day"))


def zero_activity_days(disb_daily: DataFrame, coll_daily: DataFrame) -> DataFrame:
    """Days inside each activity's own date range with no disbursement / no collection."""
    def gaps(active: DataFrame, day: str, kind: str) -> DataFrame:
        days = active.select(F.col(day).alias("day")).distinct()
        return (_calendar(active, day).join(days, "day", "left_anti")
                .select(F.lit(kind).alias("kind"), "day"))
    return (gaps(disb_daily, "disbursement_date", "disbursement")
            .unionByName(gaps(coll_daily, "collection_date", "collections")))


def row_counts(layers: list[DataFrame], frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """One row per (layer, table) with its row count: ``layers`` are ready counts
    (``staging.layer_counts``, one scan a table), ``frames`` are counted here. All in one job."""
    counted = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows")
        for (layer, name), df in frames.items()]
    return reduce(DataFrame.unionByName, [*layers, *counted])
