"""Window operators: running sums, row-based moving averages, share of a partition total and
top-k numbering.

Scale notes. A window with ``partitionBy`` shuffles on the partition keys and sorts inside each
partition; a window *without* partition keys runs in one task. The global windows used by the
business questions run on aggregates whose size is bounded by the calendar (one row per day)
or by k (top-k), never on the raw fact tables. For an unbounded global running total use
``running_total_large``, which shifts sums of bounded ranges by the totals of earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlake.session import ensure_checkpoint_dir

PART_ROWS = 1_000_000


def running_sum(value: str, partition_by: list[str], order_by: list[Column]) -> Column:
    """``SUM(value) OVER (PARTITION BY .. ORDER BY .. ROWS UNBOUNDED PRECEDING..CURRENT ROW)``."""
    w = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return F.sum(value).over(w)


def moving_avg_rows(value: str, order_by: list[Column], preceding: int) -> Column:
    """Average of the current row and ``preceding`` earlier rows (a row frame, not calendar days)."""
    w = Window.orderBy(*order_by).rowsBetween(-preceding, Window.currentRow)
    return F.try_divide(F.sum(value).over(w).cast("double"), F.count(value).over(w).cast("double"))


def moving_avg_days(value: str, day: str, days: int) -> Column:
    """Calendar variant: average over the rows whose ``day`` lies in the last ``days`` days."""
    w = Window.orderBy(F.unix_date(F.col(day))).rangeBetween(-(days - 1), 0)
    return F.try_divide(F.sum(value).over(w).cast("double"), F.count(value).over(w).cast("double"))


def partition_total(value: str, partition_by: list[str]) -> Column:
    return F.sum(value).over(Window.partitionBy(*partition_by))


def top_k_numbered(df: DataFrame, order_by: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Top-k rows by ``order_by`` with a 1..k row number.

    The limit runs first (TakeOrderedAndProject: per-partition top-k, then a k-row merge), so
    the numbering window only ever sees k rows.
    """
    top = df.orderBy(*order_by).limit(k)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))


def prefix_sums(df: DataFrame, order_by: list[str], value: str, out: str, n_parts: int | None = None,
                range_rows: int | None = None) -> DataFrame:
    """Running sum of ``value`` over all rows in the order of ``order_by`` (ascending, nulls last), for inputs too
    large for one task.

    Rows are dealt to partitions (``n_parts``, by default as many as shuffles have) by ranges of ``order_by``,
    sorted there and numbered; every ``range_rows`` rows of a partition (default ``PART_ROWS``) are a range, so a
    range is bounded even where many rows share their order. Sums inside the
    ranges are shifted by the totals of earlier ranges (rows / ``range_rows`` rows, joined by the range's number).
    The numbered rows are checkpointed: each branch of the plan reads the same ranges, and a lost executor costs a
    re-read. Rows that tie in ``order_by`` follow each other in any, but one, order; name a key last to
    settle it. A null ``value`` adds nothing; before the first value the sum is null.
    """
    order = [F.col(f"`{c}`").asc_nulls_last() for c in order_by]
    rows = range_rows or PART_ROWS
    spread = df.repartitionByRange(*([n_parts] if n_parts else []), *order).sortWithinPartitions(*order)
    index = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (spread.withColumn("_at", F.monotonically_increasing_id())
                .withColumn("_range", F.shiftright("_at", 33) * (1 << 33) + F.floor(index / rows)))
    ensure_checkpoint_dir(df.sparkSession)
    ranged = numbered.checkpoint()
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.sum("_sum").over(earlier).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = F.sum(value).over(inside)
    zero = F.lit(0).cast(totals.schema["_sum"].dataType)
    return (ranged.withColumn("_local", local).join(offsets, "_range")
            .withColumn(out, F.when(F.col("_local").isNull() & F.col("_offset").isNull(), None).otherwise(
                F.coalesce("_local", zero) + F.coalesce("_offset", zero)))
            .drop("_range", "_at", "_local", "_offset"))


def running_total_large(df: DataFrame, value: str, order_col: str, out: str, n_parts: int | None = None,
                        ties: list[str] | None = None, range_rows: int | None = None) -> DataFrame:
    """Global running total (``ROWS UNBOUNDED PRECEDING`` by ``order_col``, then ``ties``) for inputs too large for
    one task; see ``prefix_sums``. Rows without an ``order_col`` come last. Rows that tie in all of
    ``ties`` (default: none) are summed in any order."""
    return prefix_sums(df, [order_col, *(ties or [])], value, out, n_parts, range_rows)
