"""High-water-mark incremental load of payments.

Two forms of the same step:

* **bounded batch** (``IncrementalPayments``): read the committed mark ``lo``, fix the upper bound
  ``hi = max(loaded_at)`` *before* processing, take the raw rows with ``lo - overlap < loaded_at <= hi``
  and merge them into the staged table. A row that lands while the batch runs has ``loaded_at > hi``
  and is picked up next time. The overlap re-reads late rows; the merge makes replays idempotent.
* **stream** (``stream_payments``): a file-source ``readStream`` over landing files with
  ``Trigger.AvailableNow`` — the checkpoint is the mark — and ``foreachBatch`` doing the same
  merge per micro-batch.

The merge works on payment versions, not on clean rows: the newest raw version of a payment decides,
so a payment that turns REVERSED, PENDING or invalid leaves the staged table. The orphan flag of every
staged payment is evaluated again, as its installment may have arrived since.

The mark is part of the commit that publishes the tables (``sources/sinks.py``), so tables and mark
always agree: a run that fails anywhere before the commit is simply run again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.functions.expr import ntz_lit
from loanlake.operators import staging
from loanlake.operators.existence import with_not_in_flag
from loanlake.operators.upsert import dedup_latest, merge_versions
from loanlake.sources import schemas, sinks

DEFAULT_MARK = dt.datetime(2000, 1, 1)
MARK = "payments"
UNDATED = dt.date(1900, 1, 1)  # load day of rows without a stamp
VERSION_COLUMNS = [c for c in staging.PAYMENT_SPEC.columns if c != "orphan_installment"]


def read_mark(spark: SparkSession, root: str, name: str = MARK, default: dt.datetime = DEFAULT_MARK) -> dt.datetime:
    """Committed mark of ``name`` under ``root``; ``default`` only where none was committed."""
    return sinks.snapshot(spark, root).marks.get(name, default)


def window_rows(raw_payments: DataFrame, lo: dt.datetime, hi: dt.datetime | None) -> DataFrame:
    """Rows with ``lo < loaded_at <= hi`` (``hi`` None = no upper bound). Pushed into the scan."""
    cond = F.col("loaded_at") > ntz_lit(lo)
    if hi is not None:
        cond = cond & (F.col("loaded_at") <= ntz_lit(hi))
    return raw_payments.where(cond)


def next_mark(raw_payments: DataFrame) -> DataFrame:
    """The mark the next run would store: max(loaded_at) and the row count behind it (1 row)."""
    return raw_payments.agg(F.max("loaded_at").alias("last_loaded_at"),
                            F.count(F.lit(1)).alias("n_rows"))


def merge_payments(staged: DataFrame | None, window: DataFrame, raw_installments: DataFrame) -> DataFrame:
    """Staged payments after the raw payment versions of ``window``.

    Per payment id the version with the greatest ``loaded_at`` decides, stored or new; it is kept if
    it is clean. Rows without an id are never clean. The orphan flag is evaluated anew for all.
    """
    flagged = staging.flag_payments(window, raw_installments)
    newest = dedup_latest(flagged.where(~F.col("_f_no_id")), ["payment_id"], ["loaded_at"])
    clean = F.lit(True)
    for name, _ in staging.PAYMENT_SPEC.flags:
        clean = clean & ~F.col(name)
    columns = staging.PAYMENT_SPEC.columns
    versions = newest.select(*columns, clean.alias("_clean"))
    if staged is None:
        return versions.where("_clean").drop("_clean")
    merged = merge_versions(staged.select(*columns), versions, ["payment_id"], "loaded_at", "_clean")
    return with_not_in_flag(merged.drop("orphan_installment"), F.col("installment_id"), raw_installments,
                            "installment_id", "orphan_installment").select(*columns)


# ----------------------------------------------------------------- rows of any age, by what was read

DAY = "load_day"


def load_day() -> Column:
    """Day of the load stamp; undated rows share ``UNDATED``."""
    return F.coalesce(F.to_date("loaded_at"), F.lit(UNDATED))


def day_totals(raw_payments: DataFrame) -> DataFrame:
    """(load_day, n, fp): rows per load day and an order-free fingerprint of their ids and stamps. It reads two
    columns and has a row per calendar day."""
    return raw_payments.groupBy(load_day().alias(DAY)).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("payment_id", "loaded_at")).alias("fp"))


def changed_days(totals: DataFrame, known: DataFrame | None) -> list[dt.date]:
    """Load days whose totals are not those of the last run (at most a row per calendar day)."""
    if known is not None:
        totals = totals.join(known, [DAY, "n", "fp"], "left_anti")
    return sorted(r[0] for r in totals.select(DAY).collect())


def on_days(rows: DataFrame, days: list[dt.date]) -> DataFrame:
    """Raw rows of the given load days: ranges of the stamp, which reach the scan, one per run of days."""
    cond, one = F.lit(False), dt.timedelta(days=1)
    runs: list[list[dt.date]] = []
    for day in days:
        if day == UNDATED:
            cond = cond | F.col("loaded_at").isNull()
        if runs and day - runs[-1][1] == one:
            runs[-1][1] = day
        else:
            runs.append([day, day])
    for lo, hi in runs:
        start, end = (dt.datetime.combine(x, dt.time()) for x in (lo, hi + one))
        cond = cond | ((F.col("loaded_at") >= ntz_lit(start)) & (F.col("loaded_at") < ntz_lit(end)))
    return rows.where(cond)


def version_prints(rows: DataFrame) -> DataFrame:
    """(load_day, f1, f2, n): how often each raw version, by a 128-bit fingerprint of all columns, occurs."""
    cols = [f.name for f in schemas.PAYMENTS.fields]
    return rows.groupBy(load_day().alias(DAY), F.xxhash64(*cols).alias("f1"), F.xxhash64(F.lit(1), *cols).alias("f2")).agg(
        F.count(F.lit(1)).alias("n"))


def fresh_versions(rows: DataFrame, seen: DataFrame | None) -> DataFrame:
    """The raw rows that ``seen`` (fingerprints of what earlier runs read) does not have, each as often as it is new.

    An anti join on counts: equal rows are one before the shuffle, whatever their number.
    """
    cols = [f.name for f in schemas.PAYMENTS.fields]
    counted = rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    if seen is not None:
        known = seen.groupBy("f1", "f2").agg(F.sum("n").alias("_seen"))
        counted = (counted.withColumn("f1", F.xxhash64(*cols)).withColumn("f2", F.xxhash64(F.lit(1), *cols))
                   .join(known, ["f1", "f2"], "left").withColumn("_n", F.col("_n") - F.coalesce("_seen", F.lit(0))))
    return counted.where("_n > 0").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(*cols)


def versions(raw_rows: DataFrame) -> DataFrame:
    """Payment versions with an id: the staged columns without the orphan flag, and ``_clean``."""
    flagged = staging.flag_payment_rows(raw_rows).where(~F.col("_f_no_id"))
    clean = F.lit(True)
    for name, _ in staging.PAYMENT_SPEC.flags:
        clean = clean & ~F.col(name)
    return flagged.select(*VERSION_COLUMNS, clean.alias("_clean"))


def newest(rows: DataFrame) -> DataFrame:
    """Per payment the version with the greatest stamp, then the greatest columns: the same one in whatever
    batches the versions came."""
    return dedup_latest(rows, ["payment_id"], ["loaded_at"])


def with_orphans(rows: DataFrame, raw_installments: DataFrame) -> DataFrame:
    return with_not_in_flag(rows, F.col("installment_id"), raw_installments, "installment_id", "orphan_installment")


def load_month(prefix: Column) -> Column:
    """Segment of a row: a prefix and the month of its load stamp."""
    return F.concat(prefix, F.coalesce(F.date_format("loaded_at", "yyyyMM"), F.lit("undated")))


class IncrementalPayments:
    """Bounded-batch incremental load into a staged-payments table (see module doc)."""

    def __init__(self, spark: SparkSession, lo: dt.datetime, overlap: dt.timedelta = dt.timedelta(0)):
        self.spark, self.lo, self.overlap = spark, lo, overlap

    @property
    def start(self) -> dt.datetime:
        """Rows at or before it are not read again."""
        return max(DEFAULT_MARK, self.lo - self.overlap) if self.lo > DEFAULT_MARK else self.lo

    def run(self, raw_payments: DataFrame, raw_installments: DataFrame, staged: DataFrame | None,
            write: Callable[[DataFrame], None]) -> dict:
        """Merge the window into ``staged`` and hand the result to ``write`` (which must not publish it
        before the caller commits it together with ``new_mark``). Counts and the new mark come from
        one aggregate over the rows past the window's start, not over all of raw."""
        undated = F.col("loaded_at").isNull()  # in no window by time: read by every run
        later = raw_payments.where(undated | (F.col("loaded_at") > ntz_lit(self.start)))
        seen = later.agg(F.max("loaded_at").alias("hi"),
                         F.count_if(F.col("loaded_at") > ntz_lit(self.lo)).alias("new"),
                         F.count(F.lit(1)).alias("n")).first()
        hi = max(seen["hi"], self.lo) if seen["hi"] is not None else self.lo
        if seen["n"] or staged is not None:
            write(merge_payments(staged, later.where(undated | (F.col("loaded_at") <= ntz_lit(hi))), raw_installments))
        return {"previous_mark": self.lo, "new_mark": hi, "new_rows": seen["new"], "read_rows": seen["n"]}


def next_staging_mark(staged: DataFrame) -> DataFrame:
    """The mark as the staged table itself shows it: max(loaded_at) of what was staged (1 row). It falls
    short of the raw mark where the newest rows were rejected, so it can only re-read, never skip."""
    return staged.agg(F.max("loaded_at").alias("last_loaded_at"), F.count(F.lit(1)).alias("n_rows"))


def dedup_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Drop re-delivered rows of a stream by ``key`` while their ``event_time`` is within
    ``delay`` of the watermark; the state per key is dropped once the watermark passes it, so
    state stays bounded however long the stream runs. Watermarks need a zoned timestamp, so a
    wall-clock (NTZ) stamp is read in the session time zone for the watermark only."""
    return (stream.withColumn("_event_ts", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_ts", delay)
            .dropDuplicatesWithinWatermark([key])
            .drop("_event_ts"))


def stream_payments(spark: SparkSession, landing_dir: str, fmt: str, schema: T.StructType,
                    checkpoint: str, on_batch: Callable[[DataFrame, int], None],
                    dedup_delay: str | None = None):
    """Process every landing file not seen before (AvailableNow), one micro-batch at a time.

    ``on_batch(df, epoch_id)`` receives the raw rows of the micro-batch, e.g. to stage them and
    upsert into the staged table. The checkpoint records which files were consumed, so a restart
    after an executor or driver loss resumes exactly where it stopped. ``dedup_delay`` (e.g.
    ``"1 day"``) drops payment ids delivered again within that delay of the load-time watermark.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    stream = reader.load(landing_dir)
    if dedup_delay:
        stream = dedup_within(stream, "payment_id", "loaded_at", dedup_delay)
    q = (stream.writeStream
         .foreachBatch(on_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
