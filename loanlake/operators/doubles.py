"""Payments that look entered twice: same loan and amount within a time window, whatever their ids and installments.

Payments of a loan and amount form a session while each comes at most ``within`` after the one before. Time is
cut into buckets of that length: payments of one bucket always share a session, and only the last of a bucket and
the first of the next one can join two, so a bucket needs no more than its first and last stamp. Buckets are
aggregated with map-side combine; the window that joins them sees a row per bucket, at most the calendar's
length for a loan and amount, even if these hold a third of all payments.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def payment_doubles(payments: DataFrame, within: dt.timedelta = dt.timedelta(days=1)) -> DataFrame:
    """Sessions of two or more payments: ``loan_id``, ``payment_amount``, ``first_at``, ``last_at``, ``n_payments``,
    ``across_installments`` (do they name different installments, a missing one not counted?) and ``excess``, the
    amount beyond one payment.

    A stamp exactly ``within`` after the one before still joins. Rows without a stamp or an amount are in no
    session; a null loan is a loan like any other. A payment delivered twice counts twice.
    """
    length = int(within.total_seconds() * 1_000_000)
    if length < 1:
        raise ValueError("within is longer than a microsecond")
    key = ["loan_id", "payment_amount"]
    micros = F.unix_micros(F.col("loaded_at").cast("timestamp"))
    part = (payments.where(F.col("loaded_at").isNotNull() & F.col("payment_amount").isNotNull())
            .withColumn("_at", micros).withColumn("_bucket", F.floor(F.col("_at") / F.lit(length)))
            .groupBy(*key, "_bucket").agg(
                F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.min("loaded_at").alias("_first"),
                F.max("loaded_at").alias("_last"), F.count(F.lit(1)).alias("_n"),
                F.min("installment_id").alias("_i0"), F.max("installment_id").alias("_i1")))
    order = Window.partitionBy(*key).orderBy("_bucket")
    apart = F.coalesce(F.col("_lo") - F.lag("_hi").over(order) > length, F.lit(True))
    numbered = part.withColumn("_new", apart.cast("int")).withColumn(
        "_session", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (numbered.groupBy(*key, "_session").agg(
        F.min("_first").alias("first_at"), F.max("_last").alias("last_at"), F.sum("_n").alias("n_payments"),
        F.coalesce(F.min("_i0") != F.max("_i1"), F.lit(False)).alias("across_installments"))
        .where("n_payments > 1").drop("_session")
        .withColumn("excess", (F.col("payment_amount") * (F.col("n_payments") - 1)).cast("decimal(38,2)")))
