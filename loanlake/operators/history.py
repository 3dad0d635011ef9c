"""Slowly-changing history (type 2) by comparing snapshots.

``history`` rows carry ``valid_from`` / ``valid_to`` (NULL = the open version). Observing a new
``snapshot`` at ``as_of`` closes the open version of every key whose tracked columns changed or
that disappeared, and opens a version for every new or changed key. One full outer join on the
key (a shuffle on both sides; keys are unique per snapshot, so nothing fans out) and two
projections; closed versions pass through untouched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X


def initial_history(snapshot: DataFrame, key: str, tracked: list[str], as_of: dt.date) -> DataFrame:
    return snapshot.select(key, *tracked, F.lit(as_of).alias("valid_from"),
                           F.lit(None).cast("date").alias("valid_to"))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, tracked: list[str],
               as_of: dt.date) -> DataFrame:
    day = F.lit(as_of)
    closed = history.where(F.col("valid_to").isNotNull())
    h = history.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_hk"), *[F.col(c).alias(f"_h_{c}") for c in tracked], F.col("valid_from").alias("_hf"))
    s = snapshot.select(F.col(key).alias("_sk"), *[F.col(c).alias(f"_s_{c}") for c in tracked])
    j = h.join(s, F.col("_hk") == F.col("_sk"), "full")
    changed: Column = F.lit(False)
    for c in tracked:
        changed = changed | ~F.col(f"_h_{c}").eqNullSafe(F.col(f"_s_{c}"))
    old = j.where(F.col("_hk").isNotNull()).select(
        F.col("_hk").alias(key), *[F.col(f"_h_{c}").alias(c) for c in tracked],
        F.col("_hf").alias("valid_from"),
        F.when(F.col("_sk").isNull() | changed, day).alias("valid_to"))
    new = j.where(F.col("_sk").isNotNull() & (F.col("_hk").isNull() | changed)).select(
        F.col("_sk").alias(key), *[F.col(f"_s_{c}").alias(c) for c in tracked],
        day.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return closed.unionByName(old).unionByName(new)


def history_series(open_loans: DataFrame, stg_installments: DataFrame, cutoffs: list[dt.date]) -> DataFrame:
    """Type 2 history of ``loan_status``, ``aging_bucket`` and ``in_arrears`` of the open loans over a series of
    cut-offs: what ``initial_history`` at the first and ``scd2_apply`` at each later one give, in one pass.

    A loan's state at any cut-off follows from three facts: its first unpaid due date, its first due date among
    installments that are due, and whether one is late at once. One grouping finds them; the states at all
    cut-offs are then an array inside the loan's row, and the versions are its elements that differ from the one
    before. Each table is read once, however many cut-offs there are.
    """
    days = sorted(set(cutoffs))
    if not days:
        raise ValueError("a series has a cut-off")
    status, due = F.col("installment_status"), F.col("due_date")
    facts = stg_installments.groupBy("loan_id").agg(
        F.min(F.when(X.not_in(status, ["PAID"]), due)).alias("_unpaid"),
        F.min(F.when(status == F.lit("DUE"), due)).alias("_due"),
        F.coalesce(F.bool_or(status.isin("LATE", "PARTIAL")), F.lit(False)).alias("_at_once"))

    def state(day: Column) -> Column:
        late = F.greatest(F.coalesce(F.datediff(day, "_unpaid"), F.lit(0)), F.lit(0))
        arrears = (F.col("loan_status") == F.lit("DEFAULT")) | F.coalesce("_at_once", F.lit(False)) | F.coalesce(
            F.col("_due") < day, F.lit(False))
        return F.struct(day.alias("valid_from"), X.loan_bucket(late).alias("aging_bucket"), X.flag(arrears).alias("in_arrears"))

    states = open_loans.select("loan_id", "loan_status").join(facts, "loan_id", "left").select(
        "loan_id", "loan_status", F.array(*[state(F.lit(d)) for d in days]).alias("_s"))

    def begins(s: Column, i: Column) -> Column:
        before = F.get("_s", i - 1)
        return (i == 0) | (s["aging_bucket"] != before["aging_bucket"]) | (s["in_arrears"] != before["in_arrears"])

    # outer: the first version is always there, and Spark puts no filter of its own ahead of the projections, which
    # would work out the states of all cut-offs anew for each element
    changed = states.withColumn("_s", F.filter("_s", begins))
    return changed.select("loan_id", "loan_status", "_s", F.posexplode_outer("_s").alias("_i", "_v")).select(
        "loan_id", "loan_status", "_v.aging_bucket", "_v.in_arrears", "_v.valid_from",
        F.get("_s", F.col("_i") + 1)["valid_from"].alias("valid_to"))
