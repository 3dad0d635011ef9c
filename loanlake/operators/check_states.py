"""The 30 checks kept by load window: states of a part of the rows that add up to those of all rows.

A check's state is counts: of broken rows per row rule, and per key value of the rows that each table has of it.
Counts of two windows add, so a daily run reads the new window, adds its state to the stored one and reports from
the sum. Uniqueness and foreign keys are exact at any time, because a key's counts are kept, not a sketch of them;
a key that holds a third of all rows is one row of ``summed`` states. States that are only reported are grouped
once, with the rows of all windows, not once a window and again for each merge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators import quality as Q

#: Key columns of each state; the others are its counts.
KEYS = {"rules": ["seq", "table_name", "check_name", "threshold"], "customer_id": ["_key"], "loan_id": ["_key"],
        "installment_id": ["_key"], "payment_id": ["payment_id"], "same_day": ["loan_id", "installment_id", "payment_date"],
        "amounts": ["loan_id", "principal_amount"], "cash": ["loan_id"]}

States = dict[str, DataFrame]


def states_of(customers: DataFrame, loans: DataFrame, installments: DataFrame, payments: DataFrame) -> States:
    """The states of the given raw rows: whole tables or what one window brought. A key may have many rows, which
    add up; ``summed`` makes one of them."""
    tables = Q.all_checks(customers, loans, installments, payments)
    confirmed = F.upper(F.col("payment_status")) == F.lit("CONFIRMED")
    one = F.lit(1).cast("long").alias("n")
    out = {"rules": reduce(DataFrame.unionByName, [
        Q.row_counts(t.df, t.rules).withColumnRenamed("failed_count", "n") for t in tables if t.rules])}
    out |= {name: rows for name, rows, _ in Q.key_counters(customers, loans, installments, payments)}
    out["payment_id"] = payments.select("payment_id", one)
    out["same_day"] = payments.where(confirmed).select(*KEYS["same_day"], one)
    out["amounts"] = loans.select(*KEYS["amounts"], one)
    out["cash"] = payments.where(confirmed & (F.col("payment_amount") > 0)).select(
        "loan_id", X.money(F.col("payment_amount")).alias("cash"))
    return out


def merged(a: States, b: States) -> States:
    """The states of the rows of both."""
    return {name: a[name].unionByName(b[name]) for name in KEYS}


def summed(states: States) -> States:
    """The same states with one row per key, as they are kept."""
    out = {}
    for name, key in KEYS.items():
        rows = states[name]
        values = [c for c in rows.columns if c not in key]
        out[name] = rows.groupBy(*key).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in values])
    return out


def report(states: States) -> DataFrame:
    """The 30 rows of ``quality.quality_report`` from the states of all rows."""
    states = summed(states)
    rules = states["rules"].select("seq", "table_name", "check_name", F.col("n").alias("failed_count"), "threshold")
    parts = [Q.finish(rules)]
    parts += [Q.key_report(states[name], checks) for name, checks in Q.key_rules().items()]
    for seq, name, check, most in ((21, "payment_id", "pk_unique", 0), (28, "same_day", "possible_duplicate", 2)):
        parts.append(Q.scalar_check(seq, "payments", check, states[name].where("n > 1"), most))
    cash = states["cash"].select(F.col("loan_id").alias("_of"), "cash")
    paid = states["amounts"].join(cash, F.col("loan_id") == F.col("_of"), "left")
    over = F.coalesce(F.col("cash") * F.col("n"), F.lit(0)) > F.col("principal_amount") * F.lit(1.5)
    parts.append(Q.scalar_check(29, "cross", "collected_vs_principal", paid.where(over)))
    return reduce(DataFrame.unionByName, parts)
