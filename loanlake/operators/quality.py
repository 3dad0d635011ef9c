"""Table-driven data-quality suite over the raw tables (30 checks).

A check counts offending rows (or offending key groups) and passes when the count is at most its
threshold. Plan shape:

* all row-level rules of one table are evaluated in **one** aggregate pass (``count_if`` per rule)
  and unpivoted with ``stack``, instead of one scan per rule;
* uniqueness rules are a two-step grouping (groups with more than one row);
* foreign-key rules are NOT IN with SQL NULL semantics, executed as shuffle-able anti joins
  (``operators.existence.not_in_rows``), never as a broadcast null-aware anti join;
* cross-table rules are a filtered left join + grouping and an inner join.

Each table's checks form one small DataFrame; ``quality_report`` unions them (30 rows). Only that
30-row result ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from loanlake.functions import expr as X
from loanlake.operators.existence import key_counts, not_in_rows

REPORT_SCHEMA = ("seq int, table_name string, check_name string, failed_count bigint, threshold bigint, "
                 "passed boolean, detail string")
REPORT_COLUMNS = ["seq", "table_name", "check_name", "failed_count", "threshold", "passed", "detail"]


@dataclass(frozen=True)
class RowRule:
    seq: int
    table: str
    name: str
    cond: Column
    threshold: int = 0


def finish(df: DataFrame) -> DataFrame:
    """Add pass/fail and the detail text to (seq, table_name, check_name, failed_count, threshold)."""
    return df.select(
        F.col("seq").cast("int").alias("seq"),
        "table_name", "check_name",
        F.col("failed_count").cast("bigint").alias("failed_count"),
        F.col("threshold").cast("bigint").alias("threshold"),
        (F.col("failed_count") <= F.col("threshold")).alias("passed"),
        F.concat(F.col("failed_count").cast("string"), F.lit(" rows with issues")).alias("detail"),
    )


def row_counts(df: DataFrame, rules: list[RowRule]) -> DataFrame:
    """Broken rows of many row rules from one aggregate pass, unpivoted to one row per rule."""
    counts = df.agg(*[F.count_if(r.cond).alias(f"_c{r.seq}") for r in rules])
    parts = ", ".join(f"{r.seq}, '{r.table}', '{r.name}', _c{r.seq}, {r.threshold}" for r in rules)
    return counts.selectExpr(f"stack({len(rules)}, {parts}) AS (seq, table_name, check_name, failed_count, threshold)")


def scalar_check(seq: int, table: str, name: str, counted: DataFrame, threshold: int = 0) -> DataFrame:
    """One check from a frame whose row count is the failure count."""
    return finish(counted.agg(F.count(F.lit(1)).alias("failed_count")).select(
        F.lit(seq).alias("seq"), F.lit(table).alias("table_name"), F.lit(name).alias("check_name"),
        "failed_count", F.lit(threshold).alias("threshold")))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key groups holding more than one row (NULL forms its own group, as in SQL GROUP BY).

    A single key reuses ``key_counts``, the grouping the NOT IN checks on the same key use, so
    the uniqueness check and the foreign-key checks against this table share one shuffle.
    """
    if len(keys) == 1:
        return key_counts(df, keys[0]).where(F.col("_cnt") > 1)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > 1)


@dataclass(frozen=True)
class FrameRule:
    """A check whose failure count is the row count of a frame."""
    seq: int
    table: str
    name: str
    rows: Callable[[], DataFrame]
    threshold: int = 0


@dataclass(frozen=True)
class TableChecks:
    df: DataFrame
    rules: list[RowRule]
    frames: list[FrameRule]

    def report(self) -> DataFrame:
        parts = [finish(row_counts(self.df, self.rules))] if self.rules else []
        parts += [scalar_check(f.seq, f.table, f.name, f.rows(), f.threshold) for f in self.frames]
        return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------------------------ per table

def customer_checks(customers: DataFrame) -> TableChecks:
    c = F.col
    return TableChecks(customers, [
        RowRule(1, "customers", "pk_not_null", X.is_blank("customer_id")),
        RowRule(3, "customers", "segment_valid", X.not_in(c("segment"), X.CUSTOMER_SEGMENTS)),
        RowRule(4, "customers", "income_positive", X.not_positive("monthly_income")),
        RowRule(5, "customers", "city_not_null", X.is_blank("city")),
    ], [FrameRule(2, "customers", "pk_unique", lambda: duplicate_groups(customers, ["customer_id"]))])


def loan_checks(loans: DataFrame, customers: DataFrame) -> TableChecks:
    c = F.col
    rate = c("annual_rate")
    return TableChecks(loans, [
        RowRule(6, "loans", "pk_not_null", X.is_blank("loan_id")),
        RowRule(9, "loans", "amount_positive", X.not_positive("principal_amount")),
        RowRule(10, "loans", "rate_in_range", rate.isNull() | (rate <= 0) | (rate > 1)),
        RowRule(11, "loans", "status_valid", X.not_in(F.upper(c("loan_status")), X.LOAN_STATUSES)),
        RowRule(12, "loans", "term_positive", X.not_positive("term_months")),
    ], [
        FrameRule(7, "loans", "pk_unique", lambda: duplicate_groups(loans, ["loan_id"])),
        FrameRule(8, "loans", "fk_customer", lambda: not_in_rows(loans, "customer_id", customers, "customer_id")),
    ])


def installment_checks(installments: DataFrame, loans: DataFrame) -> TableChecks:
    c = F.col
    return TableChecks(installments, [
        RowRule(13, "installments", "pk_not_null", X.is_blank("installment_id")),
        RowRule(16, "installments", "status_valid",
                X.not_in(F.upper(c("installment_status")), X.INSTALLMENT_STATUSES)),
        RowRule(17, "installments", "number_outlier",
                c("installment_number") == X.OUTLIER_INSTALLMENT_NUMBER, threshold=1),
        RowRule(18, "installments", "amounts_non_negative", (c("principal_due") < 0) | (c("interest_due") < 0)),
    ], [
        FrameRule(14, "installments", "pk_unique", lambda: duplicate_groups(installments, ["installment_id"])),
        FrameRule(15, "installments", "fk_loan", lambda: not_in_rows(installments, "loan_id", loans, "loan_id")),
        FrameRule(19, "loans", "without_installments", lambda: loans_without_installments(loans, installments)),
    ])


def payment_checks(payments: DataFrame, loans: DataFrame, installments: DataFrame) -> TableChecks:
    c = F.col
    status = F.upper(c("payment_status"))
    confirmed = status == F.lit("CONFIRMED")
    return TableChecks(payments, [
        RowRule(20, "payments", "pk_not_null", X.is_blank("payment_id")),
        RowRule(24, "payments", "amount_invalid", X.not_positive("payment_amount"), threshold=1),
        RowRule(25, "payments", "channel_null", c("payment_channel").isNull(), threshold=1),
        RowRule(26, "payments", "status_valid", X.not_in(status, X.PAYMENT_STATUSES)),
        RowRule(27, "payments", "unconfirmed", status.isin("REVERSED", "PENDING"), threshold=5),
    ], [
        FrameRule(21, "payments", "pk_unique", lambda: duplicate_groups(payments, ["payment_id"])),
        FrameRule(22, "payments", "fk_loan", lambda: not_in_rows(payments, "loan_id", loans, "loan_id")),
        FrameRule(23, "payments", "orphan_installment",
                  lambda: not_in_rows(payments, "installment_id", installments, "installment_id"), threshold=1),
        FrameRule(28, "payments", "possible_duplicate",
                  lambda: duplicate_groups(payments.where(confirmed), ["loan_id", "installment_id", "payment_date"]),
                  threshold=2),
    ])


def cross_checks(loans: DataFrame, payments: DataFrame, installments: DataFrame) -> TableChecks:
    return TableChecks(loans, [], [
        FrameRule(29, "cross", "collected_vs_principal", lambda: overcollected_loans(loans, payments)),
        FrameRule(30, "cross", "closed_unpaid", lambda: closed_with_unpaid(installments, loans), threshold=2),
    ])


def quality_customers(customers: DataFrame) -> DataFrame:
    return customer_checks(customers).report()


def quality_loans(loans: DataFrame, customers: DataFrame) -> DataFrame:
    return loan_checks(loans, customers).report()


def quality_installments(installments: DataFrame, loans: DataFrame) -> DataFrame:
    return installment_checks(installments, loans).report()


def quality_payments(payments: DataFrame, loans: DataFrame, installments: DataFrame) -> DataFrame:
    return payment_checks(payments, loans, installments).report()


def overcollected_loans(loans: DataFrame, payments: DataFrame) -> DataFrame:
    """(loan, principal) groups whose confirmed positive cash exceeds 1.5 x principal.

    The join's extra ON predicates become a filter on the payment side, and payments are
    pre-aggregated per loan before the join, so a hot loan is one row when it meets the loans.
    """
    c = F.col
    cash = (payments.where((F.upper(c("payment_status")) == F.lit("CONFIRMED")) & (c("payment_amount") > 0))
            .groupBy(c("loan_id").alias("_pl")).agg(F.sum("payment_amount").alias("_cash")))
    j = loans.select("loan_id", "principal_amount").join(cash, c("loan_id") == c("_pl"), "left")
    # A duplicated loan row meets its loan's cash once per copy, as in the per-row SQL join.
    grouped = j.groupBy("loan_id", "principal_amount").agg(F.sum("_cash").alias("_cash_sum"))
    total = F.coalesce(c("_cash_sum"), F.lit(0))
    return grouped.where(total > c("principal_amount") * F.lit(1.5)).select(
        "loan_id", "principal_amount", X.money(total).alias("collected"))


def closed_with_unpaid(installments: DataFrame, loans: DataFrame) -> DataFrame:
    """Installments of CLOSED loans that are not PAID (the outlier number excluded)."""
    c = F.col
    closed = loans.where(F.upper(c("loan_status")) == F.lit("CLOSED")).select(c("loan_id").alias("_cl"))
    inst = installments.where(X.not_in(F.upper(c("installment_status")), ["PAID"])
                              & (c("installment_number") != X.OUTLIER_INSTALLMENT_NUMBER))
    return inst.join(closed, c("loan_id") == c("_cl"), "inner").drop("_cl")


def quality_cross(loans: DataFrame, payments: DataFrame, installments: DataFrame) -> DataFrame:
    return cross_checks(loans, payments, installments).report()


def all_checks(customers: DataFrame, loans: DataFrame, installments: DataFrame,
               payments: DataFrame) -> list[TableChecks]:
    return [customer_checks(customers), loan_checks(loans, customers), installment_checks(installments, loans),
            payment_checks(payments, loans, installments), cross_checks(loans, payments, installments)]


def _counters(key: str, *sides: tuple[DataFrame, dict[str, Column]]) -> DataFrame:
    """A row per row of each side: its key, null included, and 1 or 0 for each counter of any side."""
    names = [n for _, counters in sides for n in counters]
    zero = F.lit(0).cast("long")
    parts = [df.select(F.col(key).alias("_key"), *[
        F.when(counters[n], F.lit(1).cast("long")).otherwise(zero).alias(n) if n in counters else zero.alias(n)
        for n in names]) for df, counters in sides]
    return reduce(DataFrame.unionByName, parts)


def census(counters: DataFrame) -> DataFrame:
    """Per key, null included, the sums of the counters: one scan of a side and one grouping for all checks of the
    key. A hot key is combined before the shuffle."""
    return counters.groupBy("_key").agg(*[F.sum(n).alias(n) for n in counters.columns if n != "_key"])


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _repeated(n: str) -> Column:
    return F.count_if(F.col(n) > 1)


def _astray(child: str, parent: str) -> Column:
    """Child rows whose key is NOT IN the parent's, with SQL's NULL rules, from a census of both."""
    no_key = F.col("_key").isNull()
    return (F.when(_total(F.col(parent)) == 0, _total(F.col(child)))
            .when(_total(F.when(no_key, F.col(parent))) > 0, F.lit(0))
            .otherwise(_total(F.when(~no_key & (F.col(parent) == 0), F.col(child)))))


def key_rules() -> dict[str, list[tuple]]:
    """Checks on a key from its census: (seq, table, name, value, threshold) per key."""
    c = F.col
    return {
        "customer_id": [(2, "customers", "pk_unique", _repeated("customers"), 0),
                        (8, "loans", "fk_customer", _astray("loans", "customers"), 0)],
        "loan_id": [(7, "loans", "pk_unique", _repeated("loans"), 0),
                    (15, "installments", "fk_loan", _astray("units", "loans"), 0),
                    (19, "loans", "without_installments", _astray("open", "units"), 0),
                    (22, "payments", "fk_loan", _astray("pays", "loans"), 0),
                    (30, "cross", "closed_unpaid", _total(F.when(c("_key").isNotNull(), c("closed") * c("unpaid"))), 2)],
        "installment_id": [(14, "installments", "pk_unique", _repeated("units"), 0),
                           (23, "payments", "orphan_installment", _astray("pays", "units"), 1)]}


def key_counters(customers: DataFrame, loans: DataFrame, installments: DataFrame,
                 payments: DataFrame) -> list[tuple[str, DataFrame, list[tuple]]]:
    """(key, counters, checks): uniqueness, foreign keys and membership of a key come from one census of them."""
    every, c = F.lit(True), F.col
    unpaid = X.not_in(F.upper(c("installment_status")), ["PAID"]) & (c("installment_number") != X.OUTLIER_INSTALLMENT_NUMBER)
    rows = {
        "customer_id": _counters("customer_id", (customers, {"customers": every}), (loans, {"loans": every})),
        "loan_id": _counters("loan_id",
                             (loans, {"loans": every, "open": c("loan_status").isin(*X.OPEN_LOAN_STATUSES),
                                      "closed": F.upper(c("loan_status")) == F.lit("CLOSED")}),
                             (installments, {"units": every, "unpaid": unpaid}), (payments, {"pays": every})),
        "installment_id": _counters("installment_id", (installments, {"units": every}), (payments, {"pays": every}))}
    return [(name, rows[name], checks) for name, checks in key_rules().items()]


def key_report(counted: DataFrame, checks: list[tuple]) -> DataFrame:
    counts = counted.agg(*[value.cast("long").alias(f"_c{seq}") for seq, _, _, value, _ in checks])
    parts = ", ".join(f"{seq}, '{table}', '{name}', _c{seq}, {most}" for seq, table, name, _, most in checks)
    return finish(counts.selectExpr(
        f"stack({len(checks)}, {parts}) AS (seq, table_name, check_name, failed_count, threshold)"))


BY_KEY = {2, 7, 8, 14, 15, 19, 22, 23, 30}


def quality_report(customers: DataFrame, loans: DataFrame, installments: DataFrame,
                   payments: DataFrame) -> DataFrame:
    """All 30 checks, one row each (``seq`` gives the report order): one pass per table for its row rules, one
    census per key for the checks on keys, and the rest by themselves."""
    parts = [key_report(census(rows), checks) for _, rows, checks in key_counters(customers, loans, installments, payments)]
    for t in all_checks(customers, loans, installments, payments):
        rest = TableChecks(t.df, t.rules, [f for f in t.frames if f.seq not in BY_KEY])
        if rest.rules or rest.frames:
            parts.append(rest.report())
    return reduce(DataFrame.unionByName, parts)


def evaluate_report(customers: DataFrame, loans: DataFrame, installments: DataFrame, payments: DataFrame) -> list:
    """The 30 report rows. One plan for all; if that fails, each check by itself, so that a check that
    cannot run (a missing column, say) is a row with count -1 that does not pass, and the others count."""
    try:
        return quality_report(customers, loans, installments, payments).orderBy("seq").collect()  # 30 rows
    except PySparkException:
        pass
    rows = []
    for t in all_checks(customers, loans, installments, payments):
        alone = [(r, TableChecks(t.df, [r], [])) for r in t.rules] + [(f, TableChecks(t.df, [], [f])) for f in t.frames]
        for check, one in alone:
            try:
                rows.append(one.report().first())
            except PySparkException as e:
                rows.append(Row(seq=check.seq, table_name=check.table, check_name=check.name, failed_count=-1,
                                threshold=check.threshold, passed=False,
                                detail=f"error: {e.getCondition() or type(e).__name__}"))
    return sorted(rows, key=lambda r: r["seq"])


def fk_violations(loans: DataFrame, customers: DataFrame, installments: DataFrame,
                  payments: DataFrame) -> DataFrame:
    """Offending child rows of the three hard foreign keys, tagged with the relation."""
    c = F.col
    return (not_in_rows(loans, "customer_id", customers, "customer_id")
            .select(F.lit("loans.customer_id").alias("relation"), c("loan_id").alias("child_id"),
                    c("customer_id").alias("parent_id"))
            .unionByName(not_in_rows(installments, "loan_id", loans, "loan_id")
                         .select(F.lit("installments.loan_id").alias("relation"),
                                 c("installment_id").alias("child_id"), c("loan_id").alias("parent_id")))
            .unionByName(not_in_rows(payments, "loan_id", loans, "loan_id")
                         .select(F.lit("payments.loan_id").alias("relation"),
                                 c("payment_id").alias("child_id"), c("loan_id").alias("parent_id"))))


def loans_without_installments(loans: DataFrame, installments: DataFrame) -> DataFrame:
    open_loans = loans.where(F.col("loan_status").isin(*X.OPEN_LOAN_STATUSES))
    return not_in_rows(open_loans, "loan_id", installments, "loan_id")
