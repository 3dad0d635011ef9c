"""Column-expression helpers. Everything here is a built-in Spark expression (codegen-friendly);
no Python UDFs.

Numeric conventions (so results are reproducible across engines):
* money stays ``decimal``; sums are widened to ``decimal(38,2)``;
* ratios are computed on doubles and rounded *scale-then-round* (``round(x * 10^d) / 10^d``),
  which is what SQL engines that round doubles natively do; Spark's ``round(double, d)`` rounds
  the shortest decimal string instead (1.005 -> 1.01 rather than 1.0);
* a zero or NULL denominator gives NULL (never an ANSI divide-by-zero error).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values. These must equal the source system's domain values and labels for results to
# match; they are stated here once, in their natural order.
# ---------------------------------------------------------------------------------------------
CUSTOMER_SEGMENTS = ["Mass Market", "Premium", "SME"]
LOAN_STATUSES = ["ACTIVE", "CLOSED", "DEFAULT"]
OPEN_LOAN_STATUSES = ["ACTIVE", "DEFAULT"]
INSTALLMENT_STATUSES = ["PAID", "DUE", "LATE", "PARTIAL"]
PAYMENT_STATUSES = ["CONFIRMED", "REVERSED", "PENDING"]
OUTLIER_INSTALLMENT_NUMBER = 99
UNKNOWN_CHANNEL = "UNKNOWN"
# Aging: label of installments that are paid and of loans without delay; bands by last day; label of days
# beyond them; label of installments not yet due.
AGING_CURRENT = "Al dia"
AGING_BANDS = [(30, "1-30 dias"), (60, "31-60 dias"), (90, "61-90 dias")]
AGING_BEYOND = "+90 dias"
AGING_NOT_DUE = "Por vencer"
# Cohort classes: label at an arrears percentage of 0, labels below a percentage, label otherwise.
COHORT_AT_ZERO = "Sana"
COHORT_BELOW = [(5, "Bajo riesgo"), (15, "Riesgo moderado"), (30, "Riesgo alto")]
COHORT_OTHERWISE = "Deterioro severo"
# ---------------------------------------------------------------------------------------------

MONEY = "decimal(38,2)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of: dt.date | str) -> Column:
    """The cut-off date as a literal (constant-folded by Catalyst)."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def ntz_lit(ts: dt.datetime) -> Column:
    """A wall-clock timestamp literal (``timestamp_ntz``), independent of any time zone.

    ``F.lit(datetime)`` would build a zoned literal whose value depends on the Python process and
    session time zones; parsing the ISO text as NTZ does not.
    """
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def clean(c: str | Column) -> Column:
    """Outer-space trim of ids and dimension strings."""
    return F.trim(col_(c))


def canon(c: str | Column) -> Column:
    """Canonical status: ``upper(trim(x))``."""
    return F.upper(F.trim(col_(c)))


def is_blank(c: str | Column) -> Column:
    """NULL or only spaces."""
    c = col_(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def not_positive(c: str | Column) -> Column:
    """NULL or <= 0."""
    c = col_(c)
    return c.isNull() | (c <= 0)


def flag(cond: Column) -> Column:
    """SQL ``CASE WHEN cond THEN TRUE ELSE FALSE END``: a NULL condition gives FALSE."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def not_in(c: Column, values: list) -> Column:
    """Three-valued ``c NOT IN (values)``; NULL input stays NULL (wrap in ``flag``)."""
    return ~c.isin(*values)


def round_half_away(x: Column, digits: int) -> Column:
    """Round a double by scaling first: ``round(x * 10^d, 0) / 10^d`` (half away from zero)."""
    scale = float(10 ** digits)
    return F.round(x * F.lit(scale), 0) / F.lit(scale)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` on doubles; NULL when ``den`` is zero or NULL."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))


def safe_pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0) * 100, digits)`` computed in double precision."""
    return round_half_away(safe_ratio(num, den) * F.lit(100.0), digits)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def days_between(as_of: Column, d: Column) -> Column:
    """Whole days from ``d`` to ``as_of`` (int)."""
    return F.datediff(as_of, d)


def cohort_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def monthly_rate(annual_rate: Column) -> Column:
    """Nominal monthly rate ``round(annual / 12, 6)`` as double."""
    return round_half_away(annual_rate.cast("double") / F.lit(12.0), 6)


def level_payment(principal: Column, annual_rate: Column, term_months: Column) -> Column:
    """Amortised (annuity) payment ``P*i / (1 - (1+i)^-n)`` with ``i = rate/12``, rounded to units.

    A zero denominator (term 0 or rate 0, rows that staging rejects anyway) gives NULL rather than
    an infinity or an ANSI error.
    """
    i = annual_rate.cast("double") / F.lit(12.0)
    den = F.lit(1.0) - F.pow(F.lit(1.0) + i, (-term_months).cast("double"))
    return F.round(F.try_divide(principal.cast("double") * i, F.nullif(den, F.lit(0.0))), 0)


def days_past_due(status: Column, due_date: Column, as_of: Column) -> Column:
    """Days late for an unpaid installment whose due date has passed, else 0."""
    return (F.when(not_in(status, ["PAID"]) & (due_date < as_of), days_between(as_of, due_date))
            .otherwise(F.lit(0)))


def installment_in_arrears(status: Column, due_date: Column, as_of: Column) -> Column:
    """LATE or PARTIAL always count as arrears; DUE only once its due date has passed."""
    return flag(status.isin("LATE", "PARTIAL") | ((status == F.lit("DUE")) & (due_date < as_of)))


def _by_band(days: Column, values: list, beyond) -> Column:
    """The value of the aging band that holds ``days`` (1 or more); ``beyond`` past the last band."""
    out = F.when(days <= AGING_BANDS[0][0], F.lit(values[0]))
    for (last, _), value in zip(AGING_BANDS[1:], values[1:]):
        out = out.when(days <= last, F.lit(value))
    return out.otherwise(F.lit(beyond))


def installment_bucket(status: Column, due_date: Column, as_of: Column) -> Column:
    """Installment aging bucket from the days between due date and cut-off."""
    days = days_between(as_of, due_date)
    return (F.when(status == F.lit("PAID"), F.lit(AGING_CURRENT))
            .when(days >= 1, _by_band(days, [label for _, label in AGING_BANDS], AGING_BEYOND))
            .otherwise(F.lit(AGING_NOT_DUE)))


def loan_bucket(max_days_late: Column) -> Column:
    """Loan aging bucket from its worst installment delay (0 -> current)."""
    return (F.when(max_days_late == 0, F.lit(AGING_CURRENT))
            .otherwise(_by_band(max_days_late, [label for _, label in AGING_BANDS], AGING_BEYOND)))


def bucket_rank(max_days_late: Column) -> Column:
    """Sort ordinal matching ``loan_bucket``: 0, then the bands in order."""
    n = len(AGING_BANDS)
    return (F.when(max_days_late == 0, F.lit(0))
            .otherwise(_by_band(max_days_late, list(range(1, n + 1)), n + 1)))


def cohort_health(arrears_pct: Column) -> Column:
    """Cohort class by arrears percentage; a NULL percentage falls through to the worst class."""
    out = F.when(arrears_pct == 0, F.lit(COHORT_AT_ZERO))
    for below, label in COHORT_BELOW:
        out = out.when(arrears_pct < below, F.lit(label))
    return out.otherwise(F.lit(COHORT_OTHERWISE))


def calendar_parts(d: Column, prefix: str) -> list[Column]:
    """Year, month and quarter of a date as ints."""
    return [F.year(d).alias(f"{prefix}_year"), F.month(d).alias(f"{prefix}_month"),
            F.quarter(d).alias(f"{prefix}_quarter")]


def sum_when(cond: Column, value: Column) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``; a NULL condition is not counted."""
    return F.count(F.when(cond, F.lit(1)))
