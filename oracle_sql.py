"""DuckDB SQL for every registered query of the library, written from the rules in README.md.

Design: ``RELATIONS`` is an ordered list of named relations; a text refers to another relation as
``{name}``, so the same chain can be laid out twice (for two cut-offs) under different names. Each raw
row gets one list of the rules it breaks: clean rows have an empty list, rejected rows show it.
Vocabularies, aging bands, arrears standings and cohort classes are small value tables that the
relations join. Balances come from a long form, one row per installment and tag it carries. Row counts
and checks are aggregates over the same relations.
"""

from __future__ import annotations

AS_OF = "DATE '1998-07-01'"
PREV_AS_OF = "DATE '1998-06-01'"
MARK = "TIMESTAMP '2024-01-15 00:00:00'"
MONEY = "DECIMAL(38,2)"


def listed(*rules: tuple[str, str]) -> str:
    """List of the names whose condition is true."""
    items = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in rules)
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


def blank(col: str) -> str:
    return f"COALESCE(TRIM({col}), '') = ''"


def outside(value: str, field: str) -> str:
    """Not a word of the field's vocabulary; unknown (so not true) for NULL."""
    return f"{value} NOT IN (SELECT word FROM {{vocab}} WHERE field = '{field}')"


def low(col: str) -> str:
    return f"COALESCE({col}, 0) <= 0"


def pct(part: str, whole: str) -> str:
    return f"0 + ROUND({part} / NULLIF({whole}, 0) * 100, 2)"  # 0 + : no negative zero


def money(value: str) -> str:
    return f"CAST(COALESCE({value}, 0) AS {MONEY})"


# Vocabularies, aging bands (days late), arrears standings, cohort classes (arrears %).
_VALUES = [
    ("vocab", """SELECT * FROM (VALUES
        ('segment', 'Mass Market'), ('segment', 'Premium'), ('segment', 'SME'),
        ('loan', 'ACTIVE'), ('loan', 'CLOSED'), ('loan', 'DEFAULT'),
        ('installment', 'PAID'), ('installment', 'DUE'), ('installment', 'LATE'), ('installment', 'PARTIAL'),
        ('payment', 'CONFIRMED'), ('payment', 'REVERSED'), ('payment', 'PENDING')) v(field, word)"""),
    ("aging", """SELECT * FROM (VALUES (1, 30, 1, '1-30 dias'), (31, 60, 2, '31-60 dias'),
        (61, 90, 3, '61-90 dias'), (91, 2147483647, 4, '+90 dias')) v(first_day, last_day, place, label)"""),
    ("standing", """SELECT * FROM (VALUES ('LATE', TRUE), ('PARTIAL', TRUE), ('DUE', FALSE)) v(status, at_once)"""),
    ("health", """SELECT * FROM (VALUES ('-infinity'::DOUBLE, 5, 'Bajo riesgo'), (5, 15, 'Riesgo moderado'),
        (15, 30, 'Riesgo alto')) v(lo, hi, label)"""),
]

# The four raw tables from the driver's tables; the same binding as loanlake/sources/binding.py.
_RAW = [
    ("raw_customers", """
        SELECT CASE WHEN c_custkey % 151 = 20 THEN ' ' WHEN c_custkey % 149 = 30 THEN CAST(c_custkey - 1 AS VARCHAR)
                    ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
               c_name AS full_name,
               CASE WHEN c_custkey % 61 = 9 THEN '' ELSE n_name END AS city,
               COALESCE(s.segment, c_mktsegment) AS segment,
               CAST(CASE WHEN c_custkey % 149 = 30 THEN 0 ELSE c_acctbal END AS DECIMAL(18,2)) AS monthly_income,
               CAST(NULL AS DATE) AS created_at
        FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (VALUES ('AUTOMOBILE', 'Premium'), ('BUILDING', 'Mass Market'), ('HOUSEHOLD', 'Mass Market'),
                          ('MACHINERY', 'SME')) s(market, segment) ON s.market = c_mktsegment"""),
    ("raw_loans", """
        SELECT CASE WHEN k % 997 = 5 THEN ' ' WHEN k % 499 = 3 THEN CAST(k + 1 AS VARCHAR)
                    ELSE CAST(k AS VARCHAR) END AS loan_id,
               CASE WHEN k % 523 = 17 THEN '999999999' WHEN k % 541 = 19 THEN ' '
                    ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN k % 8 = 0 THEN CAST(DATE '1991-01-15' + CAST(31 * ((k // 8) % 5) AS INTEGER) AS DATE)
                    ELSE CAST(o_orderdate AS DATE) END AS origination_date,
               CAST(CASE WHEN k % 499 = 3 THEN 0 WHEN k % 577 = 23 THEN 10 ELSE o_totalprice END AS DECIMAL(18,2))
                   AS principal_amount,
               CAST(CASE WHEN k % 503 = 7 THEN 1.5 ELSE COALESCE(p.rate, 0.18) END AS DECIMAL(6,4)) AS annual_rate,
               CAST(CASE WHEN k % 521 = 13 THEN 0 ELSE 6 + k % 19 END AS INTEGER) AS term_months,
               CASE WHEN k % 509 = 11 THEN 'UNKNOWN' ELSE COALESCE(t.status, o_orderstatus) END AS loan_status,
               COALESCE(p.product, 'SME') AS product_type
        FROM (SELECT *, o_orderkey AS k FROM orders) o
        LEFT JOIN (VALUES ('1-URGENT', 0.32, 'Payroll'), ('2-HIGH', 0.28, 'Payroll'), ('3-MEDIUM', 0.24, 'Digital'),
                          ('4-NOT SPECIFIED', 0.20, 'Digital')) p(priority, rate, product)
               ON p.priority = o_orderpriority
        LEFT JOIN (VALUES ('O', 'ACTIVE'), ('F', 'CLOSED'), ('P', 'DEFAULT')) t(letter, status)
               ON t.letter = o_orderstatus"""),
    ("lines", """
        SELECT l_orderkey AS k, l_linenumber AS n, 10 * l_orderkey + l_linenumber AS u,
               MAX(CAST(l_shipdate AS DATE)) AS shipped,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS price,
               CAST(MAX(l_tax) AS DECIMAL(4,2)) AS tax,
               COUNT(*) FILTER (WHERE l_linestatus = 'F') AS n_final,
               COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
               COUNT(*) FILTER (WHERE l_returnflag = 'N') AS n_open
        FROM lineitem GROUP BY ALL"""),
    ("raw_installments", """
        SELECT CASE WHEN u % 997 = 5 THEN ' ' WHEN u % 977 = 13 THEN 'dup-' || CAST(k % 50 AS VARCHAR)
                    ELSE CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) END AS installment_id,
               CAST(k AS VARCHAR) AS loan_id,
               IF(n = 7, 99, n) AS installment_number,
               CASE WHEN k % 8 = 0 THEN CAST(DATE '1998-12-01' + CAST(30 * n AS INTEGER) AS DATE) ELSE shipped END
                   AS due_date,
               CAST(IF(u % 983 = 11, -price, price) AS DECIMAL(18,2)) AS principal_due,
               CAST(ROUND(price * tax, 2) AS DECIMAL(18,2)) AS interest_due,
               CASE WHEN u % 991 = 7 THEN 'WEIRD'
                    WHEN k % 8 = 0 THEN IF((7 * k + 13 * n) % 100 < [0, 3, 10, 20, 50][CAST((k // 8) % 5 + 1 AS INTEGER)],
                                           'LATE', 'DUE')
                    WHEN n_final > 0 THEN 'PAID' WHEN n_returned > 0 THEN 'LATE'
                    WHEN n_open > 0 THEN 'DUE' ELSE 'PARTIAL' END AS installment_status
        FROM {lines}"""),
    ("raw_payments", """
        SELECT CASE WHEN e % 97 = 5 THEN ' ' WHEN e % 40 = 39 THEN CAST(e - 1 AS VARCHAR)
                    ELSE CAST(e AS VARCHAR) END AS payment_id,
               CASE WHEN e % 107 = 11 THEN '999999999' ELSE CAST(loan AS VARCHAR) END AS loan_id,
               CASE WHEN e % 109 <> 13 THEN CAST(loan AS VARCHAR) || '-' || CAST(1 + e % 8 AS VARCHAR) END
                   AS installment_id,
               CAST(ts AS DATE) AS payment_date,
               CAST(IF(e % 101 = 7, -value, value) AS DECIMAL(18,2)) AS payment_amount,
               NULLIF(event_type, 'view') AS payment_channel,
               CASE WHEN e % 103 = 9 THEN 'MYSTERY' ELSE COALESCE(s.status, 'CONFIRMED') END AS payment_status,
               CAST(ts AS TIMESTAMP) AS loaded_at
        FROM (SELECT *, event_id AS e, IF(event_id % 2 = 0, user_id, event_id % 1400) AS loan FROM events) v
        LEFT JOIN (VALUES ('error', 'REVERSED'), ('signup', 'PENDING')) s(kind, status) ON s.kind = event_type"""),
]

_STAGED = [
    ("judged_customers", f"""
        SELECT TRIM(customer_id) AS customer_id, TRIM(full_name) AS full_name, TRIM(city) AS city,
               TRIM(segment) AS segment, monthly_income, created_at,
               {listed(('missing_id', blank('customer_id')), ('invalid_income', low('monthly_income')),
                       ('invalid_segment', outside('TRIM(segment)', 'segment')))} AS broken
        FROM {{raw_customers}}"""),
    ("judged_loans", f"""
        SELECT TRIM(loan_id) AS loan_id, TRIM(customer_id) AS customer_id, origination_date, principal_amount,
               annual_rate, ROUND(annual_rate / 12, 6) AS monthly_rate, term_months, status AS loan_status,
               TRIM(product_type) AS product_type, strftime(origination_date, '%Y-%m') AS cohort_month,
               ROUND(principal_amount * (annual_rate / 12)
                     / NULLIF(1 - POWER(1 + annual_rate / 12, -term_months), 0), 0) AS level_payment,
               {listed(('missing_id', blank('loan_id')), ('missing_customer', blank('customer_id')),
                       ('invalid_amount', low('principal_amount')),
                       ('invalid_rate', f"{low('annual_rate')} OR annual_rate > 1"),
                       ('invalid_term', low('term_months')),
                       ('invalid_status', outside('status', 'loan')))} AS broken
        FROM (SELECT *, UPPER(TRIM(loan_status)) AS status FROM {{raw_loans}})"""),
    ("judged_installments", f"""
        SELECT TRIM(installment_id) AS installment_id, TRIM(loan_id) AS loan_id, installment_number, due_date,
               principal_due, interest_due, COALESCE(principal_due, 0) + COALESCE(interest_due, 0) AS total_due,
               i.status AS installment_status,
               IF(i.status <> 'PAID', GREATEST(age, 0), 0) AS days_late,
               COALESCE(s.at_once OR (NOT s.at_once AND age > 0), FALSE) AS in_arrears,
               CASE WHEN i.status = 'PAID' THEN 'Al dia' ELSE COALESCE(a.label, 'Por vencer') END AS aging_bucket,
               {listed(('missing_id', blank('installment_id')), ('missing_loan', blank('loan_id')),
                       ('invalid_status', outside('i.status', 'installment')),
                       ('outlier_number', 'installment_number = 99'))} AS broken
        FROM (SELECT *, UPPER(TRIM(installment_status)) AS status, CAST(@today - due_date AS INTEGER) AS age
              FROM {{raw_installments}}) i
        LEFT JOIN {{standing}} s ON s.status = i.status
        LEFT JOIN {{aging}} a ON age BETWEEN a.first_day AND a.last_day"""),
    ("judged_payments", f"""
        SELECT TRIM(payment_id) AS payment_id, TRIM(loan_id) AS loan_id, TRIM(installment_id) AS installment_id,
               payment_date, payment_amount, COALESCE(TRIM(payment_channel), 'UNKNOWN') AS payment_channel,
               status AS payment_status,
               COALESCE(TRIM(installment_id) NOT IN (SELECT installment_id FROM {{raw_installments}}), FALSE)
                   AS orphan_installment,
               loaded_at,
               {listed(('missing_id', blank('payment_id')), ('invalid_amount', low('payment_amount')),
                       ('invalid_status', outside('status', 'payment')), ('reversed', "status = 'REVERSED'"),
                       ('pending', "status = 'PENDING'"))} AS broken
        FROM (SELECT *, UPPER(TRIM(payment_status)) AS status FROM {{raw_payments}})"""),
    *[(f"stg_{t}", f"SELECT * EXCLUDE (broken) FROM {{judged_{t}}} WHERE len(broken) = 0")
      for t in ("customers", "loans", "installments", "payments")],
]

_MART = [
    ("tagged", f"""
        SELECT loan_id, total_due, days_late, installment_number,
               unnest({listed(('all', 'TRUE'), ('paid', "installment_status = 'PAID'"),
                              ('open', "installment_status <> 'PAID'"), ('arrears', 'in_arrears'),
                              ('upcoming', "installment_status = 'DUE' AND due_date >= @today"))}) AS tag
        FROM {{stg_installments}}"""),
    ("inst_rollup", f"""
        SELECT loan_id, {', '.join(f"COUNT(*) FILTER (WHERE tag = '{t}') AS {n}" for t, n in (
                   ('all', 'n_installments'), ('paid', 'n_paid'), ('arrears', 'n_arrears'), ('upcoming', 'n_upcoming')))},
               {', '.join(f"{money(f"SUM(total_due) FILTER (WHERE tag = '{t}')")} AS {n}" for t, n in (
                   ('open', 'balance_open'), ('arrears', 'balance_arrears'), ('upcoming', 'balance_current')))},
               MAX(days_late) AS max_days_late,
               MAX(installment_number) FILTER (WHERE days_late > 0) AS worst_installment_number
        FROM {{tagged}} GROUP BY loan_id"""),
    # how often an installment id is staged, and how often of these in arrears
    ("units", """
        SELECT installment_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE in_arrears) AS n_arrears
        FROM {stg_installments} GROUP BY installment_id"""),
    ("cash", """
        SELECT p.*, COALESCE(u.n, 0) AS n_units, COALESCE(u.n_arrears, 0) AS n_arrears
        FROM {stg_payments} p LEFT JOIN {units} u USING (installment_id)"""),
    ("pay_rollup", f"""
        SELECT loan_id, COUNT(*) AS n_payments, CAST(SUM(payment_amount) AS {MONEY}) AS collected,
               {money('SUM(payment_amount) FILTER (WHERE n_arrears > 0 AND NOT orphan_installment)')}
                   AS collected_arrears,
               MAX(payment_date) AS last_payment_date
        FROM {{cash}} GROUP BY loan_id"""),
    ("open_loans", """
        SELECT l.*, c.full_name, c.city, c.segment, c.monthly_income
        FROM {stg_loans} l LEFT JOIN {stg_customers} c USING (customer_id)
        WHERE l.loan_status <> 'CLOSED'"""),
    ("mart", f"""
        SELECT loan_id, customer_id, full_name AS customer_name, city, segment, product_type AS product,
               origination_date, cohort_month, principal_amount AS principal, annual_rate, term_months,
               loan_status, monthly_income,
               {', '.join(f'COALESCE({c}, 0) AS {c}' for c in ('n_installments', 'n_paid', 'n_arrears', 'n_upcoming'))},
               {', '.join(f'{money(c)} AS {c}' for c in ('balance_open', 'balance_arrears', 'balance_current'))},
               CAST(principal_amount - COALESCE(balance_open, 0) AS {MONEY}) AS recovered_est,
               COALESCE(max_days_late, 0) AS max_days_late,
               COALESCE(a.label, 'Al dia') AS aging_bucket,
               loan_status = 'DEFAULT' OR COALESCE(n_arrears, 0) > 0 AS in_arrears,
               COALESCE(n_payments, 0) AS n_payments,
               {money('collected')} AS collected, {money('collected_arrears')} AS collected_arrears,
               last_payment_date,
               {pct('COALESCE(collected_arrears, 0)', 'COALESCE(balance_arrears, 0)')} AS arrears_coverage_pct,
               @today AS as_of
        FROM {{open_loans}} LEFT JOIN {{inst_rollup}} USING (loan_id) LEFT JOIN {{pay_rollup}} USING (loan_id)
        LEFT JOIN {{aging}} a ON max_days_late BETWEEN a.first_day AND a.last_day"""),
]

_VIEWS = [
    ("disbursement_daily", f"""
        SELECT origination_date AS disbursement_date, city, segment, product_type AS product,
               COUNT(loan_id) AS n_loans, CAST(SUM(principal_amount) AS {MONEY}) AS total_disbursed,
               CAST(SUM(principal_amount) AS DOUBLE) / COUNT(principal_amount) AS avg_disbursed,
               MAX(principal_amount) AS max_disbursed, MIN(principal_amount) AS min_disbursed
        FROM {{stg_loans}} LEFT JOIN {{stg_customers}} USING (customer_id)
        GROUP BY ALL"""),
    # a payment counts once per staged installment of its id, at least once
    ("collections_daily", f"""
        SELECT payment_date AS collection_date, CAST(SUM(w) AS BIGINT) AS n_payments,
               {money('SUM(payment_amount * w)')} AS total_collected,
               {money('SUM(payment_amount * n_arrears)')} AS collected_arrears,
               {money('SUM(payment_amount * (w - n_arrears))')} AS collected_current,
               {pct('SUM(payment_amount * n_arrears)', 'SUM(payment_amount * w)')} AS arrears_pct
        FROM (SELECT payment_date, payment_amount, n_arrears, GREATEST(n_units, 1) AS w
              FROM {{cash}} WHERE NOT orphan_installment)
        GROUP BY payment_date"""),
    ("cohort_portfolio", f"""
        SELECT cohort_month, COUNT(loan_id) AS n_loans, CAST(SUM(principal) AS {MONEY}) AS total_disbursed,
               {', '.join(f'CAST(SUM({c}) AS {MONEY}) AS {c}' for c in (
                   'balance_current', 'balance_arrears', 'balance_open'))},
               {pct('SUM(balance_arrears)', 'SUM(balance_open)')} AS arrears_pct,
               MAX(max_days_late) AS max_days_late, COUNT(*) FILTER (WHERE in_arrears) AS n_loans_arrears,
               {pct('CAST(COUNT(*) FILTER (WHERE in_arrears) AS DOUBLE)', 'COUNT(loan_id)')} AS loans_arrears_pct
        FROM {{mart}} GROUP BY cohort_month"""),
    ("bi_dataset", f"""
        SELECT m.*, CAST(year(origination_date) AS INTEGER) AS orig_year,
               CAST(month(origination_date) AS INTEGER) AS orig_month,
               CAST(quarter(origination_date) AS INTEGER) AS orig_quarter,
               CAST(ROUND(annual_rate * 100, 2) AS DECIMAL(10,2)) AS annual_rate_pct,
               {pct('(principal / term_months)', 'monthly_income')} AS debt_burden_pct,
               {pct('CAST(n_paid AS DOUBLE)', 'n_installments')} AS progress_pct,
               {pct('recovered_est', 'principal')} AS recovery_pct,
               COALESCE(a.place, 0) AS bucket_rank,
               CAST(as_of - last_payment_date AS INTEGER) AS days_since_payment
        FROM {{mart}} m LEFT JOIN {{aging}} a ON max_days_late BETWEEN a.first_day AND a.last_day"""),
]

RELATIONS = [*_VALUES, *_RAW, *_STAGED, *_MART, *_VIEWS]


def chain(as_of: str = AS_OF, suffix: str = "", instead: dict[str, str] | None = None) -> str:
    """All relations as a WITH list at one cut-off, some with another text ``instead``."""
    names = {name: name + suffix for name, _ in RELATIONS}
    texts = {**dict(RELATIONS), **(instead or {})}
    return ",\n".join(f"{names[name]} AS ({texts[name].replace('@today', as_of).format(**names).strip()})"
                      for name, _ in RELATIONS)


def _rejected(table: str) -> str:
    return (f"SELECT * EXCLUDE (broken), array_to_string(broken, ',') AS reject_reasons "
            f"FROM judged_{table} WHERE len(broken) > 0")


TOTAL = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_FINAL: dict[str, str] = {
    **{f"scan_{t}": f"FROM raw_{t}" for t in ("customers", "loans", "installments", "payments")},
    **{f"stage_{t}": f"FROM stg_{t}" for t in ("customers", "loans", "installments", "payments")},
    **{f"rejected_{t}": _rejected(t) for t in ("customers", "loans", "installments", "payments")},
    "installment_rollup": "FROM inst_rollup",
    "payment_rollup": "FROM pay_rollup",
    "portfolio_mart": "FROM mart",
    **{v: f"FROM {v}" for v in ("open_loans", "disbursement_daily", "collections_daily", "cohort_portfolio",
                                "bi_dataset")},
    "q1_disbursement": f"""
        SELECT * EXCLUDE (day_total, max_disbursed, min_disbursed), {pct('total_disbursed', 'day_total')} AS day_share_pct
        FROM (SELECT *, CAST(SUM(total_disbursed) OVER (PARTITION BY city ORDER BY disbursement_date,
                             segment NULLS LAST, product NULLS LAST {TOTAL}) AS {MONEY}) AS running_city_total,
                     SUM(total_disbursed) OVER (PARTITION BY disbursement_date) AS day_total
              FROM disbursement_daily)
        ORDER BY disbursement_date DESC, total_disbursed DESC""",
    "q2_collections": f"""
        SELECT *, CAST(SUM(total_collected) OVER (ORDER BY collection_date {TOTAL}) AS {MONEY}) AS running_total,
               CAST(SUM(total_collected) OVER week AS DOUBLE) / COUNT(total_collected) OVER week AS moving_avg_7
        FROM collections_daily
        WINDOW week AS (ORDER BY collection_date ROWS 6 PRECEDING)
        ORDER BY collection_date DESC""",
    "q2_collections_calendar": f"""
        SELECT collection_date, total_collected,
               CAST(SUM(total_collected) OVER (ORDER BY collection_date {TOTAL}) AS {MONEY}) AS running_total,
               CAST(SUM(total_collected) OVER week AS DOUBLE) / COUNT(total_collected) OVER week AS moving_avg_7d
        FROM collections_daily
        WINDOW week AS (ORDER BY collection_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
        ORDER BY collection_date DESC""",
    "q3_cohort_health": """
        SELECT c.* RENAME (cohort_month AS cohort),
               CASE WHEN c.arrears_pct = 0 THEN 'Sana' ELSE COALESCE(h.label, 'Deterioro severo') END AS cohort_class
        FROM cohort_portfolio c LEFT JOIN health h ON c.arrears_pct >= h.lo AND c.arrears_pct < h.hi
        ORDER BY cohort""",
    "q4_top_delinquent": f"""
        SELECT ROW_NUMBER() OVER (ORDER BY max_days_late DESC, balance_arrears DESC, loan_id) AS rank, loan_id,
               customer_name, city, segment, product, loan_status, principal, balance_arrears, balance_open,
               max_days_late, aging_bucket, n_arrears, n_installments, last_payment_date, days_since_payment,
               {pct('balance_arrears', 'principal')} AS arrears_share_pct
        FROM bi_dataset WHERE in_arrears QUALIFY rank <= 10 ORDER BY rank""",
    "q5_bi_ordered": "FROM bi_dataset ORDER BY origination_date DESC, principal DESC, loan_id",
    "q5_exec_summary": f"""
        SELECT as_of, COUNT(loan_id) AS n_loans,
               {', '.join(f'CAST(SUM({c}) AS {MONEY}) AS {n}' for c, n in (
                   ('principal', 'portfolio'), ('balance_arrears', 'arrears_total'),
                   ('balance_current', 'current_total'), ('collected', 'collected_total')))},
               {pct('SUM(balance_arrears)', 'SUM(balance_open)')} AS arrears_pct,
               COUNT(*) FILTER (WHERE in_arrears) AS n_in_arrears,
               COUNT(DISTINCT city) AS n_cities, COUNT(DISTINCT segment) AS n_segments
        FROM mart GROUP BY as_of""",
    "portfolio_kpis": f"""
        SELECT COUNT(loan_id) AS n_loans, CAST(SUM(principal) AS {MONEY}) AS portfolio,
               CAST(SUM(balance_arrears) AS {MONEY}) AS arrears_total,
               {pct('SUM(balance_arrears)', 'SUM(balance_open)')} AS arrears_pct,
               COUNT(*) FILTER (WHERE in_arrears) AS n_in_arrears, MAX(max_days_late) AS max_days_late
        FROM mart""",
}

# ------------------------------------------------------------------------------ quality checks


def _count(table: str, cond: str) -> str:
    return f"(SELECT COUNT(*) FROM raw_{table} WHERE {cond.format(vocab='vocab')})"


def _repeated(table: str, keys: str, cond: str = "TRUE") -> str:
    return f"(SELECT COUNT(*) FROM (SELECT 1 FROM raw_{table} WHERE {cond} GROUP BY {keys} HAVING COUNT(*) > 1))"


def _astray(child: str, key: str, parent: str) -> str:
    return f"{key} NOT IN (SELECT {key} FROM raw_{parent})"


_OVERCOLLECTED = f"""
    SELECT loan_id, principal_amount, {money('SUM(paid)')} AS collected
    FROM raw_loans LEFT JOIN (
        SELECT loan_id, SUM(payment_amount) AS paid FROM raw_payments
        WHERE UPPER(payment_status) = 'CONFIRMED' AND payment_amount > 0 GROUP BY loan_id) USING (loan_id)
    GROUP BY loan_id, principal_amount HAVING COALESCE(SUM(paid), 0) > 1.5 * principal_amount"""
_CLOSED_UNPAID = """
    SELECT i.* FROM raw_loans l JOIN raw_installments i USING (loan_id)
    WHERE UPPER(l.loan_status) = 'CLOSED' AND UPPER(i.installment_status) <> 'PAID' AND i.installment_number <> 99"""
_EMPTY_LOANS = f"""SELECT * FROM raw_loans
    WHERE loan_status IN ('ACTIVE', 'DEFAULT') AND {_astray('loans', 'loan_id', 'installments')}"""

# (table, check, count, threshold), numbered in this order
_CHECKS = [
    ("customers", "pk_not_null", _count("customers", blank("customer_id")), 0),
    ("customers", "pk_unique", _repeated("customers", "customer_id"), 0),
    ("customers", "segment_valid", _count("customers", outside("segment", "segment")), 0),
    ("customers", "income_positive", _count("customers", low("monthly_income")), 0),
    ("customers", "city_not_null", _count("customers", blank("city")), 0),
    ("loans", "pk_not_null", _count("loans", blank("loan_id")), 0),
    ("loans", "pk_unique", _repeated("loans", "loan_id"), 0),
    ("loans", "fk_customer", _count("loans", _astray("loans", "customer_id", "customers")), 0),
    ("loans", "amount_positive", _count("loans", low("principal_amount")), 0),
    ("loans", "rate_in_range", _count("loans", f"{low('annual_rate')} OR annual_rate > 1"), 0),
    ("loans", "status_valid", _count("loans", outside("UPPER(loan_status)", "loan")), 0),
    ("loans", "term_positive", _count("loans", low("term_months")), 0),
    ("installments", "pk_not_null", _count("installments", blank("installment_id")), 0),
    ("installments", "pk_unique", _repeated("installments", "installment_id"), 0),
    ("installments", "fk_loan", _count("installments", _astray("installments", "loan_id", "loans")), 0),
    ("installments", "status_valid", _count("installments", outside("UPPER(installment_status)", "installment")), 0),
    ("installments", "number_outlier", _count("installments", "installment_number = 99"), 1),
    ("installments", "amounts_non_negative", _count("installments", "LEAST(principal_due, interest_due) < 0"), 0),
    ("loans", "without_installments", f"(SELECT COUNT(*) FROM ({_EMPTY_LOANS}))", 0),
    ("payments", "pk_not_null", _count("payments", blank("payment_id")), 0),
    ("payments", "pk_unique", _repeated("payments", "payment_id"), 0),
    ("payments", "fk_loan", _count("payments", _astray("payments", "loan_id", "loans")), 0),
    ("payments", "orphan_installment", _count("payments", _astray("payments", "installment_id", "installments")), 1),
    ("payments", "amount_invalid", _count("payments", low("payment_amount")), 1),
    ("payments", "channel_null", _count("payments", "payment_channel IS NULL"), 1),
    ("payments", "status_valid", _count("payments", outside("UPPER(payment_status)", "payment")), 0),
    ("payments", "unconfirmed", _count("payments", "UPPER(payment_status) IN ('REVERSED', 'PENDING')"), 5),
    ("payments", "possible_duplicate", _repeated("payments", "loan_id, installment_id, payment_date",
                                                 "UPPER(payment_status) = 'CONFIRMED'"), 2),
    ("cross", "collected_vs_principal", f"(SELECT COUNT(*) FROM ({_OVERCOLLECTED}))", 0),
    ("cross", "closed_unpaid", f"(SELECT COUNT(*) FROM ({_CLOSED_UNPAID}))", 2),
]


def _report(first: int, last: int) -> str:
    rows = ",\n".join(f"({i}, '{t}', '{c}', {n}, {limit})"
                      for i, (t, c, n, limit) in enumerate(_CHECKS, start=1) if first <= i <= last)
    return f"""
        SELECT CAST(seq AS INTEGER) AS seq, table_name, check_name, CAST(n AS BIGINT) AS failed_count,
               CAST(most AS BIGINT) AS threshold, n <= most AS passed, n || ' rows with issues' AS detail
        FROM (VALUES {rows}) v(seq, table_name, check_name, n, most)"""


def _gaps(kind: str, view: str, day: str) -> str:
    return f"""
        SELECT '{kind}' AS kind, CAST(d AS DATE) AS day
        FROM (SELECT unnest(generate_series(MIN({day}), MAX({day}), INTERVAL 1 DAY)) AS d FROM {view})
        WHERE CAST(d AS DATE) NOT IN (SELECT {day} FROM {view})"""


_NEWEST = "QUALIFY ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY loaded_at DESC) = 1"
_STAGES = [("raw", t, f"raw_{t}") for t in ("customers", "loans", "installments", "payments")]
_FINAL.update({
    "quality_customers": _report(1, 5), "quality_loans": _report(6, 12), "quality_installments": _report(13, 19),
    "quality_payments": _report(20, 28), "quality_cross": _report(29, 30), "quality_report": _report(1, 30),
    "quality_by_window": _report(1, 30),
    "collections_vs_target": f"""
        SELECT channel, payment_date, CAST(SUM(payment_amount) AS {MONEY}) AS collected, daily_target,
               SUM(payment_amount) >= daily_target AS met
        FROM stg_payments JOIN (VALUES ('click', DATE '2024-01-05', CAST(4000 AS DECIMAL(18,2))),
                                       ('purchase', DATE '2024-01-10', CAST(3500.50 AS DECIMAL(18,2))),
                                       ('UNKNOWN', DATE '2024-01-01', NULL)) t(channel, since, daily_target)
             ON payment_channel = channel AND payment_date >= since
        GROUP BY channel, payment_date, daily_target""",
    "fk_violations": " UNION ALL ".join(
        f"SELECT '{child}.{key}' AS relation, {child[:-1]}_id AS child_id, {key} AS parent_id "
        f"FROM raw_{child} WHERE {_astray(child, key, parent)}"
        for child, key, parent in (("loans", "customer_id", "customers"), ("installments", "loan_id", "loans"),
                                   ("payments", "loan_id", "loans"))),
    "loans_without_installments": _EMPTY_LOANS,
    "overcollected_loans": _OVERCOLLECTED,
    "closed_with_unpaid": _CLOSED_UNPAID,
    "incremental_new_payments": f"FROM stg_payments WHERE loaded_at > {MARK}",
    "watermark_state": "SELECT MAX(loaded_at) AS last_loaded_at, COUNT(*) AS n_rows FROM raw_payments",
    "staging_mark": "SELECT MAX(loaded_at) AS last_loaded_at, COUNT(*) AS n_rows FROM stg_payments",
    "incremental_upsert": f"FROM stg_payments {_NEWEST}",
    "dedup_payments": f"FROM stg_payments {_NEWEST}",
    "incremental_append": f"""
        FROM stg_payments WHERE loaded_at <= {MARK} OR payment_id NOT IN (
            SELECT payment_id FROM stg_payments WHERE loaded_at <= {MARK})""",
    # the newest version of each payment decides whether it is staged
    "incremental_merge": f"""
        SELECT * EXCLUDE (broken)
        FROM (FROM judged_payments WHERE NOT list_contains(broken, 'missing_id') {_NEWEST})
        WHERE len(broken) = 0""",
    "late_versions": f"""
        SELECT *, COALESCE(loaded_at <= {MARK}, TRUE) AS late FROM raw_payments
        WHERE loaded_at IS NULL OR loaded_at > {MARK} OR minute(loaded_at) % 11 = 0""",
    "scoped_merge": f"""
        SELECT * EXCLUDE (broken)
        FROM (FROM judged_payments WHERE NOT list_contains(broken, 'missing_id') {_NEWEST})
        WHERE len(broken) = 0""",
    "mart_by_delta": "FROM mart",
    "colocated_mart": "FROM mart",
    "mart_of_cities": "FROM mart WHERE city IN ('NATION_3', 'NATION_17')",
    "export_readback": "FROM bi_dataset",
    # sessions of equal loan and amount: a new one where the gap to the payment before exceeds a day
    "payment_doubles": f"""
        SELECT loan_id, payment_amount, MIN(loaded_at) AS first_at, MAX(loaded_at) AS last_at, COUNT(*) AS n_payments,
               COALESCE(MIN(installment_id) <> MAX(installment_id), FALSE) AS across_installments,
               CAST(payment_amount * (COUNT(*) - 1) AS {MONEY}) AS excess
        FROM (SELECT *, COUNT(*) FILTER (WHERE starts) OVER (PARTITION BY loan_id, payment_amount ORDER BY loaded_at, payment_id
                                                             {TOTAL}) AS session
              FROM (SELECT *, COALESCE(loaded_at - LAG(loaded_at) OVER (PARTITION BY loan_id, payment_amount
                                       ORDER BY loaded_at, payment_id) > INTERVAL 24 HOUR, TRUE) AS starts
                    FROM (FROM stg_payments UNION ALL BY NAME
                          SELECT * REPLACE (payment_id || '-retry' AS payment_id, loan_id || '-9' AS installment_id,
                                            loaded_at + to_hours(CAST(payment_id AS BIGINT) % 7 * 5) AS loaded_at)
                          FROM stg_payments WHERE CAST(payment_id AS BIGINT) % 20 = 0)
                    WHERE loaded_at IS NOT NULL))
        GROUP BY loan_id, payment_amount, session HAVING COUNT(*) > 1""",
    # every state of every cut-off, then the ones that differ from the cut-off before
    "loan_history_series": """
        SELECT loan_id, loan_status, aging_bucket, in_arrears, valid_from,
               LEAD(valid_from) OVER (PARTITION BY loan_id ORDER BY valid_from) AS valid_to
        FROM (SELECT *, LAG((aging_bucket, in_arrears)) OVER (PARTITION BY loan_id ORDER BY valid_from) AS was
              FROM (SELECT o.loan_id, o.loan_status, d AS valid_from, COALESCE(MAX(a.label), 'Al dia') AS aging_bucket,
                           o.loan_status = 'DEFAULT' OR COALESCE(MAX(f.arrears), FALSE) AS in_arrears
                    FROM open_loans o
                    CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1997-08-01', DATE '1998-07-01', INTERVAL 1 MONTH)) AS DATE) AS d)
                    LEFT JOIN (SELECT loan_id, d, MAX(IF(installment_status <> 'PAID', GREATEST(CAST(d - due_date AS INTEGER), 0), 0)) AS late,
                                      BOOL_OR(COALESCE(installment_status IN ('LATE', 'PARTIAL')
                                              OR (installment_status = 'DUE' AND due_date < d), FALSE)) AS arrears
                               FROM stg_installments, (SELECT CAST(unnest(generate_series(DATE '1997-08-01', DATE '1998-07-01',
                                                                                          INTERVAL 1 MONTH)) AS DATE) AS d)
                               GROUP BY ALL) f USING (loan_id, d)
                    LEFT JOIN aging a ON f.late BETWEEN a.first_day AND a.last_day
                    GROUP BY o.loan_id, o.loan_status, d))
        WHERE was IS NULL OR was <> (aging_bucket, in_arrears)""",
    "incremental_mart_refresh": "FROM mart",
    "loan_upsert": """
        SELECT * REPLACE (IF(CAST(loan_id AS BIGINT) % 10 = 0, 'CLOSED', loan_status) AS loan_status) FROM stg_loans
        UNION ALL
        SELECT * REPLACE ('N-' || loan_id AS loan_id) FROM stg_loans WHERE CAST(loan_id AS BIGINT) % 10 = 0""",
    "strict_arrears": f"""
        SELECT installment_id, loan_id, due_date, days_late FROM stg_installments
        WHERE due_date < {AS_OF} AND installment_status IN ('LATE', 'PARTIAL', 'DUE')""",
    "collections_by_channel": f"""
        SELECT COALESCE(m.channel, p.payment_channel) AS payment_channel, COUNT(*) AS n_payments,
               {money('SUM(payment_amount)')} AS total
        FROM stg_payments p LEFT JOIN (VALUES ('CLICK', 'APP'), ('PURCHASE', 'CARD'), ('UNKNOWN', 'BRANCH'))
             m(alias, channel) ON m.alias = UPPER(p.payment_channel)
        GROUP BY ALL""",
    "running_total": f"""
        SELECT payment_id, loan_id, payment_amount, loaded_at,
               CAST(SUM(payment_amount) OVER (ORDER BY loaded_at, payment_id {TOTAL}) AS {MONEY}) AS running_total
        FROM stg_payments""",
    "zero_activity_days": _gaps("disbursement", "disbursement_daily", "disbursement_date") + " UNION ALL "
                          + _gaps("collections", "collections_daily", "collection_date"),
    "row_counts": " UNION ALL ".join(
        [f"SELECT 'raw' AS layer, '{t}' AS table_name, COUNT(*) AS n_rows FROM raw_{t} UNION ALL "
         f"SELECT IF(len(broken) = 0, 'staging', 'rejected'), '{t}', COUNT(*) FROM judged_{t} GROUP BY ALL"
         for t in ("customers", "loans", "installments", "payments")]
        + ["SELECT 'analytics', 'portfolio_mart', COUNT(*) FROM mart"]),
})

# --------------------------------------------------------------------- history (two cut-offs)
# Versions of a loan's state: both cut-offs side by side; the earlier state ends where the later differs.
_STATE = "struct_pack(loan_status := loan_status, aging_bucket := aging_bucket, in_arrears := in_arrears)"
_HISTORY = f"""
    SELECT loan_id, unnest(CASE WHEN was IS NULL THEN [v_new] WHEN now = was THEN [v_old]
                                WHEN now IS NULL THEN [v_end] ELSE [v_end, v_new] END, max_depth := 2)
    FROM (SELECT loan_id, was, now,
                 struct_pack(s := was, valid_from := {PREV_AS_OF}, valid_to := CAST(NULL AS DATE)) AS v_old,
                 struct_pack(s := was, valid_from := {PREV_AS_OF}, valid_to := {AS_OF}) AS v_end,
                 struct_pack(s := now, valid_from := {AS_OF}, valid_to := CAST(NULL AS DATE)) AS v_new
          FROM (SELECT loan_id, {_STATE} AS was FROM mart_before)
          FULL JOIN (SELECT loan_id, {_STATE} AS now FROM mart) USING (loan_id))"""


def oracle_queries() -> dict[str, str]:
    out = {name: f"WITH {chain()}\n{sql.strip()}" for name, sql in _FINAL.items()}
    out["loan_status_history"] = (
        f"WITH {chain()},\n{chain(PREV_AS_OF, '_before')}\nSELECT loan_id, s.loan_status AS loan_status, "
        f"s.aging_bucket AS aging_bucket, s.in_arrears AS in_arrears, valid_from, valid_to FROM ({_HISTORY})")
    # the jobs stage the newest version of a payment
    newest = _FINAL["scoped_merge"].replace("judged_payments", "{judged_payments}")
    out["incremental_job_mart"] = f"WITH {chain(instead={'stg_payments': newest})}\nFROM mart"
    return out
