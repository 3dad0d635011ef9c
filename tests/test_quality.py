from pyspark.sql import functions as F

from fixtures import FixtureRaw
from loanlake.operators import quality
from loanlake.operators.existence import not_in_rows

EXPECTED = {
    "customers.pk_not_null": 1, "customers.pk_unique": 0, "customers.segment_valid": 1,
    "customers.income_positive": 1, "customers.city_not_null": 1,
    "loans.pk_not_null": 0, "loans.pk_unique": 0, "loans.fk_customer": 1, "loans.amount_positive": 1,
    "loans.rate_in_range": 1, "loans.status_valid": 2, "loans.term_positive": 1,
    "installments.pk_not_null": 0, "installments.pk_unique": 0, "installments.fk_loan": 1,
    "installments.status_valid": 1, "installments.number_outlier": 1,
    "installments.amounts_non_negative": 0, "loans.without_installments": 4,
    "payments.pk_not_null": 0, "payments.pk_unique": 0, "payments.fk_loan": 0,
    "payments.orphan_installment": 1, "payments.amount_invalid": 1, "payments.channel_null": 1,
    "payments.status_valid": 0, "payments.unconfirmed": 2, "payments.possible_duplicate": 0,
    "cross.collected_vs_principal": 0, "cross.closed_unpaid": 1,
}


def test_report_counts_on_fixtures(spark):
    raw = FixtureRaw(spark)
    rows = quality.quality_report(raw.customers, raw.loans, raw.installments, raw.payments).collect()
    assert len(rows) == 30
    assert sorted(r["seq"] for r in rows) == list(range(1, 31))
    got = {f"{r['table_name']}.{r['check_name']}": r["failed_count"] for r in rows}
    assert got == EXPECTED
    passed = {f"{r['table_name']}.{r['check_name']}": r["passed"] for r in rows}
    assert passed["installments.number_outlier"] is True      # 1 allowed
    assert passed["loans.status_valid"] is False


def test_not_in_null_semantics(spark):
    raw = FixtureRaw(spark)
    # a NULL key in the parent makes NOT IN never true
    with_null = raw.customers.unionByName(raw.customers.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    assert not_in_rows(raw.loans, "customer_id", with_null, "customer_id").count() == 0
    # an empty parent makes NOT IN true for every row, NULL keys included
    loans_null = raw.loans.unionByName(raw.loans.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    empty = raw.customers.where(F.lit(False))
    assert not_in_rows(loans_null, "customer_id", empty, "customer_id").count() == loans_null.count()
    # otherwise NULL child keys are never counted
    assert not_in_rows(loans_null, "customer_id", raw.customers, "customer_id").count() == 1


def test_duplicates_and_overcollection(spark):
    raw = FixtureRaw(spark)
    dup_pay = raw.payments.unionByName(raw.payments.where(F.col("payment_id") == "P1"))
    rows = {r["check_name"]: r["failed_count"]
            for r in quality.quality_payments(dup_pay, raw.loans, raw.installments).collect()}
    assert rows["pk_unique"] == 1 and rows["possible_duplicate"] == 1
    big = raw.payments.withColumn("payment_amount", F.col("payment_amount") * 100)
    over = {r["loan_id"] for r in quality.overcollected_loans(raw.loans, big).collect()}
    assert over == {"L1"}


def test_states_of_windows_add_up_to_the_report(spark):
    from functools import reduce

    from pyspark.sql import functions as F

    from loanlake.operators import check_states as S
    raw = FixtureRaw(spark)
    tables = [raw.customers, raw.loans, raw.installments, raw.payments]
    # rows that repeat keys, lack them, or come in another window than their parent; a null parent key; no parents
    doubled = [t.unionByName(t.limit(2)) for t in tables]
    no_key = doubled[1].unionByName(raw.loans.limit(1).withColumn("loan_id", F.lit(None).cast("string")))
    cases = [tables, doubled, [doubled[0], no_key, *doubled[2:]], [tables[0], tables[1].limit(0), *tables[2:]], [t.limit(0) for t in tables]]
    for case in cases:
        parts = []
        for k in range(3):
            parts.append(S.states_of(*[t.where(F.pmod(F.xxhash64(*t.columns), F.lit(3)) == k) for t in case]))
        got = S.report(reduce(S.merged, parts)).orderBy("seq").collect()
        want = [t.report() for t in quality.all_checks(*case)]
        one_by_one = reduce(lambda a, b: a.unionByName(b), want).orderBy("seq").collect()
        assert got == one_by_one and len(got) == 30
        assert quality.quality_report(*case).orderBy("seq").collect() == one_by_one


def test_states_are_grouped_once_for_all_windows(spark):
    from functools import reduce

    from loanlake.operators import check_states as S
    raw = FixtureRaw(spark)
    parts = [S.states_of(raw.customers, raw.loans, raw.installments, raw.payments) for _ in range(3)]
    all_windows = reduce(S.merged, parts)
    for name in ("customer_id", "loan_id", "installment_id", "payment_id", "same_day", "amounts", "cash"):
        assert "Aggregate" not in all_windows[name]._jdf.queryExecution().optimizedPlan().toString()
    kept = S.summed(all_windows)
    for name, key in S.KEYS.items():
        assert kept[name].count() == kept[name].select(*key).distinct().count()
        assert sorted(kept[name].columns) == sorted(parts[0][name].columns)
    n_loans = {r["_key"]: r["loans"] for r in kept["loan_id"].collect()}
    assert n_loans["L1"] == 3
    assert S.report(kept).orderBy("seq").collect() == S.report(all_windows).orderBy("seq").collect()
