from decimal import Decimal as D

from pyspark.sql import functions as F

from fixtures import AS_OF, FixtureRaw, d
from loanlake.operators import staging
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel


def model(spark, **over):
    return LendingModel(FixtureRaw(spark, over), AS_OF)


def by(rows, key):
    return {r[key]: r for r in rows}


def test_staged_plus_rejected_equals_raw(spark):
    raw = FixtureRaw(spark)
    pairs = [
        (staging.stage_customers(raw.customers), staging.rejected_customers(raw.customers), raw.customers, 4),
        (staging.stage_loans(raw.loans), staging.rejected_loans(raw.loans), raw.loans, 5),
        (staging.stage_installments(raw.installments, AS_OF),
         staging.rejected_installments(raw.installments, AS_OF), raw.installments, 11),
        (staging.stage_payments(raw.payments, raw.installments),
         staging.rejected_payments(raw.payments, raw.installments), raw.payments, 7),
    ]
    for staged, rejected, src, n_staged in pairs:
        assert staged.count() == n_staged
        assert staged.count() + rejected.count() == src.count()


def test_rejection_reasons(spark):
    raw = FixtureRaw(spark)
    rej = by(staging.rejected_loans(raw.loans).collect(), "loan_id")
    assert rej["L6"]["reject_reasons"] == "invalid_amount"
    assert rej["L7"]["reject_reasons"] == "invalid_rate"
    assert rej["L8"]["reject_reasons"] == "invalid_term"
    assert rej["L9"]["reject_reasons"] == "invalid_status"
    rp = by(staging.rejected_payments(raw.payments, raw.installments).collect(), "payment_id")
    assert rp["P5"]["reject_reasons"] == "reversed"
    assert rp["P6"]["reject_reasons"] == "pending"
    assert rp["P7"]["reject_reasons"] == "invalid_amount"


def test_customer_cleaning(spark):
    rows = by(model(spark).customers.collect(), "customer_id")
    assert set(rows) == {"K1", "K2", "K3", "K4"}
    assert rows["K1"]["full_name"] == "Ana Ruiz" and rows["K1"]["city"] == "Lima"
    assert rows["K4"]["segment"] is None  # NULL segment passes the NOT IN flag


def test_installment_rules(spark):
    rows = by(model(spark).installments.collect(), "installment_id")
    assert "I10" not in rows and "I13" not in rows
    assert (rows["I1"]["days_late"], rows["I1"]["in_arrears"], rows["I1"]["aging_bucket"]) == (91, True, "+90 dias")
    assert (rows["I3"]["installment_status"], rows["I3"]["days_late"], rows["I3"]["in_arrears"]) == ("DUE", 61, True)
    # LATE with a future due date: in arrears, no days late, not yet due
    assert (rows["I5"]["days_late"], rows["I5"]["in_arrears"], rows["I5"]["aging_bucket"]) == (0, True, "Por vencer")
    # DUE on the cut-off: not in arrears
    assert (rows["I6"]["days_late"], rows["I6"]["in_arrears"]) == (0, False)
    # NULL status passes, gets no days late but a date bucket
    assert (rows["I9"]["installment_status"], rows["I9"]["days_late"], rows["I9"]["in_arrears"],
            rows["I9"]["aging_bucket"]) == (None, 0, False, "1-30 dias")
    assert rows["I7"]["total_due"] == D("800.00")  # NULL interest counts as 0


def test_payment_rules(spark):
    rows = by(model(spark).payments.collect(), "payment_id")
    assert set(rows) == {"P1", "P2", "P3", "P4", "P8", "P9", "P10"}
    assert rows["P3"]["orphan_installment"] is True
    assert rows["P8"]["orphan_installment"] is False   # outlier #99 exists in raw installments
    assert rows["P10"]["orphan_installment"] is False  # NULL key -> NOT IN is NULL -> FALSE
    assert rows["P4"]["payment_channel"] == "UNKNOWN"
    assert rows["P9"]["payment_channel"] == "" and rows["P9"]["payment_status"] is None


def test_orphan_flag_null_and_empty_parent(spark):
    raw = FixtureRaw(spark)
    with_null = raw.installments.unionByName(
        raw.installments.limit(1).withColumn("installment_id", F.lit(None).cast("string")))
    rows = by(staging.stage_payments(raw.payments, with_null).collect(), "payment_id")
    assert all(r["orphan_installment"] is False for r in rows.values())
    empty = raw.installments.where(F.lit(False))
    rows = by(staging.stage_payments(raw.payments, empty).collect(), "payment_id")
    assert all(r["orphan_installment"] is True for r in rows.values())


def test_mart_values(spark):
    rows = by(model(spark).mart.collect(), "loan_id")
    assert set(rows) == {"L1", "L2", "L4", "L5"}  # CLOSED L3 absent
    l1 = rows["L1"]
    assert (l1["n_installments"], l1["n_paid"], l1["n_arrears"], l1["n_upcoming"]) == (6, 1, 4, 1)
    assert (l1["balance_open"], l1["balance_arrears"], l1["balance_current"]) == (
        D("5920.00"), D("4780.00"), D("1140.00"))
    assert l1["recovered_est"] == D("6080.00")
    assert (l1["max_days_late"], l1["aging_bucket"], l1["in_arrears"]) == (91, "+90 dias", True)
    assert (l1["n_payments"], l1["collected"], l1["collected_arrears"]) == (4, D("1920.00"), D("600.00"))
    assert l1["last_payment_date"] == d(-70) and l1["arrears_coverage_pct"] == 12.55
    l2 = rows["L2"]
    assert (l2["balance_open"], l2["balance_arrears"], l2["max_days_late"]) == (D("1650.00"), D("1650.00"), 31)
    assert (l2["collected"], l2["collected_arrears"], l2["arrears_coverage_pct"]) == (D("61.00"), D("50.00"), 3.03)
    l4 = rows["L4"]  # customer rejected -> NULL dimensions kept
    assert (l4["customer_name"], l4["city"], l4["segment"], l4["monthly_income"]) == (None, None, None, None)
    assert (l4["in_arrears"], l4["aging_bucket"], l4["arrears_coverage_pct"]) == (False, "Al dia", None)
    l5 = rows["L5"]  # no installments, no payments
    assert (l5["n_installments"], l5["balance_open"], l5["n_payments"], l5["last_payment_date"]) == (
        0, D("0.00"), 0, None)


def test_default_loan_without_late_days_is_in_arrears_and_current(spark):
    over = {"installments": spark.createDataFrame([("J1", "L2", 1, d(5), D("10.00"), D("1.00"), "DUE")],
                                                  FixtureRaw(spark).installments.schema)}
    rows = by(model(spark, **over).mart.collect(), "loan_id")
    assert (rows["L2"]["in_arrears"], rows["L2"]["aging_bucket"]) == (True, "Al dia")


def test_collections_daily_split(spark):
    m = model(spark)
    rows = by(V.collections_daily(m.payments, m.installments).collect(), "collection_date")
    assert (rows[d(-80)]["n_payments"], rows[d(-80)]["collected_arrears"], rows[d(-80)]["collected_current"],
            rows[d(-80)]["arrears_pct"]) == (2, D("500.00"), D("1220.00"), 29.07)
    assert (rows[d(-70)]["n_payments"], rows[d(-70)]["total_collected"]) == (1, D("100.00"))  # orphan left out
    # payment to the rejected #99 and a NULL installment count as current cash
    assert (rows[d(-10)]["n_payments"], rows[d(-10)]["collected_arrears"], rows[d(-10)]["collected_current"]) == (
        3, D("50.00"), D("51.00"))
    for r in rows.values():
        assert r["collected_arrears"] + r["collected_current"] == r["total_collected"]


def test_disbursement_includes_closed_and_rejected_customers(spark):
    m = model(spark)
    rows = V.disbursement_daily(m.loans, m.customers).collect()
    assert len(rows) == 5
    assert sum(r["n_loans"] for r in rows) == 5
    assert any(r["city"] is None and r["segment"] is None for r in rows)


def test_strict_rules_reject_unknown_values(spark):
    import datetime as dt

    from loanlake.operators import staging
    from loanlake.sources import schemas
    raw = spark.createDataFrame(
        [("I1", "L1", 1, dt.date(2030, 1, 1), 10, 1, "LATE"), ("I2", "L1", 2, dt.date(2020, 1, 1), 10, 1, "LATE"),
         ("I3", "L1", 3, dt.date(2020, 1, 1), 10, 1, None)],
        "installment_id string, loan_id string, installment_number int, due_date date, principal_due int, "
        "interest_due int, installment_status string")
    raw = schemas.conform(raw.select("installment_id", "loan_id", "installment_number", "due_date",
                                     raw.principal_due.cast("decimal(18,2)").alias("principal_due"),
                                     raw.interest_due.cast("decimal(18,2)").alias("interest_due"),
                                     "installment_status"), schemas.INSTALLMENTS)
    day = dt.date(2026, 1, 1)
    loose = {r.installment_id: r.in_arrears for r in staging.stage_installments(raw, day).collect()}
    strict = {r.installment_id: r.in_arrears for r in staging.stage_installments(raw, day, strict=True).collect()}
    assert loose == {"I1": True, "I2": True, "I3": False} and strict == {"I1": False, "I2": True}
    cust = spark.createDataFrame([("C1", "a", "b", None, 5, None)], "customer_id string, full_name string, city string, "
                                 "segment string, monthly_income int, created_at date")
    assert staging.stage_customers(cust).count() == 1 and staging.stage_customers(cust, strict=True).count() == 0
