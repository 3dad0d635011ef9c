import datetime as dt

from pyspark.sql import functions as F

from loanlake.functions import expr as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_round_half_away_matches_scale_then_round(spark):
    assert one(spark, X.round_half_away(F.lit(1.005), 2)) == 1.0
    assert one(spark, X.round_half_away(F.lit(2.5), 0)) == 3.0
    assert one(spark, X.round_half_away(F.lit(-2.5), 0)) == -3.0
    assert one(spark, X.round_half_away(F.lit(0.125), 2)) == 0.13


def test_safe_pct_zero_and_null_denominator(spark):
    assert one(spark, X.safe_pct(F.lit(1), F.lit(0))) is None
    assert one(spark, X.safe_pct(F.lit(1), F.lit(None).cast("double"))) is None
    assert one(spark, X.safe_pct(F.lit(1), F.lit(3))) == 33.33


def test_flag_turns_null_into_false(spark):
    null_status = F.lit(None).cast("string")
    assert one(spark, X.flag(X.not_in(null_status, ["A", "B"]))) is False
    assert one(spark, X.flag(X.not_in(F.lit("C"), ["A", "B"]))) is True


def test_level_payment_annuity(spark):
    v = one(spark, X.level_payment(F.lit(12_000_000).cast("decimal(18,2)"),
                                    F.lit(0.24).cast("decimal(6,4)"), F.lit(12)))
    assert v == 1134715.0


def test_monthly_rate_and_cohort(spark):
    assert one(spark, X.monthly_rate(F.lit(0.25).cast("decimal(6,4)"))) == 0.020833
    assert one(spark, X.cohort_month(F.lit(dt.date(2024, 3, 9)))) == "2024-03"


def test_installment_bucket_boundaries(spark):
    as_of = dt.date(2030, 6, 30)
    cases = {-91: "+90 dias", -90: "61-90 dias", -61: "61-90 dias", -60: "31-60 dias",
             -31: "31-60 dias", -30: "1-30 dias", -1: "1-30 dias", 0: "Por vencer",
             1: "Por vencer"}
    for delta, label in cases.items():
        due = F.lit(as_of + dt.timedelta(days=delta))
        got = one(spark, X.installment_bucket(F.lit("DUE"), due, X.as_of_lit(as_of)))
        assert got == label, (delta, got)
    assert one(spark, X.installment_bucket(F.lit("PAID"), F.lit(as_of), X.as_of_lit(as_of))) == "Al dia"


def test_loan_bucket_and_rank_agree(spark):
    for days, label, rank in [(0, "Al dia", 0), (1, "1-30 dias", 1), (30, "1-30 dias", 1),
                              (31, "31-60 dias", 2), (61, "61-90 dias", 3), (91, "+90 dias", 4)]:
        assert one(spark, X.loan_bucket(F.lit(days))) == label
        assert one(spark, X.bucket_rank(F.lit(days))) == rank


def test_cohort_health_null_is_worst(spark):
    assert one(spark, X.cohort_health(F.lit(None).cast("double"))) == "Deterioro severo"
    assert one(spark, X.cohort_health(F.lit(0.0))) == "Sana"
    assert one(spark, X.cohort_health(F.lit(4.99))) == "Bajo riesgo"
    assert one(spark, X.cohort_health(F.lit(29.99))) == "Riesgo alto"
