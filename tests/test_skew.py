"""A hot loan / installment holding a third of all payments: the pre-aggregated rollups must
give exactly the brute-force answers."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from fixtures import AS_OF, FixtureRaw, d, ts
from loanlake.operators.upsert import dedup_latest
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel
from loanlake.sources import schemas


def skewed_payments(spark, n_hot=600, n_other=1200):
    hot = [(f"H{i}", "L1", "I1", d(-80 + i % 5), D("1.25"), "PSE", "CONFIRMED", ts(i % 7)) for i in range(n_hot)]
    loans, insts = ["L1", "L2", "L4", "L5"], ["I3", "I4", "I7", "I8", "I12", "I404"]
    other = [(f"O{i}", loans[i % 4], insts[i % 6], d(-90 + i % 30), D("2.50"), "ACH", "CONFIRMED", ts(i % 9))
             for i in range(n_other)]
    return spark.createDataFrame(hot + other, schemas.PAYMENTS)


def test_hot_key_rollups_match_brute_force(spark):
    pays = skewed_payments(spark)
    m = LendingModel(FixtureRaw(spark, {"payments": pays}), AS_OF)
    staged = m.payments.toPandas()
    inst = m.installments.toPandas()
    arrears_ids = set(inst.loc[inst.in_arrears, "installment_id"])

    got = {r["loan_id"]: r for r in m.payment_rollup.collect()}
    for loan, g in staged.groupby("loan_id"):
        applied = g[(~g.orphan_installment) & g.installment_id.isin(arrears_ids)]
        assert got[loan]["n_payments"] == len(g)
        assert got[loan]["collected"] == sum(g.payment_amount)
        assert got[loan]["collected_arrears"] == sum(applied.payment_amount, D("0"))

    daily = {r["collection_date"]: r for r in V.collections_daily(m.payments, m.installments).collect()}
    flags = dict(zip(inst.installment_id, inst.in_arrears))
    kept = staged[~staged.orphan_installment]
    for day, g in kept.groupby("payment_date"):
        arrears = sum((a for a, i in zip(g.payment_amount, g.installment_id) if flags.get(i) is True), D("0"))
        assert daily[day]["n_payments"] == len(g)
        assert daily[day]["total_collected"] == sum(g.payment_amount)
        assert daily[day]["collected_arrears"] == arrears


def test_hot_key_dedup_keeps_one_row_per_key(spark):
    pays = skewed_payments(spark).withColumn("payment_id", F.when(F.col("payment_id").startswith("H"), F.lit("HOT"))
                                             .otherwise(F.col("payment_id")))
    out = dedup_latest(pays, ["payment_id"], ["loaded_at"])
    assert out.count() == 1 + 1200
    hot = out.where("payment_id = 'HOT'").first()
    assert hot["loaded_at"] == ts(6)


def test_collections_preserve_left_join_fan_out_on_duplicate_installment_ids(spark):
    from fixtures import INSTALLMENTS
    # the same installment id twice: one copy in arrears (LATE), one not (DUE in the future)
    dup = [("I1", "L1", 7, d(30), D("5.00"), D("0.50"), "DUE")]
    m = LendingModel(FixtureRaw(spark, {"installments": spark.createDataFrame(INSTALLMENTS + dup,
                                                                            schemas.INSTALLMENTS)}), AS_OF)
    pays, inst = m.payments.toPandas(), m.installments.toPandas()
    rows = {}
    for _, p in pays[~pays.orphan_installment].iterrows():  # row-level LEFT JOIN, as in SQL
        matches = inst[inst.installment_id == p.installment_id]
        flags = list(matches.in_arrears) or [False]
        for f in flags:
            n, tot, arr = rows.get(p.payment_date, (0, D("0"), D("0")))
            rows[p.payment_date] = (n + 1, tot + p.payment_amount, arr + (p.payment_amount if f else D("0")))
    got = {r["collection_date"]: (r["n_payments"], r["total_collected"], r["collected_arrears"])
           for r in V.collections_daily(m.payments, m.installments).collect()}
    assert got == rows
    assert got[d(-80)][0] == 3  # P1 meets both copies of I1, P2 one installment
