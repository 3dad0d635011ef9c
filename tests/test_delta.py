"""Signed changes of rollups, histories over a series, double payments."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, FixtureRaw, ts
from loanlake.operators import delta, rollups
from loanlake.operators.doubles import payment_doubles
from loanlake.operators.history import history_series, initial_history, scd2_apply
from loanlake.plans import jobs
from loanlake.plans.model import LendingModel
from loanlake.sources import sinks
from test_jobs import published
from test_segments import files


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_states_follow_batches_with_retractions(spark):
    rng = random.Random(5)
    inst_cols = "installment_id string, loan_id string, due_date date, total_due decimal(19,2), installment_status string, days_late int, in_arrears boolean"
    pay_cols = "payment_id string, loan_id string, installment_id string, payment_date date, payment_amount decimal(18,2), orphan_installment boolean"

    def installment(i):
        late = rng.choice([0, 0, 5, 40, 90])
        return (f"i{i}", rng.choice(["a", "b", "c", None]), AS_OF - dt.timedelta(days=late), D(rng.randrange(100)), rng.choice(["PAID", "DUE", "LATE", None]),
                late, rng.random() < .4)

    def payment(i):
        return (f"p{i}", rng.choice(["a", "b", "c", None]), rng.choice([f"i{rng.randrange(20)}", None]), AS_OF - dt.timedelta(days=rng.randrange(9)),
                D(rng.randrange(1, 50)), rng.random() < .2)

    inst, pays = {i: installment(i) for i in range(20)}, {i: payment(i) for i in range(60)}

    def frames():
        return spark.createDataFrame(list(inst.values()), inst_cols), spark.createDataFrame(list(pays.values()), pay_cols)

    old = frames()
    signed = [x.withColumn(delta.SIGN, F.lit(1)) for x in old]
    state = [delta.installment_state(signed[0], AS_OF), delta.cash_state(signed[1]), delta.day_state(signed[1])]
    for batch in range(2):
        for i in rng.sample(range(20), 6):  # changed, gone and new rows; the worst delay and the last day go too
            inst[i] = installment(i)
        worst = max(inst, key=lambda i: inst[i][5])
        del inst[worst]
        last = max(pays.values(), key=lambda r: r[3])[3]
        pays = {i: r for i, r in pays.items() if r[3] != last} | {100 + 10 * batch + k: payment(k) for k in range(5)}
        inst[50 + batch] = installment(50 + batch)
        new = frames()
        ci, cp = (delta.signed_changes(a, b) for a, b in zip(old, new))
        state = [delta.added(state[0], delta.installment_state(ci, AS_OF), delta.INSTALLMENT_KEY),
                 delta.added(state[1], delta.cash_state(cp), delta.CASH_KEY), delta.added(state[2], delta.day_state(cp), delta.DAY_KEY)]
        state = [s.checkpoint() for s in state]
        old = new
        whole = new[0].withColumn("installment_number", F.lit(1))
        assert rows(delta.installment_rollup(state[0])) == rows(rollups.installment_rollup(whole, AS_OF).drop("worst_installment_number"))
        assert rows(delta.payment_rollup(state[1], state[2], new[0])) == rows(rollups.payment_rollup(new[1], new[0]))
    same = delta.signed_changes(old[0], frames()[0])
    assert same.count() == 0 and delta.added(state[0], delta.installment_state(same, AS_OF), delta.INSTALLMENT_KEY).count() == state[0].count()


def test_incremental_batches_equal_a_full_build(spark, scratch):
    """A first load, a batch with a reversal and rows a week and years late, a batch of changed loans, customers and
    installments, a batch of nothing."""
    full = FixtureRaw(spark)
    stamp = lambda t: F.lit(t).cast("timestamp_ntz")
    one = full.payments.where("payment_id = 'P1'")
    extra = [one.withColumn("payment_id", F.lit(i)).withColumn("loaded_at", stamp(t)).withColumn("payment_amount", F.lit(a).cast("decimal(18,2)"))
             for i, t, a in (("LATE-1", ts(3) - dt.timedelta(days=7), 5), ("LATE-2", dt.datetime(2024, 2, 29), 6), ("NEW", ts(9), 7),
                             ("P3", ts(2) - dt.timedelta(days=40), 8), ("P3", ts(2), 9))]  # an older and an equal stamp
    extra.append(full.payments.where("payment_id = 'P2'").withColumn("payment_status", F.lit("REVERSED")).withColumn("loaded_at", stamp(ts(8))))
    old_month = one.withColumn("payment_id", F.lit("OLD")).withColumn("loaded_at", stamp(dt.datetime(2029, 1, 1)))
    undated = one.withColumn("payment_id", F.lit("UNDATED")).withColumn("loaded_at", F.lit(None).cast("timestamp_ntz"))
    start = full.payments.where(F.col("loaded_at") <= ts(5)).unionByName(old_month)
    second = start.unionByName(full.payments.where(F.col("loaded_at") > ts(5))).unionByName(undated).unionByName(undated)
    for x in extra:
        second = second.unionByName(x)
    fewer = full.installments.where("installment_id <> 'I404'").where("installment_id <> 'I2'").withColumn(
        "installment_status", F.when(F.col("installment_id") == "I1", F.lit("PAID")).otherwise(F.col("installment_status")))
    moved = full.loans.withColumn("loan_status", F.when(F.col("loan_id") == "L2", F.lit("CLOSED")).when(
        F.col("loan_id") == "L3", F.lit("ACTIVE")).otherwise(F.col("loan_status")))
    named = full.customers.withColumn("city", F.when(F.col("customer_id") == "K4", F.lit("Cusco")).otherwise(F.col("city")))
    states = [FixtureRaw(spark, {"payments": start}), FixtureRaw(spark, {"payments": second}),
              FixtureRaw(spark, {"payments": second, "installments": fewer, "loans": moved, "customers": named})]
    first = jobs.run_incremental(spark, None, f"{scratch}/a", AS_OF, raw=states[0])
    assert first["mart"] == "rebuilt" and first["new_rows"] == start.count()
    p = sinks.Publication(spark, f"{scratch}/a")
    kept = files(p, "stg_payments", {"s203006", "-203006"})
    assert any("s202901" in f for f in kept)

    r = jobs.run_incremental(spark, None, f"{scratch}/a", AS_OF, raw=states[1])
    assert (r["late_rows"], r["new_rows"], r["read_rows"]) == (6, 3, 9) and r["mart"] == "refreshed"
    p = sinks.Publication(spark, f"{scratch}/a")
    after = files(p, "stg_payments")
    assert kept.items() <= after.items()
    ids = {x["payment_id"] for x in sinks.read_table(spark, f"{scratch}/a", "stg_payments").collect()}
    assert {"LATE-1", "LATE-2", "NEW", "UNDATED", "OLD"} <= ids and "P2" not in ids

    r = jobs.run_incremental(spark, None, f"{scratch}/a", AS_OF, raw=states[2])
    assert r["read_rows"] == 0 and 0 < r["changed_loans"] < full.loans.count()
    jobs.run_full(spark, None, f"{scratch}/b", AS_OF, raw=states[2])
    assert published(spark, f"{scratch}/a") == published(spark, f"{scratch}/b")

    seq = sinks.snapshot(spark, f"{scratch}/a").seq
    again = jobs.run_incremental(spark, None, f"{scratch}/a", AS_OF, raw=states[2])
    assert again["mart"] == "unchanged" and sinks.snapshot(spark, f"{scratch}/a").seq == seq

    # another cut-off: the mart is that of a full build, the payments' files stay, both marts are kept
    kept = files(sinks.Publication(spark, f"{scratch}/a"), "stg_payments")
    later = AS_OF + dt.timedelta(days=30)
    assert jobs.run_incremental(spark, None, f"{scratch}/a", later, raw=states[2])["mart"] == "rebuilt"
    jobs.run_full(spark, None, f"{scratch}/b", later, raw=states[2])
    assert published(spark, f"{scratch}/a") == published(spark, f"{scratch}/b")
    assert files(sinks.Publication(spark, f"{scratch}/a"), "stg_payments") == kept
    history = sinks.read_table(spark, f"{scratch}/a", "mart_history").groupBy("as_of").count().collect()
    assert {x["as_of"] for x in history} == {AS_OF, later}


def test_history_of_a_series_equals_repeated_snapshots(spark):
    raw = FixtureRaw(spark)
    cutoffs = [AS_OF + dt.timedelta(days=15 * k) for k in range(-8, 4)]
    tracked = ["loan_status", "aging_bucket", "in_arrears"]
    history = None
    for d in cutoffs:
        mart = LendingModel(raw, d).mart.select("loan_id", *tracked)
        history = initial_history(mart, "loan_id", tracked, d) if history is None else scd2_apply(history, mart, "loan_id", tracked, d)
        history = history.checkpoint()
    m = LendingModel(raw, AS_OF)
    got = history_series(m.open_loans, m.installments, cutoffs)
    assert rows(got) == rows(history) and got.count() > m.open_loans.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    with pytest.raises(ValueError):
        history_series(m.open_loans, m.installments, [])


def test_doubles_meet_across_bucket_edges(spark):
    day = dt.timedelta(days=1)
    base = dt.datetime(2030, 1, 1)
    rng = random.Random(2)
    data = [(f"a{k}", "L1", "i1", D("10.00"), base + day * k + dt.timedelta(hours=23)) for k in range(0, 9, 3)]
    data += [(f"b{k}", "L1", "i2", D("10.00"), base + day * (k + 1) + dt.timedelta(hours=2)) for k in range(0, 9, 3)]  # 3 hours on, another day
    data += [("c", "L1", None, D("10.00"), None), ("d", None, None, D("1.00"), base), ("e", None, "x", D("1.00"), base + day),
             ("f", None, None, D("1.00"), base + 2 * day + dt.timedelta(microseconds=1)), ("g", "L2", "i1", None, base), ("g", "L2", "i1", None, base)]
    data += [(f"r{i}", f"L{rng.randrange(3, 6)}", rng.choice(["i1", "i2"]), D(rng.randrange(1, 4)), base + dt.timedelta(hours=rng.randrange(900)))
             for i in range(150)]
    data += [(f"h{i}", "hot", "i1", D("5.00"), base + dt.timedelta(minutes=rng.randrange(20000))) for i in range(600)]
    df = spark.createDataFrame(data, "payment_id string, loan_id string, installment_id string, payment_amount decimal(18,2), loaded_at timestamp_ntz")
    for within in (day, dt.timedelta(hours=5)):
        groups = {}
        for _, loan, inst, amount, at in data:
            if at is not None and amount is not None:
                groups.setdefault((loan, amount), []).append((at, inst))
        want = []
        for (loan, amount), got in groups.items():
            got.sort(key=lambda x: x[0])
            session = [got[0]]
            for x in got[1:] + [(dt.datetime.max, None)]:
                if x[0] - session[-1][0] > within:
                    if len(session) > 1:
                        names = {i for _, i in session if i is not None}
                        want.append((len(names) > 1, amount * (len(session) - 1), session[0][0], session[-1][0], loan, len(session), amount))
                    session = []
                session.append(x)
        assert rows(payment_doubles(df, within)) == sorted(want, key=str)
    assert payment_doubles(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        payment_doubles(df, dt.timedelta(0))
