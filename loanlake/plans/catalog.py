"""Registry of named query plans: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every entry reads the driver tables under ``sf_dir`` through the binding, so its work grows with
them. Used by ``__spark_entry__.py`` and ``bench.py``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.functions.expr import ntz_lit
from loanlake.operators import check_states, delta, quality, staging
from loanlake.operators.doubles import payment_doubles
from loanlake.operators.history import history_series, initial_history, scd2_apply
from loanlake.operators.rollups import payment_rollup
from loanlake.operators.upsert import append_new, dedup_latest, upsert
from loanlake.plans import mart as mart_plans
from loanlake.plans import alerts, colocated, jobs
from loanlake.plans import questions as Q
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel, MaterializedModel
from loanlake.operators.windows import running_total_large
from loanlake.session import ensure_checkpoint_dir
from loanlake.sources import sinks
from loanlake.sources.literals import literal_rows
from loanlake.streaming.incremental import (changed_days, day_totals, fresh_versions, merge_payments, newest, next_mark,
                                            next_staging_mark, on_days, version_prints, versions, window_rows)

# Parameters of the registered incremental queries: the stored mark of the previous run and the
# re-read overlap before it (the upsert makes the overlap idempotent).
INCREMENTAL_MARK = dt.datetime(2024, 1, 15)
INCREMENTAL_OVERLAP = dt.timedelta(days=1)
# Delinquency-state history: the mart observed at the previous cut-off, then at the current one.
HISTORY_PREVIOUS_AS_OF = dt.date(1998, 6, 1)
HISTORY_TRACKED = ["loan_status", "aging_bucket", "in_arrears"]

HISTORY_SERIES = [dt.date(1997 + (7 + i) // 12, (7 + i) % 12 + 1, 1) for i in range(12)]
CITIES = ["NATION_3", "NATION_17"]
DOUBLES_WITHIN = dt.timedelta(hours=24)

# Master names of payment channels (parameter of the registered query).
CHANNEL_MASTER = [("click", "APP"), ("purchase", "CARD"), ("UNKNOWN", "BRANCH")]

# Daily collection targets of channels from a day on (parameter of the registered query).
CHANNEL_TARGETS = [("click", "2024-01-05", 4000), ("purchase", "2024-01-10", "3500.50"), ("UNKNOWN", "2024-01-01", None)]

QueryFn = Callable[[SparkSession, str], DataFrame]


def _m(spark: SparkSession, sf_dir: str, as_of: dt.date | None = None) -> LendingModel:
    if as_of is None:
        return LendingModel.from_driver(spark, sf_dir)
    return LendingModel.from_driver(spark, sf_dir, as_of=as_of)


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the checkpoint folder and read back, so that a plan with many uses of it neither
    groups nor joins again for each, and reads only the columns that a use needs."""
    p = sinks.Publication(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}")
    p.write(df, name)
    return p.read(name)


def _registry() -> dict[str, QueryFn]:
    r: dict[str, QueryFn] = {}

    # raw scans through the binding
    r["scan_customers"] = lambda s, d: _m(s, d).raw.customers
    r["scan_loans"] = lambda s, d: _m(s, d).raw.loans
    r["scan_installments"] = lambda s, d: _m(s, d).raw.installments
    r["scan_payments"] = lambda s, d: _m(s, d).raw.payments

    # staging and rejected rows
    r["stage_customers"] = lambda s, d: _m(s, d).customers
    r["stage_loans"] = lambda s, d: _m(s, d).loans
    r["stage_installments"] = lambda s, d: _m(s, d).installments
    r["stage_payments"] = lambda s, d: _m(s, d).payments
    r["rejected_customers"] = lambda s, d: staging.rejected_customers(_m(s, d).raw.customers)
    r["rejected_loans"] = lambda s, d: staging.rejected_loans(_m(s, d).raw.loans)
    r["rejected_installments"] = lambda s, d: staging.rejected_installments(_m(s, d).raw.installments)

    def rejected_payments(s, d):
        m = _m(s, d)
        return staging.rejected_payments(m.raw.payments, m.raw.installments)
    r["rejected_payments"] = rejected_payments

    # rollups and mart
    r["open_loans"] = lambda s, d: _m(s, d).open_loans
    r["installment_rollup"] = lambda s, d: _m(s, d).installment_rollup
    r["payment_rollup"] = lambda s, d: _m(s, d).payment_rollup
    r["portfolio_mart"] = lambda s, d: _m(s, d).mart

    # views
    def disb(s, d):
        m = _m(s, d)
        return V.disbursement_daily(m.loans, m.customers)

    def coll(s, d):
        return _m(s, d).collections_daily

    r["disbursement_daily"] = disb
    r["collections_daily"] = coll
    r["cohort_portfolio"] = lambda s, d: V.cohort_portfolio(_m(s, d).mart)
    r["bi_dataset"] = lambda s, d: V.bi_dataset(_m(s, d).mart)

    # business questions and KPIs
    r["q1_disbursement"] = lambda s, d: Q.q1_disbursement(disb(s, d))
    r["q2_collections"] = lambda s, d: Q.q2_collections(coll(s, d))
    r["q2_collections_calendar"] = lambda s, d: Q.q2_collections_calendar(coll(s, d))
    r["q3_cohort_health"] = lambda s, d: Q.q3_cohort_health(V.cohort_portfolio(_m(s, d).mart))
    r["q4_top_delinquent"] = lambda s, d: Q.q4_top_delinquent(_m(s, d).mart)
    r["q5_bi_ordered"] = lambda s, d: Q.q5_bi_ordered(V.bi_dataset(_m(s, d).mart))
    r["q5_exec_summary"] = lambda s, d: Q.q5_exec_summary(V.bi_dataset(_m(s, d).mart))
    r["portfolio_kpis"] = lambda s, d: Q.portfolio_kpis(_m(s, d).mart)

    # data-quality suite over the raw tables
    def raw4(s, d):
        raw = _m(s, d).raw
        return raw.customers, raw.loans, raw.installments, raw.payments

    r["quality_customers"] = lambda s, d: quality.quality_customers(raw4(s, d)[0])
    r["quality_loans"] = lambda s, d: quality.quality_loans(raw4(s, d)[1], raw4(s, d)[0])

    def q_inst(s, d):
        c, lo, i, p = raw4(s, d)
        return quality.quality_installments(i, lo)

    def q_pay(s, d):
        c, lo, i, p = raw4(s, d)
        return quality.quality_payments(p, lo, i)

    def q_cross(s, d):
        c, lo, i, p = raw4(s, d)
        return quality.quality_cross(lo, p, i)

    def q_report(s, d):
        return quality.quality_report(*raw4(s, d))

    def fk(s, d):
        c, lo, i, p = raw4(s, d)
        return quality.fk_violations(lo, c, i, p)

    r["quality_installments"] = q_inst
    r["quality_payments"] = q_pay
    r["quality_cross"] = q_cross
    r["quality_report"] = q_report
    r["fk_violations"] = fk

    def checks_by_window(s, d):
        # the stored state has the payments up to the mark; a run adds the window past it. Row rules and both
        # censuses read the installments, a grouping of the driver's lines: they are landed once
        c, lo, i, p = raw4(s, d)
        i = landed(s, i, "installments")
        past = F.coalesce(p.loaded_at > ntz_lit(INCREMENTAL_MARK), F.lit(False))
        first = check_states.states_of(c, lo, i, p.where(~past))
        window = check_states.states_of(c.limit(0), lo.limit(0), i.limit(0), p.where(past))
        return check_states.report(check_states.merged(first, window))
    r["quality_by_window"] = checks_by_window
    r["loans_without_installments"] = lambda s, d: quality.loans_without_installments(raw4(s, d)[1], raw4(s, d)[2])
    r["overcollected_loans"] = lambda s, d: quality.overcollected_loans(raw4(s, d)[1], raw4(s, d)[3])
    r["closed_with_unpaid"] = lambda s, d: quality.closed_with_unpaid(raw4(s, d)[2], raw4(s, d)[1])

    # incremental load, dedup and upserts
    def inc_new(s, d):
        raw = _m(s, d).raw
        return staging.stage_payments(window_rows(raw.payments, INCREMENTAL_MARK, None), raw.installments)

    def two_batches(s, d):
        raw = _m(s, d).raw
        base_raw = raw.payments.where(raw.payments.loaded_at <= ntz_lit(INCREMENTAL_MARK))
        base = staging.stage_payments(base_raw, raw.installments)
        delta = staging.stage_payments(
            window_rows(raw.payments, INCREMENTAL_MARK - INCREMENTAL_OVERLAP, None), raw.installments)
        return base, delta

    r["incremental_new_payments"] = inc_new
    r["watermark_state"] = lambda s, d: next_mark(_m(s, d).raw.payments)
    r["incremental_upsert"] = lambda s, d: upsert(*two_batches(s, d), ["payment_id"], ["loaded_at"])
    r["incremental_append"] = lambda s, d: append_new(*two_batches(s, d), ["payment_id"])
    def mart_refresh(s, d):
        # mart built before the mark, then refreshed with the payments that arrived after it
        m = _m(s, d)
        before = m.payments.where(m.payments.loaded_at <= ntz_lit(INCREMENTAL_MARK))
        base = mart_plans.portfolio_mart(m.open_loans, m.installment_rollup,
                                         payment_rollup(before, m.installments), m.as_of)
        affected = m.payments.where(m.payments.loaded_at > ntz_lit(INCREMENTAL_MARK)).select("loan_id").distinct()
        pays = m.payments.join(affected, "loan_id", "left_semi")
        return mart_plans.refresh_payments(base, payment_rollup(pays, m.installments), affected)
    r["incremental_mart_refresh"] = mart_refresh
    def merge(s, d):
        # staged up to the mark, then the raw versions past it (and the overlap): equals a full build
        raw = _m(s, d).raw
        first = merge_payments(None, raw.payments.where(raw.payments.loaded_at <= ntz_lit(INCREMENTAL_MARK)),
                               raw.installments)
        later = window_rows(raw.payments, INCREMENTAL_MARK - INCREMENTAL_OVERLAP, None)
        return merge_payments(first, later, raw.installments)
    r["incremental_merge"] = merge
    def loan_upsert(s, d):
        # stored loans meet a delivery: closed versions of every tenth loan and as many new loans
        stored = _m(s, d).loans
        tenth = stored.where("cast(loan_id AS long) % 10 = 0")
        delivery = tenth.withColumn("loan_status", F.lit("CLOSED")).unionByName(
            tenth.withColumn("loan_id", F.concat(F.lit("N-"), "loan_id")))
        return upsert(stored, delivery, ["loan_id"], ["origination_date"])
    r["loan_upsert"] = loan_upsert

    def deliveries(s, d):
        # what a first run sees, and all: some rows of the first weeks are delivered late
        raw = _m(s, d).raw
        late = F.minute("loaded_at") % 11 == 0
        return raw, raw.payments.where((F.col("loaded_at") <= ntz_lit(INCREMENTAL_MARK)) & ~late)

    def late_versions(s, d):
        raw, first = deliveries(s, d)
        days = changed_days(day_totals(raw.payments), day_totals(first))
        fresh = fresh_versions(on_days(raw.payments, days), version_prints(first))
        return fresh.withColumn("late", F.coalesce(F.col("loaded_at") <= ntz_lit(INCREMENTAL_MARK), F.lit(True)))

    def scoped_merge(s, d):
        raw, first = deliveries(s, d)
        p = sinks.Publication(s, f"{ensure_checkpoint_dir(s).rstrip('/')}/scoped-merge-{uuid.uuid4().hex}")
        jobs.write_payment_segments(p, newest(versions(first)), raw.installments)
        fresh = fresh_versions(raw.payments, version_prints(first))
        jobs.merge_segments(p, fresh, raw.installments)
        return p.read("stg_payments").drop("staged_at")

    def mart_by_delta(s, d):
        # states of the payments before the mark and of half of the installments, then the signed changes to all;
        # raw installments and staged payments, read by many states, are landed once
        raw = _m(s, d).raw
        m = LendingModel(SimpleNamespace(customers=raw.customers, loans=raw.loans, payments=raw.payments,
                                         installments=landed(s, raw.installments, "installments")))
        m.payments = landed(s, m.payments, "stg_payments")
        before = m.payments.where(m.payments.loaded_at <= ntz_lit(INCREMENTAL_MARK)).withColumn(
            "payment_amount", (F.col("payment_amount") + 1).cast("decimal(18,2)"))
        half = m.installments.where("cast(loan_id AS long) % 2 = 0 OR days_late > 100").withColumn(
            "days_late", F.col("days_late") + 1)
        inst, pays = delta.signed_changes(half, m.installments), delta.signed_changes(before, m.payments)
        was = lambda df: df.withColumn(delta.SIGN, F.lit(1))
        state = {
            "inst": delta.added(delta.installment_state(was(half), m.as_of), delta.installment_state(inst, m.as_of),
                                delta.INSTALLMENT_KEY),
            "cash": delta.added(delta.cash_state(was(before)), delta.cash_state(pays), delta.CASH_KEY),
            "days": delta.added(delta.day_state(was(before)), delta.day_state(pays), delta.DAY_KEY)}
        return mart_plans.portfolio_mart(m.open_loans, delta.installment_rollup(state["inst"]),
                                         delta.payment_rollup(state["cash"], state["days"], m.installments), m.as_of)

    def job_mart(s, d):
        # the incremental job twice: the first delivery, then all; published tables are read back
        raw, first = deliveries(s, d)
        root = f"{ensure_checkpoint_dir(s).rstrip('/')}/job-mart-{uuid.uuid4().hex}"
        # the job reads raw tables that are stored: installments, a grouping of the driver's lines, are landed
        landed = sinks.Publication(s, f"{root}-raw")
        landed.write(raw.installments.hint("rebalance"), "installments")
        for payments in (first, raw.payments):
            given = SimpleNamespace(spark=s, customers=raw.customers, loans=raw.loans,
                                    installments=landed.read("installments"), payments=payments)
            jobs.run_incremental(s, None, root, raw=given)
        return sinks.read_table(s, root, "portfolio_mart").drop("refreshed_at").select(*mart_plans.MART_COLUMNS)

    def export_readback(s, d):
        out = f"{ensure_checkpoint_dir(s).rstrip('/')}/export-{uuid.uuid4().hex}"
        data = V.bi_dataset(_m(s, d).mart)
        sinks.export_csv(data, out)
        # the null marker is one that does not occur, so that a quoted empty text stays one
        return s.read.option("header", True).option("nullValue", "\\N").schema(data.schema).csv(out)

    def laid_out(s, d):
        # staged tables and the mart of them, published, then the layout job
        root = f"{ensure_checkpoint_dir(s).rstrip('/')}/layout-{uuid.uuid4().hex}"
        m, p = _m(s, d), sinks.Publication(s, root)
        for n in jobs.STAGED:
            p.write(getattr(m, n), f"stg_{n}", audit_col="staged_at")
        p.write(MaterializedModel({n: p.read(f"stg_{n}").drop("staged_at") for n in jobs.STAGED}, m.as_of).mart,
                "portfolio_mart")
        p.commit()
        jobs.run_layout(s, root, m.as_of)
        return root

    r["colocated_mart"] = lambda s, d: colocated.Colocated(s, laid_out(s, d)).mart()
    r["mart_of_cities"] = lambda s, d: colocated.rows_with(
        sinks.Publication(s, laid_out(s, d)), "mart_by_place", "city", CITIES)

    r["late_versions"], r["scoped_merge"], r["mart_by_delta"] = late_versions, scoped_merge, mart_by_delta
    r["incremental_job_mart"], r["export_readback"] = job_mart, export_readback

    def doubles(s, d):
        # staged payments and a gateway's retries: every 20th again, hours later, for the next installment
        pays = _m(s, d).payments
        key = F.col("payment_id").cast("long")
        again = (pays.where(key % 20 == 0).withColumn("loaded_at", F.expr(
            "loaded_at + make_dt_interval(0, cast(cast(payment_id AS long) % 7 * 5 AS int), 0, 0)"))
            .withColumn("installment_id", F.concat("loan_id", F.lit("-9")))
            .withColumn("payment_id", F.concat("payment_id", F.lit("-retry"))))
        return payment_doubles(pays.unionByName(again), DOUBLES_WITHIN)
    r["payment_doubles"] = doubles

    def strict_arrears(s, d):
        m = _m(s, d)
        return (staging.stage_installments(m.raw.installments, m.as_of, strict=True)
                .where("in_arrears").select("installment_id", "loan_id", "due_date", "days_late"))
    r["strict_arrears"] = strict_arrears

    def channels(s, d):
        master = literal_rows(s, CHANNEL_MASTER, "alias string, channel string")
        named = staging.normalize_channels(_m(s, d).payments, master)
        return named.groupBy("payment_channel").agg(
            F.count(F.lit(1)).alias("n_payments"), F.sum("payment_amount").cast("decimal(38,2)").alias("total"))
    r["collections_by_channel"] = channels

    def against_targets(s, d):
        targets = literal_rows(s, CHANNEL_TARGETS, "channel string, since date, daily_target decimal(18,2)")
        days = _m(s, d).payments.groupBy("payment_channel", "payment_date").agg(
            F.sum("payment_amount").cast("decimal(38,2)").alias("collected"))
        met = days.join(targets, (F.col("payment_channel") == F.col("channel")) & (F.col("payment_date") >= F.col("since")))
        return met.select("channel", "payment_date", "collected", "daily_target",
                          (F.col("collected") >= F.col("daily_target")).alias("met"))
    r["collections_vs_target"] = against_targets
    r["staging_mark"] = lambda s, d: next_staging_mark(_m(s, d).payments)
    r["running_total"] = lambda s, d: running_total_large(
        _m(s, d).payments.select("payment_id", "loan_id", "payment_amount", "loaded_at"),
        "payment_amount", "loaded_at", "running_total", ties=["payment_id"]).withColumn(
            "running_total", F.col("running_total").cast("decimal(38,2)"))
    r["dedup_payments"] = lambda s, d: dedup_latest(_m(s, d).payments, ["payment_id"], ["loaded_at"])

    # operational datasets
    r["zero_activity_days"] = lambda s, d: alerts.zero_activity_days(disb(s, d), coll(s, d))

    def counts(s, d):
        m = _m(s, d)
        raw = m.raw
        return alerts.row_counts([
            staging.layer_counts(staging.flag_customers(raw.customers), staging.CUSTOMER_SPEC, "customers"),
            staging.layer_counts(staging.flag_loans(raw.loans), staging.LOAN_SPEC, "loans"),
            staging.layer_counts(staging.flag_installments(raw.installments, m.as_of), staging.INSTALLMENT_SPEC,
                                 "installments"),
            staging.layer_counts(staging.flag_payment_rows(raw.payments), staging.PAYMENT_SPEC, "payments"),
        ], {("analytics", "portfolio_mart"): m.mart})
    r["row_counts"] = counts

    # loan delinquency-state history (SCD type 2) from two mart snapshots
    def history(s, d):
        prev = _m(s, d, HISTORY_PREVIOUS_AS_OF)
        cur = _m(s, d)
        h0 = initial_history(prev.mart, "loan_id", HISTORY_TRACKED, prev.as_of)
        return scd2_apply(h0, cur.mart, "loan_id", HISTORY_TRACKED, cur.as_of)
    r["loan_status_history"] = history

    def series(s, d):
        m = _m(s, d)
        return history_series(m.open_loans, m.installments, HISTORY_SERIES)
    r["loan_history_series"] = series
    return r


QUERIES: dict[str, QueryFn] = _registry()
