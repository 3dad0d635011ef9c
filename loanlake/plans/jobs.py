"""Job modes: full build, checks only, incremental payments, BI export.

A job writes every stage output as a new table version, reads it back before the next layer (a lost
executor recomputes from the last written layer) and publishes all of them with the incremental mark
in one commit at the end. A job that fails before that leaves the previous state current, and running
it again does the whole work. Only bounded results reach the driver: the 30-row quality report,
one-row KPIs and one-row marks.
"""

from __future__ import annotations

import datetime as dt
import logging
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.operators import delta, quality, staging
from loanlake.plans import colocated
from loanlake.plans import mart as mart_plans
from loanlake.plans import questions as Q
from loanlake.plans import views as V
from loanlake.plans.model import LendingModel, MaterializedModel
from loanlake.functions.expr import ntz_lit
from loanlake.session import DEFAULT_AS_OF, ensure_checkpoint_dir
from loanlake.sources import schemas, segments, sinks
from loanlake.sources.binding import RawTables, StoredRawTables
from loanlake.streaming.incremental import (DAY, DEFAULT_MARK, MARK, VERSION_COLUMNS, changed_days, day_totals,
                                            fresh_versions, load_month, newest, on_days, version_prints, versions,
                                            with_orphans)

log = logging.getLogger("loanlake.jobs")

STAGED = ("customers", "loans", "installments", "payments")
PAYMENT_KEYS = ["payment_id", "installment_id"]  # indexed per segment
BUCKET_LOANS = 250_000  # loans of a state bucket


class ChecksFailed(RuntimeError):
    """A quality check named in ``fail_on`` did not pass."""


def run_checks(raw: RawTables, out_root: str | None = None, fail_on: set[str] | None = None,
               publication: sinks.Publication | None = None) -> list:
    """Evaluate the 30 checks; optionally persist the report and its Markdown evidence. ``fail_on`` names
    checks that stop the job when they do not pass (the evidence is written first)."""
    rows = quality.evaluate_report(raw.customers, raw.loans, raw.installments, raw.payments)
    if out_root:
        spark = raw.spark
        p = publication or sinks.Publication(spark, out_root)
        p.write(spark.createDataFrame(rows, quality.REPORT_SCHEMA), "quality_report", audit_col="checked_at")
        sinks.write_text(spark, sinks.quality_markdown(rows), f"{out_root}/quality_evidence")
        if publication is None:
            p.commit()
    failed = [r for r in rows if not r["passed"]]
    log.info("quality: %d/%d passed", len(rows) - len(failed), len(rows))
    stop = sorted(r["check_name"] for r in failed if r["check_name"] in (fail_on or ()))
    if stop:
        raise ChecksFailed(", ".join(stop))
    return rows


def _dimensions(raw: RawTables, as_of: dt.date) -> dict[str, tuple[DataFrame, DataFrame]]:
    m = LendingModel(raw, as_of)
    return {"customers": (m.customers, staging.rejected_customers(raw.customers)),
            "loans": (m.loans, staging.rejected_loans(raw.loans)),
            "installments": (m.installments, staging.rejected_installments(raw.installments, as_of))}


def build_dimensions(raw: RawTables, p: sinks.Publication, as_of: dt.date,
                     names: tuple[str, ...] = ("customers", "loans", "installments")) -> None:
    """Write the named staged tables and their rejected rows."""
    for name, (staged, rejected) in _dimensions(raw, as_of).items():
        if name in names:
            schemas.assert_schema(staged, schemas.STAGED[name])  # contract check on the plan, no job
            p.write(staged, f"stg_{name}", audit_col="staged_at")
            p.write(rejected, f"rejected_{name}", audit_col="staged_at")


def _staged(p: sinks.Publication, name: str) -> DataFrame:
    return p.read(f"stg_{name}").drop("staged_at")


def _bucket(n: int) -> Column:
    """Segment of a state row: a hash bucket of its loan."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64("loan_id"), F.lit(n)).cast("string"))


def source_state(raw: RawTables, as_of: dt.date) -> DataFrame:
    """(name, n, fp): rows and an order-free fingerprint of each table that has no load stamp, and the cut-off."""
    out = [raw.spark.createDataFrame([("as_of", as_of.toordinal(), 0)], "name string, n long, fp long")]
    for name in ("customers", "loans", "installments"):
        df = getattr(raw, name)
        fp = F.coalesce(F.bit_xor(F.xxhash64(F.lit(0), *df.columns)), F.lit(0))
        out.append(df.agg(F.count(F.lit(1)).alias("n"), fp.alias("fp")).select(F.lit(name).alias("name"), "n", "fp"))
    return segments.union(out)


def write_payment_segments(p: sinks.Publication, rows: DataFrame, raw_installments: DataFrame,
                    replace: set[str] | None = None) -> set[str]:
    """Newest versions (with ``_clean``) as the segments of ``stg_payments``: load months of clean ones, and
    beside the table those of versions that keep their payment out of it."""
    flagged = with_orphans(rows, raw_installments).select(*staging.PAYMENT_SPEC.columns, "_clean")
    segment = load_month(F.when(F.col("_clean"), F.lit("s")).otherwise(F.lit("-")))
    schemas.assert_schema(flagged.drop("_clean"), schemas.STAGED["payments"])
    return p.write_segments(flagged, "stg_payments", segment, PAYMENT_KEYS, "staged_at", replace, without=["_clean"])


def _write_rejected(p: sinks.Publication, rows: DataFrame, replace: set[str] | None = None) -> None:
    p.write_segments(rows, "rejected_payments", load_month(F.lit("s")), ["installment_id"], "staged_at", replace)


def _write_seen(p: sinks.Publication, rows: DataFrame, replace: set[str] | None = None) -> None:
    month = F.concat(F.lit("s"), F.date_format(DAY, "yyyyMM"))
    p.write_segments(version_prints(rows), "payments_seen", month, replace=replace)


def _write_presence(p: sinks.Publication, raw_installments: DataFrame) -> None:
    """Distinct installment ids, the null one included: what orphan flags rest on."""
    p.write(raw_installments.select("installment_id").distinct(), "installment_ids")


def _states(p: sinks.Publication, as_of: dt.date) -> dict[str, tuple[DataFrame, list[str]]]:
    """The rollup states of whole staged tables."""
    one = F.lit(1)
    pays, inst = (_staged(p, n).withColumn(delta.SIGN, one) for n in ("payments", "installments"))
    return {"state_installments": (delta.installment_state(inst, as_of), delta.INSTALLMENT_KEY),
            "state_cash": (delta.cash_state(pays), delta.CASH_KEY), "state_days": (delta.day_state(pays), delta.DAY_KEY)}


def build_states(p: sinks.Publication, as_of: dt.date) -> None:
    loans = _staged(p, "loans").count()
    n = max(8, -(-loans // BUCKET_LOANS))
    p.write(p.spark.createDataFrame([(n,)], "buckets int"), "state_buckets")
    for name, (state, _) in _states(p, as_of).items():
        p.write_segments(state, name, _bucket(n))


def build_mart(staged: dict[str, DataFrame], p: sinks.Publication, as_of: dt.date) -> DataFrame:
    return write_mart(p, MaterializedModel(staged, as_of).mart)


def write_mart(p: sinks.Publication, mart: DataFrame, history: bool = True) -> DataFrame:
    """Publish the mart and, with ``history``, its state at this cut-off beside those of others."""
    schemas.assert_schema(mart, schemas.MART)
    # D9: laid out by origination cohort, clustered by city and segment inside each file. REBALANCE
    # brings a month's rows together, splits months larger than the advisory size and merges small
    # ones, so the number of files follows months and size, not tasks x months.
    clustered = (mart.hint("rebalance", "cohort_month")
                 .sortWithinPartitions("cohort_month", "city", "segment"))
    p.write(clustered, "portfolio_mart", audit_col="refreshed_at", partition_by=["cohort_month"])
    if history:
        # the marts of other cut-offs stay the files they are; this one's takes the place of its last state
        day = F.concat(F.lit("s"), F.date_format("as_of", "yyyyMMdd"))
        kept = {r[0] for r in mart.select(day).distinct().collect()}  # one cut-off
        p.write_segments(p.read("portfolio_mart").select(*mart_plans.MART_COLUMNS), "mart_history", day, replace=kept)
    return p.read("portfolio_mart").drop("refreshed_at")


def run_layout(spark: SparkSession, out_root: str, as_of: dt.date = DEFAULT_AS_OF, **sizes: int) -> dict:
    """Lay out the published staged tables by loan and the published mart along a curve of city and segment, under one
    commit (``plans/colocated.py``, which names the ``sizes``). The layout is that of this run: later runs of the other
    jobs do not change it."""
    p = sinks.Publication(spark, out_root)
    m = MaterializedModel({n: _staged(p, n) for n in STAGED}, as_of)
    colocated.colocate(p, m.open_loans, m.installments, m.payments, as_of,
                       **{k: v for k, v in sizes.items() if k in ("hot_rows", "bucket_rows")})
    mart = p.read("portfolio_mart").select(*mart_plans.MART_COLUMNS)
    colocated.write_along_curve(p, mart, "mart_by_place", ["city", "segment"],
                                **{k: v for k, v in sizes.items() if k == "segment_rows"})
    p.commit()
    return {"segments": len(p.entries("mart_by_place"))}


def kpis(mart: DataFrame) -> dict:
    return Q.portfolio_kpis(mart).first().asDict()


def _build_all(raw: RawTables, p: sinks.Publication, as_of: dt.date) -> DataFrame:
    """Every published table from the raw ones."""
    build_dimensions(raw, p, as_of)
    write_payment_segments(p, newest(versions(raw.payments)), raw.installments)
    _write_rejected(p, staging.rejected_payments(raw.payments, raw.installments))
    _write_seen(p, raw.payments)
    p.write(day_totals(raw.payments), "payments_days")
    _write_presence(p, raw.installments)
    p.write(source_state(raw, as_of), "source_state")
    build_states(p, as_of)
    return build_mart({n: _staged(p, n) for n in STAGED}, p, as_of)


def run_full(spark: SparkSession, sf_dir: str, out_root: str, as_of: dt.date = DEFAULT_AS_OF,
             raw=None, fail_on: set[str] | None = None) -> dict:
    """Checks, staging, mart and mark from the raw tables, published together. The newest version of a
    payment id decides, as in the incremental run."""
    t0 = time.time()
    raw = raw or RawTables(spark, sf_dir)
    p = sinks.Publication(spark, out_root)
    checks = run_checks(raw, out_root, fail_on, p)
    hi = raw.payments.agg(F.max("loaded_at")).first()[0]
    mart = _build_all(raw, p, as_of)
    report = kpis(mart)
    p.commit({MARK: hi or DEFAULT_MARK})
    return {"checks_passed": sum(1 for r in checks if r["passed"]), "checks": len(checks),
            "kpis": report, "mark": hi, "seconds": round(time.time() - t0, 2)}


def _presence_changes(p: sinks.Publication, raw_installments: DataFrame) -> tuple[DataFrame, bool]:
    """Installment ids that came or went, and whether the table's being empty or holding a null changed (which
    turns every orphan flag)."""
    was = p.read("installment_ids").withColumn("_was", F.lit(True))
    now = raw_installments.select("installment_id").distinct().withColumn("_now", F.lit(True))
    both = was.join(now, was.installment_id.eqNullSafe(now.installment_id), "full")
    ids = both.where("_was IS NULL OR _now IS NULL").select(
        F.coalesce(was.installment_id, now.installment_id).alias("installment_id")).checkpoint()
    facts = both.agg(*[f for side, key in (("_was", was.installment_id), ("_now", now.installment_id)) for f in (
        F.count_if(F.col(side)) == 0, F.count_if(F.col(side) & key.isNull()) > 0)]).first()
    return ids.where("installment_id IS NOT NULL"), tuple(facts[:2]) != tuple(facts[2:])


def _all_names(p: sinks.Publication, table: str) -> set[str]:
    return {e["segment"] for e in p.entries(table)}


def merge_segments(p: sinks.Publication, fresh: DataFrame, raw_installments: DataFrame,
                   flipped: DataFrame | None = None, every: bool = False) -> tuple[DataFrame, set[str]]:
    """Merge raw versions no run has read into the staged payments and return the signed change of these and the
    segments that were written anew: those that hold a version of the same payment, those the new versions
    belong to, and those with payments whose installment came or went. All others stay the files they are."""
    batch = newest(versions(fresh)).checkpoint()
    month = load_month(F.when(F.col("_clean"), F.lit("s")).otherwise(F.lit("-")))
    if every:
        touched = _all_names(p, "stg_payments")
    else:
        asked = segments.keyed(batch, "payment_id")
        if flipped is not None:
            asked = asked.unionByName(segments.keyed(flipped, "installment_id"))
        touched = p.holding("stg_payments", asked)
    touched |= {r[0] for r in batch.select(month.alias("m")).distinct().collect()}
    old = p.read_segments("stg_payments", touched)
    live = ~F.col(segments.SEGMENT).startswith("-")
    stored = old.select(*VERSION_COLUMNS, live.alias("_clean"))
    before = old.where(live).select(*staging.PAYMENT_SPEC.columns)
    written = write_payment_segments(p, newest(stored.unionByName(batch)), raw_installments, touched)
    after = p.read_segments("stg_payments", {s for s in written if not segments.hidden(s)})
    return delta.signed_changes(before, after.select(*staging.PAYMENT_SPEC.columns)).checkpoint(), touched


def merge_rejected(raw: RawTables, p: sinks.Publication, fresh: DataFrame, flipped: DataFrame, every: bool) -> None:
    """Add the new rejected rows; renew the orphan flags of those whose installment came or went."""
    held = _all_names(p, "rejected_payments") if every else p.holding(
        "rejected_payments", segments.keyed(flipped, "installment_id"))
    columns = [c for c in p.read("rejected_payments").columns if c != "staged_at"]
    again = p.read_segments("rejected_payments", held).select(*[c for c in columns if c != "orphan_installment"])
    rejected = staging.rejected_payments(fresh, raw.installments).unionByName(
        with_orphans(again, raw.installments).select(*columns))
    _write_rejected(p, rejected, held)


def _changed_loans(p: sinks.Publication, old: dict[str, DataFrame], payments: DataFrame | None,
                   installments: DataFrame | None, renewed: set[str]) -> DataFrame:
    """Loans whose mart row may differ: those of changed rows, of payments to changed installments and of
    changed customers."""
    found = [x.select("loan_id") for x in (payments, installments) if x is not None]
    if installments is not None:
        ids = installments.select("installment_id").distinct()
        found.append(p.read_segments("state_cash").join(ids, "installment_id", "left_semi").select("loan_id"))
    if "loans" in renewed:
        found.append(delta.signed_changes(old["loans"], _staged(p, "loans")).select("loan_id"))
    if "customers" in renewed:
        who = delta.signed_changes(old["customers"], _staged(p, "customers")).select("customer_id").distinct()
        found.append(_staged(p, "loans").join(who, "customer_id", "left_semi").select("loan_id"))
    return segments.union(found).where("loan_id IS NOT NULL").distinct().checkpoint()


def refresh_mart(p: sinks.Publication, as_of: dt.date, old: dict[str, DataFrame], payments: DataFrame | None,
                 renewed: set[str]) -> dict:
    """Keep the rollup states and the mart by signed changes: state buckets of changed loans are written anew,
    mart rows of other loans pass through."""
    installments = delta.signed_changes(old["installments"], _staged(p, "installments")).checkpoint() \
        if "installments" in renewed else None
    loans = _changed_loans(p, old, payments, installments, renewed)
    n = p.read("state_buckets").first()[0]
    touched = {r[0] for r in loans.select(_bucket(n).alias("b")).distinct().collect()}  # at most n
    changes = {"state_installments": installments is not None and delta.installment_state(installments, as_of),
               "state_cash": payments is not None and delta.cash_state(payments),
               "state_days": payments is not None and delta.day_state(payments)}
    keys = {"state_installments": delta.INSTALLMENT_KEY, "state_cash": delta.CASH_KEY, "state_days": delta.DAY_KEY}
    state = {}
    for name, change in changes.items():
        held = p.read_segments(name, touched).drop(segments.SEGMENT)
        if change is not False:
            # rows of a null loan have a bucket too, but no mart row
            of = change.select(_bucket(n).alias("b")).distinct()
            also = {r[0] for r in of.collect()} | touched
            p.write_segments(delta.added(p.read_segments(name, also).drop(segments.SEGMENT), change, keys[name]), name,
                             _bucket(n), replace=also)
            held = p.read_segments(name, touched).drop(segments.SEGMENT)
        state[name] = held.join(loans, "loan_id", "left_semi")
    open_loans = mart_plans.open_loans(_staged(p, "loans"), _staged(p, "customers")).join(loans, "loan_id", "left_semi")
    rows = mart_plans.portfolio_mart(
        open_loans, delta.installment_rollup(state["state_installments"]),
        delta.payment_rollup(state["state_cash"], state["state_days"], _staged(p, "installments")), as_of)
    kept = p.read("portfolio_mart").drop("refreshed_at").select(*mart_plans.MART_COLUMNS).join(loans, "loan_id", "left_anti")
    write_mart(p, kept.unionByName(rows))
    return {"mart": "refreshed", "changed_loans": loans.count()}


def run_incremental(spark: SparkSession, sf_dir: str, out_root: str, as_of: dt.date = DEFAULT_AS_OF,
                    raw=None) -> dict:
    """Read the raw payment versions that no run has read, however late they come, merge them into the segments
    they concern, refresh what changed in the other staged tables, keep the mart by signed changes, and publish
    all of it with the new mark in one commit.

    What is new is told by load days: days whose row count or fingerprint differ from the last run's are read, and
    of their rows those whose fingerprint is not stored. Where nothing is new, nothing is written. Another
    cut-off moves every day count, so it rebuilds installments, states and mart, but not the payments.
    """
    raw = raw or RawTables(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    p = sinks.Publication(spark, out_root)
    lo = p.base.marks.get(MARK, DEFAULT_MARK)
    first = p.path("payments_seen") is None
    totals = day_totals(raw.payments).checkpoint()
    days = changed_days(totals, None if first else p.read("payments_days"))
    if first:
        if not days:
            return {"previous_mark": lo, "new_mark": lo, "new_rows": 0, "late_rows": 0, "read_rows": 0, "mart": "unchanged"}
        fresh = raw.payments
    else:
        months = {f"s{d.year:04d}{d.month:02d}" for d in days}
        seen = p.read_segments("payments_seen", months).where(F.col(DAY).isin(days))
        fresh = fresh_versions(on_days(raw.payments, days), seen).checkpoint()
    late = F.col("loaded_at").isNull() | (F.col("loaded_at") <= ntz_lit(lo))
    count = fresh.agg(F.max("loaded_at").alias("hi"), F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late")).first()
    hi = max(lo, count["hi"] or lo)
    result = {"previous_mark": lo, "new_mark": hi, "new_rows": count["n"] - count["late"], "late_rows": count["late"],
              "read_rows": count["n"]}
    if first:
        _build_all(raw, p, as_of)
        p.commit({MARK: hi})
        return result | {"mart": "rebuilt"}

    now = source_state(raw, as_of).checkpoint()
    renewed = {r[0] for r in now.join(p.read("source_state"), ["name", "n", "fp"], "left_anti").select("name").collect()}
    if not count["n"] and not renewed:
        return result | {"mart": "unchanged"}
    old = {n: _staged(p, n) for n in STAGED if n != "payments"}
    flipped, every = (_presence_changes(p, raw.installments) if "installments" in renewed
                      else (p.read("installment_ids").limit(0), False))
    change = None
    if count["n"] or every or not flipped.isEmpty():
        change, touched = merge_segments(p, fresh, raw.installments, flipped, every)
        merge_rejected(raw, p, fresh, flipped, every)
        result["segments"] = len(touched)
        _write_seen(p, fresh, replace=set())
        p.write(totals, "payments_days")
    moved = "as_of" in renewed
    if moved or renewed:
        build_dimensions(raw, p, as_of, tuple(renewed | {"installments"} if moved else renewed))
        p.write(now, "source_state")
        if "installments" in renewed:
            _write_presence(p, raw.installments)
    if moved:
        build_states(p, as_of)
        build_mart({n: _staged(p, n) for n in STAGED}, p, as_of)
        result["mart"] = "rebuilt"
    else:
        result |= refresh_mart(p, as_of, old, change, renewed)
    p.commit({MARK: hi})
    return result


def run_export(spark: SparkSession, out_root: str, csv_path: str, as_of: dt.date = DEFAULT_AS_OF) -> None:
    mart = sinks.read_table(spark, out_root, "portfolio_mart").drop("refreshed_at")
    sinks.export_csv(V.bi_dataset(mart), csv_path)


def main(argv: list[str] | None = None) -> int:
    import argparse

    from loanlake.session import ensure_checkpoint_dir, get_session
    p = argparse.ArgumentParser(prog="loanlake")
    p.add_argument("mode", choices=["full", "validate", "incremental", "layout", "export"])
    p.add_argument("--source", required=True,
                   help="driver parquet tables (--source-kind driver) or raw tables root (tables)")
    p.add_argument("--source-kind", choices=["driver", "tables"], default="driver")
    p.add_argument("--out", required=True, help="output root on shared storage")
    p.add_argument("--as-of", default=DEFAULT_AS_OF.isoformat())
    p.add_argument("--csv", default=None)
    p.add_argument("--fail-on", default="", help="comma-separated checks that stop a full run when they fail")
    p.add_argument("--vacuum", action="store_true", help="drop versions of older commits afterwards")
    a = p.parse_args(argv)
    spark = get_session()
    ensure_checkpoint_dir(spark)
    as_of = dt.date.fromisoformat(a.as_of)
    raw = StoredRawTables(spark, a.source) if a.source_kind == "tables" else RawTables(spark, a.source)
    if a.mode == "full":
        print(run_full(spark, a.source, a.out, as_of, raw=raw,
                       fail_on={x for x in a.fail_on.split(",") if x}))
    elif a.mode == "validate":
        rows = run_checks(raw, a.out)
        print(sum(1 for r in rows if r["passed"]), "of", len(rows), "checks passed")
    elif a.mode == "incremental":
        print(run_incremental(spark, a.source, a.out, as_of, raw=raw))
    elif a.mode == "layout":
        print(run_layout(spark, a.out, as_of))
    else:
        run_export(spark, a.out, a.csv or f"{a.out}/bi_dataset_csv", as_of)
    if a.vacuum:
        sinks.vacuum(spark, a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
