"""Layout by loan and along the curve: plans without exchange, loans apart, fewer files for a city."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL

from loanlake.plans import colocated, jobs
from loanlake.plans.model import LendingModel
from loanlake.sources import sinks

THRESHOLDS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def publish(spark, root, **sizes):
    m = LendingModel.from_driver(spark, SMALL)
    p = sinks.Publication(spark, root)
    for n in jobs.STAGED:
        p.write(getattr(m, n), f"stg_{n}", audit_col="staged_at")
    p.write(m.mart, "portfolio_mart")
    p.commit()
    jobs.run_layout(spark, root, **sizes)
    return sinks.Publication(spark, root)


def same(a, b):
    columns = a.columns
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.select(*columns).collect()))


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    # a loan with more than 12 payments or installments is apart
    return publish(spark, str(tmp_path_factory.mktemp("layout")), hot_rows=12, bucket_rows=500, segment_rows=60)


def test_mart_of_both_sides(spark, layout):
    c = colocated.Colocated(spark, layout.root)
    assert c.buckets > 4 and c.apart["payments"].count() > 0 and c.by_loan["payments"].count() > 0
    hot = c.apart["payments"].select("loan_id").distinct()
    assert c.by_loan["installments"].join(hot, "loan_id", "left_semi").count() == 0
    same(layout.read("portfolio_mart"), c.mart())
    m = LendingModel.from_driver(spark, SMALL)
    same(m.payment_rollup, c.payment_rollup())
    same(m.installment_rollup, c.installment_rollup())


def test_no_exchange_from_the_buckets(spark, tmp_path):
    # a catalog that does not know the files yet (another session) reads the same buckets
    root = str(tmp_path)
    publish(spark, root, bucket_rows=500)
    for t in spark.catalog.listTables():
        if t.name.startswith("loanlake_"):
            spark.sql(f"DROP TABLE {t.name}")
    c = colocated.Colocated(spark, root)
    for name in THRESHOLDS:
        spark.conf.set(name, "-1")
    try:
        # payments without a loan are apart; the bucketed side by itself
        c.apart = None
        for df in (c.mart(), c.payment_rollup(), c.installment_rollup()):
            df.collect()
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in text and "AQEShuffleRead" not in text
            assert set(re.findall(r"Bucketed: (\w+)", text)) == {"true"}
        text = c.mart()._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 2 and text.count("FileScan parquet") == 3
    finally:
        for name in THRESHOLDS:
            spark.conf.unset(name)


def test_rows_without_a_loan_and_empty_tables(spark, tmp_path):
    m = LendingModel.from_driver(spark, SMALL)
    nobody = m.payments.withColumn("loan_id", F.when(F.col("loan_id").cast("long") % 3 != 0, F.col("loan_id")))
    for i, (loans, inst, pays) in enumerate([(m.open_loans, m.installments, nobody),
                                             (m.open_loans, m.installments.limit(0), m.payments.limit(0)),
                                             (m.open_loans.limit(0), m.installments.limit(0), m.payments.limit(0))]):
        p = sinks.Publication(spark, f"{tmp_path}/{i}")
        colocated.colocate(p, loans, inst, pays, bucket_rows=1000)
        p.commit()
        c = colocated.Colocated(spark, p.root)
        from loanlake.operators import rollups
        from loanlake.plans.mart import portfolio_mart
        want = rollups.payment_rollup(pays, inst)
        same(want, c.payment_rollup())
        same(portfolio_mart(loans, rollups.installment_rollup(inst), want), c.mart())
        assert c.by_loan["payments"].where("loan_id IS NULL").count() == 0


def test_city_filter_reads_few_files(spark, layout):
    mart = layout.read("portfolio_mart")
    entries = layout.entries("mart_by_place")
    assert len(entries) >= 5 and sum(e["n_rows"] for e in entries) == mart.count()
    files = lambda names: sum(f.endswith(".parquet") for e in entries if e["segment"] in names
                              for f in os.listdir(e["path"]))
    every = files({e["segment"] for e in entries})
    for column, value in (("city", "NATION_3"), ("city", "NATION_17"), ("segment", "SME")):
        found = colocated.rows_with(layout, "mart_by_place", column, [value])
        assert found.count() > 0
        same(mart.where(F.col(column) == value), found)
        held = layout.holding("mart_by_place", spark.createDataFrame([(column, value)], "key string, value string"))
        assert files(held) <= every * 0.6
    assert colocated.rows_with(layout, "mart_by_place", "city", ["nowhere"]).count() == 0


def test_cells_follow_the_order_of_both_columns(spark):
    rows = [("a shared beginning " + chr(97 + i), chr(97 + j), i, j) for i in range(8) for j in range(8)] + [(None, "a", -1, 0), ("a shared beginning a", "", 0, -1)]
    df = spark.createDataFrame(rows, "x string, y string, i int, j int")
    cell = {(r.i, r.j): r.c for r in df.withColumn("c", colocated.curve_cell(df, ["x", "y"], bits=3)).collect()}
    part = lambda c, k: sum((c >> (2 * b + k) & 1) << b for b in range(3))
    for k in (0, 1):
        by = sorted((ij[k], part(c, k)) for ij, c in cell.items())
        assert [p for _, p in by] == sorted(p for _, p in by)  # monotone in its column
        assert len({p for _, p in by}) >= 6
    assert part(cell[(-1, 0)], 0) == 0 and part(cell[(0, -1)], 1) == 0


def test_loans_apart_cost_no_shuffle(spark, tmp_path, monkeypatch):
    rows = [("A", i) for i in range(9)] + [("B", i) for i in range(4)] + [(None, i) for i in range(9)]
    units = spark.createDataFrame(rows, "loan_id string, n int")
    total, hot = colocated._sizes({"open_loans": units.limit(0), "installments": units, "payments": units.limit(3)}, 5)
    assert total == len(rows) and [r[0] for r in hot.collect()] == ["A"]
    plans, write = [], sinks.Publication.write_bucketed

    def recorded(self, df, *args):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(self, df, *args)
    monkeypatch.setattr(sinks.Publication, "write_bucketed", recorded)
    for name in THRESHOLDS:
        monkeypatch.setenv(name, spark.conf.get(name))
        spark.conf.set(name, "-1")
    try:
        publish(spark, str(tmp_path), hot_rows=12, bucket_rows=500)
    finally:
        for name in THRESHOLDS:
            spark.conf.set(name, os.environ[name])
    assert all(re.search("BroadcastHashJoin.*LeftAnti", p) for p in plans) and len(plans) == 3
