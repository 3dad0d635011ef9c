"""Plan checks: no nested-loop or cartesian joins anywhere; top-k runs before numbering; filters
and column pruning reach the parquet scans."""

import pytest

import __spark_entry__ as E
from conftest import SMALL

from loanlake.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_nested_loop_or_cartesian(spark, name):
    text = plan_text(E.queries()[name](spark, SMALL))
    assert "BroadcastNestedLoopJoin" not in text
    assert "CartesianProduct" not in text


def test_top_k_limits_before_numbering(spark):
    text = plan_text(E.queries()["q4_top_delinquent"](spark, SMALL))
    assert "TakeOrderedAndProject" in text


def test_binding_scans_are_pruned(spark):
    from loanlake.sources.binding import RawTables
    raw = RawTables(spark, SMALL)  # the lazy binding over the driver tables
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string" in plan_text(raw.loans)
    text = plan_text(raw.installments)
    assert "l_quantity" not in text and "l_discount" not in text


def test_raw_layer_scans_are_pruned(spark, scratch):
    # only the columns a plan needs leave stored raw files, and filters are pushed into their scans
    from loanlake.operators import quality
    from loanlake.plans import views
    from loanlake.plans.model import LendingModel
    from loanlake.sources.binding import RawTables
    from loanlake.operators import staging
    from loanlake.streaming.incremental import window_rows
    import datetime as dt
    raw = RawTables(spark, SMALL).land(f"{scratch}/raw")
    m = LendingModel(raw)
    text = plan_text(quality.loans_without_installments(raw.loans, raw.installments))
    assert "ReadSchema: struct<loan_id:string,customer_id:string" in text
    text = plan_text(views.collections_daily(m.payments, m.installments))
    assert "payment_channel" not in text  # collections never read the channel column
    text = plan_text(staging.stage_payments(window_rows(raw.payments, dt.datetime(2024, 1, 15), None), raw.installments))
    assert "IsNotNull(loaded_at), GreaterThan(loaded_at," in text


def test_not_in_reads_child_and_parent_once(spark, scratch):
    # NOT IN against stored installments: one scan of the child; the parent's grouping is shuffled once, the join
    # takes it as it is, and the parent's facts reuse it
    from loanlake.operators.existence import not_in_rows, with_not_in_flag
    from loanlake.sources.binding import RawTables
    from pyspark.sql import functions as F
    raw = RawTables(spark, SMALL).land(f"{scratch}/raw")
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    try:
        for out in (with_not_in_flag(raw.payments, F.col("installment_id"), raw.installments, "installment_id", "orphan"),
                    not_in_rows(raw.payments, "installment_id", raw.installments, "installment_id")):
            out.collect()
            final = plan_text(out).split("== Initial Plan ==\n   Project")[0].split("SortMergeJoin", 1)
            main = final[1].split("== Initial Plan ==")[0]
            assert main.count("FileScan parquet") == 2 and main.count("Exchange hashpartitioning(") == 2
            assert "ReusedExchange" in final[0] and "ReusedSubquery" in plan_text(out)
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(name)


@pytest.mark.parametrize("name,scans", [("stage_payments", 2), ("payment_rollup", 2), ("collections_daily", 2), ("portfolio_mart", 6),
                                        ("quality_report", 20)])
def test_final_plans_scan_little(spark, name, scans):
    """Distinct scans that a query runs: subqueries and repeated groupings reuse what is there."""
    df = QUERIES[name](spark, SMALL)
    df.collect()
    assert 0 < len(scanned(df._jdf.queryExecution().executedPlan())) <= scans


def scanned(plan):
    """Physical file scans below a plan, each once; those behind a reused exchange are the exchange's own."""
    found, todo = set(), [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name.startswith("FileSourceScan"):
            found.add(node.id())
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "ReusedExchangeExec":
            pass
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
            todo += [node.subqueries().apply(i) for i in range(node.subqueries().size())]
    return found


@pytest.mark.parametrize("name,tables", [("quality_by_window", ["lineitem"]), ("mart_by_delta", ["lineitem", "events"])])
def test_tables_of_many_uses_are_landed_once(spark, name, tables):
    # the query's own plan reads stored installments (and staged payments): nothing groups the lines again
    text = plan_text(QUERIES[name](spark, SMALL))
    assert "landed-" in text
    assert not any(f"{t}.parquet" in text for t in tables)


def test_not_in_join_is_not_merged_into_few_tasks(spark):
    # small partitions of the join stay apart: merged by compressed bytes, a task would grow with the input
    from loanlake.operators.existence import not_in_rows, with_not_in_flag
    from pyspark.sql import functions as F
    child = spark.range(400).select(F.col("id").cast("string").alias("c"), F.col("id").alias("v"))
    parent = spark.range(0, 400, 2).select(F.col("id").cast("string").alias("p"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        flagged = with_not_in_flag(child, F.col("c"), parent, "p", "out").withColumn("task", F.spark_partition_id()).collect()
        rows = not_in_rows(child, "c", parent, "p").withColumn("task", F.spark_partition_id()).collect()
    finally:
        for name in names:
            spark.conf.unset(name)
    assert {r["v"] for r in flagged if r["out"]} == {r["v"] for r in rows} == set(range(1, 400, 2))
    for found in (flagged, rows):
        assert len({r["task"] for r in found}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
