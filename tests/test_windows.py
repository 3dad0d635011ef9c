import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanlake.operators import windows as W


def test_running_total_large_equals_single_task_window(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), ((F.col("id") * 7919) % 101).alias("v"))
    got = {r["k"]: r["rt"] for r in W.running_total_large(df, "v", "k", "rt", n_parts=7).collect()}
    want = {r["k"]: r["rt"] for r in df.select(
        "k", F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)).alias("rt")).collect()}
    assert got == want


def test_moving_avg_days_counts_calendar_gaps(spark):
    base = dt.date(2030, 1, 1)
    rows = [(base + dt.timedelta(days=d), float(v)) for d, v in [(0, 10), (1, 20), (5, 30), (9, 40), (10, 50)]]
    df = spark.createDataFrame(rows, "day date, amount double")
    got = {r["day"]: r["avg7"] for r in df.select(
        "day", W.moving_avg_days("amount", "day", 7).alias("avg7"),
        W.moving_avg_rows("amount", [F.col("day")], 6).alias("avg7rows")).collect()}
    d = lambda n: base + dt.timedelta(days=n)
    assert got[d(5)] == 20.0           # days 0, 1, 5 are inside the last 7 days
    assert got[d(9)] == 35.0           # day 5 and 9 only: days 0 and 1 fell out
    assert got[d(10)] == 40.0          # days 5, 9, 10


def test_top_k_numbered_ties_broken(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "id int, score int")
    top = W.top_k_numbered(df, [F.col("score").desc(), F.col("id").asc()], 4).collect()
    assert [(r["rank"], r["id"]) for r in sorted(top, key=lambda r: r["rank"])] == [(1, 2), (2, 5), (3, 8), (4, 11)]


def test_running_total_large_with_payload_columns(spark):
    n = 3_000_000
    df = spark.range(n).selectExpr("id * 7 % 3000017 AS k", "cast(id % 13 AS decimal(10,2)) AS v",
                                   "concat('p', id) AS payload", "id % 5 AS other")
    assert df.select("k").distinct().count() == n
    got = W.running_total_large(df, "v", "k", "rt")
    one = df.select("k", "v", F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)).alias("want"))
    joined = got.select("k", "payload", "rt").join(one, "k")
    assert joined.count() == n and joined.where("rt <> want").count() == 0
    assert got.columns == ["k", "v", "payload", "other", "rt"]


def test_running_total_large_by_date_and_empty(spark):
    df = spark.sql("SELECT date_add(date'2020-01-01', cast(id AS int)) AS d, id AS v FROM range(50)")
    got = {r.d: r.rt for r in W.running_total_large(df, "v", "d", "rt", n_parts=4).collect()}
    assert [got[k] for k in sorted(got)] == [i * (i + 1) // 2 for i in range(50)]
    assert W.running_total_large(df.limit(0), "v", "d", "rt").collect() == []


def test_running_total_large_keeps_rows_without_order(spark, monkeypatch):
    df = spark.sql("SELECT if(id < 197, id, null) AS k, id AS v FROM range(200)")
    monkeypatch.setattr(W, "PART_ROWS", 2)
    for n_parts in (None, 7):
        rows = W.running_total_large(df, "v", "k", "rt", n_parts=n_parts).collect()
        assert sorted(r.v for r in rows) == list(range(200))
        assert all(r.rt == r.v * (r.v + 1) // 2 for r in rows if r.k is not None)
        last = sorted((r.rt, r.v) for r in rows if r.k is None)
        assert last[-1][0] == 199 * 100 and last[0][0] == 196 * 197 // 2 + last[0][1]


def test_prefix_sums_over_many_bounded_ranges(spark):
    n = 300_000
    df = spark.range(n).selectExpr("if(id % 3 = 0, 5, id * 7 % 100003) AS k", "id", "id % 13 AS v", "'x' AS _sum")
    got = W.prefix_sums(df, ["k", "id"], "v", "rt", range_rows=3)  # some 10^5 ranges; a third of all rows share k
    want = df.select("id", F.sum("v").over(Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, 0)).alias("w"))
    joined = got.join(want, "id")
    assert joined.count() == n and joined.where("rt <> w").count() == 0 and got.columns == [*df.columns, "rt"]


def test_prefix_sums_ties_and_nulls(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, 4), ("a", 2), ("é", 3), ("Z", None)], "k string, v long")
    rows = W.prefix_sums(df, ["k", "v"], "v", "rt").collect()
    assert {(r.k, r.v): r.rt for r in rows} == {("Z", None): None, ("a", 2): 2, ("a", None): 2, ("b", None): 2, ("é", 3): 5, (None, 4): 9}
    assert W.prefix_sums(df.limit(0), ["k"], "v", "rt").collect() == []


def test_running_total_folds_no_bounds(spark):
    df = spark.range(100).selectExpr("id AS k", "id AS v")
    plan = W.running_total_large(df, "v", "k", "rt", range_rows=3)._jdf.queryExecution().toString()
    assert "lambda" not in plan and "Generate" not in plan
