"""Staged tables laid out by loan, and the mart along a space-filling curve of city and segment (D9).

``colocate`` stores open loans (with their customer's columns), staged installments and staged payments in the same
number of buckets of ``loan_id``, a file for each bucket. The rollups (B6, B7) group by the bucket key and the mart
joins (J3, J4) meet on it, so the plan from the stored tables has no exchange. What needs another key is settled
once, when the layout is written: the customer of a loan and whether a payment's installment is in arrears.

A bucket is read by one task. Loans with more than ``hot_rows`` rows in a table, and rows without a loan, are
therefore stored apart as plain files and take the ordinary plan, which combines them before it shuffles; the mart is the
union of both. Loans apart are at most rows / ``hot_rows``.

``write_along_curve`` cuts a table into segments (``sources/segments.py``) of neighbouring cells of a Z-order curve;
``rows_with`` reads the segments that hold a value. Null is no value: rows without a city are found by reading all.
"""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.functions import expr as X
from loanlake.operators import rollups
from loanlake.operators.existence import salted, with_in_flag
from loanlake.plans import mart as mart_plans
from loanlake.session import DEFAULT_AS_OF
from loanlake.sources import segments, sinks

KEY = "loan_id"
TABLES = ("open_loans", "installments", "payments")
LAYOUT = "colocated_layout"
LAYOUT_SCHEMA = "name string, buckets int, n_apart long, as_of date, row_schema string"
HOT_ROWS = 1_000_000      # rows of one loan in one table
BUCKET_ROWS = 4_000_000   # mean rows of a bucket of the largest table
CURVE_BITS = 6            # positions per column: 2^6, so two columns have 4,096 cells
COUNT_CELLS = 65_536      # hashes of loans by which rows are counted first
CURVE_ROWS = 4_000_000    # rows of a segment


def payments_with_arrears(stg_payments: DataFrame, stg_installments: DataFrame) -> DataFrame:
    """Staged payments and ``to_arrears``: their installment is in arrears and no orphan. Payments without an
    installment take a salt as join key."""
    late = rollups.arrears_installment_ids(stg_installments).select(
        F.concat(F.lit("k"), F.col("installment_id")).alias("installment_id"))
    key = salted(F.col("installment_id"), ["payment_id", "loaded_at"])
    flagged = with_in_flag(stg_payments, key, late, "installment_id", "_late")
    return flagged.select(*stg_payments.columns, (~F.col("orphan_installment") & F.col("_late")).alias("to_arrears"))


def payment_rollup(payments: DataFrame) -> DataFrame:
    """``rollups.payment_rollup`` of payments that know whether they went to arrears: one grouping."""
    return payments.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n_payments"), X.money(F.sum("payment_amount")).alias("collected"),
        F.max("payment_date").alias("last_payment_date"),
        X.money(X.sum_when(F.col("to_arrears"), F.col("payment_amount"))).alias("collected_arrears"))


def _sizes(frames: dict[str, DataFrame], hot_rows: int) -> tuple[int, DataFrame]:
    """Rows of the largest table, and the loans with more than ``hot_rows`` rows in one. Rows are first counted by a
    hash of their loan, which leaves little to shuffle; loans are counted only where a hash has so many rows."""
    cell = F.pmod(F.xxhash64(KEY), F.lit(COUNT_CELLS)).cast("int")
    cells = segments.union(df.groupBy(cell.alias("_cell")).agg(F.count(F.lit(1)).alias("n")).withColumn("t", F.lit(t))
                           for t, df in frames.items()).checkpoint()
    total = cells.groupBy("t").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    full = F.broadcast(cells.where(F.col("n") > hot_rows).select("_cell").distinct())  # at most COUNT_CELLS
    counts = segments.union(
        df.where(F.col(KEY).isNotNull()).select(KEY, cell.alias("_cell")).join(full, "_cell", "left_semi")
        .groupBy(KEY).agg(F.count(F.lit(1)).alias("n")) for df in frames.values())
    return total, counts.where(F.col("n") > hot_rows).select(KEY).distinct().checkpoint()


def colocate(p: sinks.Publication, open_loans: DataFrame, installments: DataFrame, payments: DataFrame,
             as_of: dt.date = DEFAULT_AS_OF, hot_rows: int = HOT_ROWS, bucket_rows: int = BUCKET_ROWS) -> None:
    """Write the layout as versions of ``p``; it counts once ``p`` is committed. ``payments`` are staged ones.
    Empty tables give empty buckets."""
    frames = dict(zip(TABLES, (open_loans, installments, payments_with_arrears(payments, installments).checkpoint())))
    total, hot = _sizes(frames, hot_rows)
    buckets = max(1, -(-total // bucket_rows))
    hot = F.broadcast(hot)  # at most rows / hot_rows: no table is shuffled to set them apart
    about = []
    for t, df in frames.items():
        named = df.where(F.col(KEY).isNotNull())
        p.write_bucketed(named.join(hot, KEY, "left_anti").select(*df.columns), f"by_loan_{t}", KEY, buckets)
        apart = named.join(hot, KEY, "left_semi").select(*df.columns).unionByName(df.where(F.col(KEY).isNull()))
        p.write(apart, f"apart_{t}")
        about.append((t, buckets, p.read(f"apart_{t}").count(), as_of, df.schema.json()))
    p.write(p.spark.createDataFrame(about, LAYOUT_SCHEMA).coalesce(1), LAYOUT)


class Colocated:
    """The current layout below a root: rollups and mart over it."""

    def __init__(self, spark: SparkSession, root: str):
        p = sinks.Publication(spark, root)
        about = {r["name"]: r for r in p.read(LAYOUT).collect()}  # a row per table
        self.as_of = about["open_loans"]["as_of"]
        self.buckets = about["open_loans"]["buckets"]
        schemas = {t: T.StructType.fromJson(json.loads(about[t]["row_schema"])) for t in TABLES}
        self.by_loan = {t: p.read_bucketed(f"by_loan_{t}", schemas[t], KEY, self.buckets) for t in TABLES}
        # nothing apart: the mart is the bucketed plan alone
        self.apart = ({t: spark.read.schema(schemas[t]).parquet(p.path(f"apart_{t}")) for t in TABLES}
                      if any(r["n_apart"] for r in about.values()) else None)

    def _sides(self, plan) -> DataFrame:
        return segments.union(plan(side) for side in (self.by_loan, self.apart) if side is not None)

    def installment_rollup(self) -> DataFrame:
        return self._sides(lambda s: rollups.installment_rollup(s["installments"], self.as_of))

    def payment_rollup(self) -> DataFrame:
        return self._sides(lambda s: payment_rollup(s["payments"]))

    def mart(self) -> DataFrame:
        """The portfolio mart. A loan and all its rows are on one side."""
        return self._sides(lambda s: mart_plans.portfolio_mart(
            s["open_loans"], rollups.installment_rollup(s["installments"], self.as_of), payment_rollup(s["payments"]),
            self.as_of))


# ------------------------------------------------------------------------------ space-filling curve

def _text(column: str) -> Column:
    """The column as text, null for none or an empty one."""
    return F.nullif(F.col(column).cast("string"), F.lit(""))


def _number(column: str, skip: int) -> Column:
    """Seven bytes of a text after the first ``skip``, as a number in the order of the texts."""
    head = F.substring(F.encode(_text(column), "UTF-8"), skip + 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long")


def _up_to(value: Column):
    return lambda bound: bound <= value


def curve_cell(df: DataFrame, columns: list[str], bits: int = CURVE_BITS) -> Column:
    """The Z-order cell of a row: its columns' positions among ``2^bits`` quantiles of their values, bit by bit in
    turn. A value counts by the seven bytes after those that all values share (the least and the greatest do). Null and
    empty texts are position 0. Only these two values and the quantiles of each column reach the driver."""
    ends = df.agg(*[f(_text(c)) for c in columns for f in (F.min, F.max)]).first()
    pairs = [[(e or "").encode() for e in ends[2 * j:2 * j + 2]] for j in range(len(columns))]
    numbers = [_number(c, len(os.path.commonprefix(pair)) if pair[0] != pair[1] else 0) for c, pair in zip(columns, pairs)]
    cuts = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = df.agg(*[F.approx_percentile(n, cuts, 10_000) for n in numbers]).first()
    cell = F.lit(0)
    for j, (column, number, quantiles) in enumerate(zip(columns, numbers, found)):
        bounds = F.array(*[F.lit(b).cast("long") for b in quantiles or []]).cast("array<bigint>")
        position = F.when(_text(column).isNull(), F.lit(0)).otherwise(F.size(F.filter(bounds, _up_to(number))))
        for i in range(bits):
            bit = F.shiftright(position, i).bitwiseAND(F.lit(1))
            cell = cell.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return cell


def write_along_curve(p: sinks.Publication, df: DataFrame, name: str, columns: list[str],
                      segment_rows: int = CURVE_ROWS, bits: int = CURVE_BITS) -> None:
    """Write ``df`` (stored: it is read four times) as segments of neighbouring cells, some ``segment_rows`` rows each,
    indexed by ``columns``. A cell is never split between segments; one with more rows has several files."""
    placed = df.withColumn("_cell", curve_cell(df, columns, bits))
    cells = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).orderBy("_cell").collect()  # 2^(bits * columns)
    named, before = [], 0
    for r in cells:
        named.append((r["_cell"], f"z{before // segment_rows}"))
        before += r["n"]
    names = F.broadcast(p.spark.createDataFrame(named, "_cell int, _name string"))  # a row per cell, at most 4,096
    p.write_segments(placed.join(names, "_cell"), name, F.col("_name"), columns, without=["_cell", "_name"])


def rows_with(p: sinks.Publication, name: str, column: str, values: list[str]) -> DataFrame:
    """Rows whose ``column`` is one of ``values``, from the segments that hold them."""
    asked = p.spark.createDataFrame([(column, v) for v in values], "key string, value string")
    return (p.read_segments(name, p.holding(name, asked)).drop(segments.SEGMENT)
            .where(F.col(column).cast("string").isin(*values)))
