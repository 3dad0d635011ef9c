"""Binding of the driver's TPC-H-like tables to the four raw lending tables.

The lending model reads ``customers``, ``loans``, ``installments`` and ``payments``; the test
driver ships ``customer``/``nation``/``orders``/``lineitem``/``events``. These functions derive
the model tables from them with plain projections (plus one grouping to make the installment key
unique), so every downstream plan's work grows with the driver tables. The same binding is
written as SQL in ``oracle_sql.py``; both must stay in step.

| model | source | rule |
|---|---|---|
Defects are planted by key, so that every rule has rows to find: blank and repeated ids, missing parents,
bad amounts, rates, terms and statuses, payment ids delivered twice, payments without an installment.
Every eighth loan is "quiet": it belongs to one of five early cohorts and its installments fall due after
the cut-off but for a share of late ones that differs by cohort.

| customers | customer + nation | id, name, nation name as city, market segment mapped to the
  three lending segments (FURNITURE is left unmapped and is rejected by staging), balance as income |
| loans | orders | id, customer, order date, total price, rate by priority, term 6 + key % 19,
  status O/F/P -> ACTIVE/CLOSED/DEFAULT, product by priority |
| installments | lineitem grouped by (order, line) | line 7 plays the outlier number 99; due =
  latest ship date; principal = sum of prices; interest = principal x max tax; status PAID if
  any line is final, else LATE if any line was returned, else DUE if any is open, else PARTIAL |
| payments | events | loan = user, installment = user-(1 + id % 8) (line 8 never exists, so some
  payments are orphans), amount = value, 'view' channel is NULL, error/signup are
  REVERSED/PENDING |
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.sources import schemas, sinks
from loanlake.sources.tables import DriverTables


NO_PARENT = "999999999"
QUIET_LATE_PCT = (0, 3, 10, 20, 50)  # late installments of the five quiet cohorts


def _s(c):
    return F.col(c).cast("string")


def is_quiet(order_key):
    return order_key % 8 == 0


def quiet_cohort(order_key):
    return F.floor(order_key / 8) % 5


def customers(t: DriverTables) -> DataFrame:
    c = t.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.table("nation").select("n_nationkey", "n_name")
    seg = F.col("c_mktsegment")
    segment = (F.when(seg == "AUTOMOBILE", F.lit("Premium"))
               .when(seg.isin("BUILDING", "HOUSEHOLD"), F.lit("Mass Market"))
               .when(seg == "MACHINERY", F.lit("SME"))
               .otherwise(seg))
    # nation is a 25-row dimension; Spark broadcasts it on its own size estimate.
    key = F.col("c_custkey")
    repeated = key % 149 == 30  # takes its neighbour's id
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.when(key % 151 == 20, F.lit(" ")).when(repeated, (key - 1).cast("string"))
        .otherwise(key.cast("string")).alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.when(key % 61 == 9, F.lit("")).otherwise(F.col("n_name")).alias("city"),
        segment.alias("segment"),
        F.when(repeated, F.lit(0)).otherwise(F.col("c_acctbal").cast("decimal(18,2)"))
        .cast("decimal(18,2)").alias("monthly_income"),
        F.lit(None).cast("date").alias("created_at"),
    )
    return schemas.conform(df, schemas.CUSTOMERS)


def loans(t: DriverTables) -> DataFrame:
    o = t.table("orders")
    prio = F.col("o_orderpriority")
    rate = (F.when(prio == "1-URGENT", F.lit(0.32)).when(prio == "2-HIGH", F.lit(0.28))
            .when(prio == "3-MEDIUM", F.lit(0.24)).when(prio == "4-NOT SPECIFIED", F.lit(0.20))
            .otherwise(F.lit(0.18)))
    product = (F.when(prio.isin("1-URGENT", "2-HIGH"), F.lit("Payroll"))
               .when(prio.isin("3-MEDIUM", "4-NOT SPECIFIED"), F.lit("Digital"))
               .otherwise(F.lit("SME")))
    st = F.col("o_orderstatus")
    status = (F.when(st == "O", F.lit("ACTIVE")).when(st == "F", F.lit("CLOSED"))
              .when(st == "P", F.lit("DEFAULT")).otherwise(st))
    key = F.col("o_orderkey")
    repeated = key % 499 == 3  # takes its neighbour's id, with no amount
    early = F.date_add(F.lit("1991-01-15").cast("date"), (31 * quiet_cohort(key)).cast("int"))
    df = o.select(
        F.when(key % 997 == 5, F.lit(" ")).when(repeated, (key + 1).cast("string"))
        .otherwise(key.cast("string")).alias("loan_id"),
        F.when(key % 523 == 17, F.lit(NO_PARENT)).when(key % 541 == 19, F.lit(" "))
        .otherwise(_s("o_custkey")).alias("customer_id"),
        F.when(is_quiet(key), early).otherwise(F.col("o_orderdate").cast("date")).alias("origination_date"),
        F.when(repeated, F.lit(0)).when(key % 577 == 23, F.lit(10))
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("principal_amount"),
        F.when(key % 503 == 7, F.lit(1.5)).otherwise(rate).cast("decimal(6,4)").alias("annual_rate"),
        F.when(key % 521 == 13, F.lit(0)).otherwise(F.lit(6) + key % 19).cast("int").alias("term_months"),
        F.when(key % 509 == 11, F.lit("UNKNOWN")).otherwise(status).alias("loan_status"),
        product.alias("product_type"),
    )
    return schemas.conform(df, schemas.LOANS)


def installments(t: DriverTables) -> DataFrame:
    li = t.table("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_tax",
                                    "l_returnflag", "l_linestatus", "l_shipdate")
    # (order, line) repeats in the driver data, so group it into one installment per key.
    # Partial aggregation runs map-side before the shuffle.
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.max(F.col("l_shipdate").cast("date")).alias("due_date"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("principal_sum"),
        F.max("l_tax").alias("max_tax"),
        # boolean aggregates keep the buffer fixed-width, so Spark plans a HashAggregate
        # (a max() over strings would fall back to a sort-based aggregate)
        F.bool_or(F.col("l_linestatus") == "F").alias("any_final"),
        F.bool_or(F.col("l_returnflag") == "R").alias("any_returned"),
        F.bool_or(F.col("l_returnflag") == "N").alias("any_open"),
    )
    status = (F.when(F.col("any_final"), F.lit("PAID"))
              .when(F.col("any_returned"), F.lit("LATE"))
              .when(F.col("any_open"), F.lit("DUE"))
              .otherwise(F.lit("PARTIAL")))
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    unit = 10 * key + line
    late_pct = F.element_at(F.array(*[F.lit(p) for p in QUIET_LATE_PCT]), (quiet_cohort(key) + 1).cast("int"))
    quiet_status = F.when((7 * key + 13 * line) % 100 < late_pct, F.lit("LATE")).otherwise(F.lit("DUE"))
    quiet_due = F.date_add(F.lit("1998-12-01").cast("date"), (30 * line).cast("int"))
    principal = F.col("principal_sum").cast("decimal(18,2)")
    interest = F.round(principal * F.col("max_tax").cast("decimal(4,2)"), 2).cast("decimal(18,2)")
    df = g.select(
        F.when(unit % 997 == 5, F.lit(" "))
        .when(unit % 977 == 13, F.concat(F.lit("dup-"), (key % 50).cast("string")))
        .otherwise(F.concat(_s("l_orderkey"), F.lit("-"), _s("l_linenumber"))).alias("installment_id"),
        _s("l_orderkey").alias("loan_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(99)).otherwise(F.col("l_linenumber")).alias("installment_number"),
        F.when(is_quiet(key), quiet_due).otherwise(F.col("due_date")).alias("due_date"),
        F.when(unit % 983 == 11, -principal).otherwise(principal).cast("decimal(18,2)").alias("principal_due"),
        interest.alias("interest_due"),
        F.when(unit % 991 == 7, F.lit("WEIRD")).when(is_quiet(key), quiet_status)
        .otherwise(status).alias("installment_status"),
    )
    return schemas.conform(df, schemas.INSTALLMENTS)


def payments(t: DriverTables) -> DataFrame:
    e = t.table("events").select("event_id", "ts", "user_id", "event_type", "value")
    et = F.col("event_type")
    status = (F.when(et == "error", F.lit("REVERSED")).when(et == "signup", F.lit("PENDING"))
              .otherwise(F.lit("CONFIRMED")))
    key = F.col("event_id")
    loan = F.when(key % 2 == 0, F.col("user_id")).otherwise(key % 1400).cast("string")
    amount = F.col("value").cast("decimal(18,2)")
    df = e.select(
        F.when(key % 97 == 5, F.lit(" ")).when(key % 40 == 39, (key - 1).cast("string"))
        .otherwise(key.cast("string")).alias("payment_id"),
        F.when(key % 107 == 11, F.lit(NO_PARENT)).otherwise(loan).alias("loan_id"),
        F.when(key % 109 != 13, F.concat(loan, F.lit("-"), (F.lit(1) + key % 8).cast("string"))).alias("installment_id"),
        F.col("ts").cast("date").alias("payment_date"),
        F.when(key % 101 == 7, -amount).otherwise(amount).cast("decimal(18,2)").alias("payment_amount"),
        F.nullif(et, F.lit("view")).alias("payment_channel"),
        F.when(key % 103 == 9, F.lit("MYSTERY")).otherwise(status).alias("payment_status"),
        F.col("ts").cast("timestamp_ntz").alias("loaded_at"),
    )
    return schemas.conform(df, schemas.PAYMENTS)


BINDERS = {"customers": customers, "loans": loans, "installments": installments, "payments": payments}


class RawTables:
    """The four raw model frames as plans over a driver-table directory. Nothing is copied or kept: each
    use reads the tables as they are then. ``land`` stores the bound tables where a caller wants that."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.driver = DriverTables(spark, sf_dir)

    @cached_property
    def customers(self) -> DataFrame:
        return customers(self.driver)

    @cached_property
    def loans(self) -> DataFrame:
        return loans(self.driver)

    @cached_property
    def installments(self) -> DataFrame:
        return installments(self.driver)

    @cached_property
    def payments(self) -> DataFrame:
        return payments(self.driver)

    def land(self, root: str) -> "StoredRawTables":
        """Write the raw tables once below ``root`` (shared storage) and return them as stored tables, so
        that many queries need not derive them again. REBALANCE gives files of the advisory size. Every table
        is a new version, and one commit switches to all of them: a land that fails leaves the old ones."""
        p = sinks.Publication(self.spark, root)
        for name in BINDERS:
            p.write(getattr(self, name).hint("rebalance"), name)
        p.commit()
        return StoredRawTables(self.spark, root)


class StoredRawTables:
    """Raw tables already stored as Parquet under ``root/<table>`` or as versions that a commit under ``root``
    names (the production case).

    Read with the explicit raw schemas; nothing is copied or re-derived, so at any scale the
    model's plans start from plain pruned, filter-pushed scans of the stored tables.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        path = sinks.current_path(self.spark, self.root, name) or f"{self.root}/{name}"
        return self.spark.read.schema(schemas.RAW[name]).parquet(path)

    @property
    def customers(self) -> DataFrame:
        return self._read("customers")

    @property
    def loans(self) -> DataFrame:
        return self._read("loans")

    @property
    def installments(self) -> DataFrame:
        return self._read("installments")

    @property
    def payments(self) -> DataFrame:
        return self._read("payments")
