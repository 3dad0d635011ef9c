"""One object that wires raw -> staging -> rollups -> mart lazily for a given source and cut-off.

Each attribute is a DataFrame plan; nothing runs until an action. Frames are memoised per object
so a plan that uses the mart twice shares one logical subtree (and Spark reuses the exchanges).
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from loanlake.operators import rollups, staging
from loanlake.plans import mart as mart_plans
from loanlake.plans import views
from loanlake.sources.binding import RawTables, StoredRawTables
from loanlake.session import DEFAULT_AS_OF


class LendingModel:
    def __init__(self, raw: RawTables, as_of: dt.date = DEFAULT_AS_OF):
        self.raw = raw
        self.as_of = as_of

    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF) -> "LendingModel":
        """Model over the driver tables as they are now; nothing is copied or kept between calls."""
        return cls(RawTables(spark, sf_dir), as_of)

    @classmethod
    def from_tables(cls, spark: SparkSession, root: str, as_of: dt.date = DEFAULT_AS_OF) -> "LendingModel":
        """Model over raw tables stored as Parquet under ``root/<table>`` (production: no binding,
        no ingest copy)."""
        return cls(StoredRawTables(spark, root), as_of)

    # staging ------------------------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        return staging.stage_customers(self.raw.customers)

    @cached_property
    def loans(self) -> DataFrame:
        return staging.stage_loans(self.raw.loans)

    @cached_property
    def installments(self) -> DataFrame:
        return staging.stage_installments(self.raw.installments, self.as_of)

    @cached_property
    def payments(self) -> DataFrame:
        return staging.stage_payments(self.raw.payments, self.raw.installments)

    # rollups and mart ---------------------------------------------------------------------
    @cached_property
    def installment_rollup(self) -> DataFrame:
        return rollups.installment_rollup(self.installments, self.as_of)

    @cached_property
    def installment_lookup(self) -> DataFrame:
        return rollups.installment_lookup(self.raw.installments, self.as_of)

    @cached_property
    def payment_rollup(self) -> DataFrame:
        return rollups.payment_rollup_by_lookup(staging.clean_payment_rows(self.raw.payments), self.installment_lookup)

    @cached_property
    def collections_daily(self) -> DataFrame:
        return views.collections_daily_by_lookup(staging.clean_payment_rows(self.raw.payments), self.installment_lookup)

    @cached_property
    def open_loans(self) -> DataFrame:
        return mart_plans.open_loans(self.loans, self.customers)

    @cached_property
    def mart(self) -> DataFrame:
        return mart_plans.portfolio_mart(self.open_loans, self.installment_rollup, self.payment_rollup,
                                         self.as_of)


class MaterializedModel(LendingModel):
    """A model whose staged tables and mart come from already-written tables (job mode)."""

    def __init__(self, frames: dict[str, DataFrame], as_of: dt.date = DEFAULT_AS_OF):
        super().__init__(raw=None, as_of=as_of)  # type: ignore[arg-type]
        for name, df in frames.items():
            self.__dict__[name] = df
        # staged payments have their orphan flag already
        self.__dict__.setdefault("payment_rollup", rollups.payment_rollup(self.payments, self.installments))
        self.__dict__.setdefault("collections_daily", views.collections_daily(self.payments, self.installments))
