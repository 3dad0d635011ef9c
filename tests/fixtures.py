"""Hand-written raw rows covering the row classes of FIXTURES.md (own data, not seed rows)."""

import datetime as dt
from decimal import Decimal as D

from loanlake.sources import schemas

AS_OF = dt.date(2030, 6, 30)


def d(days: int) -> dt.date:
    """A date ``days`` after the cut-off (negative = before)."""
    return AS_OF + dt.timedelta(days=days)


def ts(h: int) -> dt.datetime:
    return dt.datetime(2030, 6, 1, 0, 0) + dt.timedelta(hours=h)


CUSTOMERS = [
    ("K1", " Ana Ruiz ", " Lima ", "Premium", D("900.00"), d(-400)),
    ("K2", "Bo Chen", "Quito", "Mass Market", D("450.50"), d(-300)),
    ("K3", "Cy Diaz", None, "SME", D("1200.00"), d(-200)),
    ("K4", "Di Egan", "Lima", None, D("300.00"), d(-100)),        # NULL segment passes
    ("K5", "Ed Fox", "Quito", "Gold", D("700.00"), d(-100)),      # unknown segment -> rejected
    ("K6", "Fa Gil", "Lima", "SME", D("0.00"), d(-100)),           # zero income -> rejected
    ("  ", "Ga Hu", "Lima", "SME", D("10.00"), d(-100)),           # blank id -> rejected
]

LOANS = [
    ("L1", "K1", d(-200), D("12000.00"), D("0.2400"), 12, "active", "Payroll"),
    ("L2", "K2", d(-200), D("5000.00"), D("0.3000"), 6, " DEFAULT ", "Digital"),
    ("L3", "K3", d(-150), D("8000.00"), D("0.1800"), 24, "CLOSED", "SME"),
    ("L4", "K5", d(-150), D("3000.00"), D("0.2000"), 12, "ACTIVE", "Digital"),   # rejected customer
    ("L5", "K4", d(-90), D("2500.00"), D("0.2200"), 10, "ACTIVE", "SME"),        # no installments
    ("L6", "K1", d(-60), D("0.00"), D("0.2400"), 12, "ACTIVE", "Payroll"),       # zero amount -> rejected
    ("L7", "K2", d(-60), D("1000.00"), D("1.5000"), 12, "ACTIVE", "Payroll"),    # rate > 1 -> rejected
    ("L8", "KX", d(-30), D("1000.00"), D("0.2000"), 0, "ACTIVE", "Payroll"),     # term 0 -> rejected
    ("L9", "K2", d(-30), D("1000.00"), D("0.2000"), 12, "FROZEN", "Payroll"),    # unknown status
]

INSTALLMENTS = [
    ("I1", "L1", 1, d(-91), D("1000.00"), D("240.00"), "LATE"),
    ("I2", "L1", 2, d(-90), D("1000.00"), D("220.00"), "PAID"),
    ("I3", "L1", 3, d(-61), D("1000.00"), D("200.00"), "due"),
    ("I4", "L1", 4, d(-60), D("1000.00"), D("180.00"), "PARTIAL"),
    ("I5", "L1", 5, d(1), D("1000.00"), D("160.00"), "LATE"),      # LATE, future due date
    ("I6", "L1", 6, d(0), D("1000.00"), D("140.00"), "DUE"),       # DUE on the cut-off
    ("I7", "L2", 1, d(-31), D("800.00"), None, "DUE"),
    ("I8", "L2", 2, d(-30), D("800.00"), D("50.00"), "DUE"),
    ("I9", "L2", 3, d(-1), D("800.00"), D("50.00"), None),         # NULL status passes
    ("I10", "L2", 99, d(-5), D("10.00"), D("1.00"), "DUE"),        # outlier number -> rejected
    ("I11", "L3", 1, d(-10), D("500.00"), D("20.00"), "DUE"),      # CLOSED loan, unpaid
    ("I12", "L4", 1, d(10), D("300.00"), D("30.00"), "DUE"),
    ("I13", "LZ", 1, d(10), D("300.00"), D("30.00"), "BOGUS"),     # unknown status -> rejected
]

PAYMENTS = [
    ("P1", "L1", "I1", d(-80), D("500.00"), "PSE", "CONFIRMED", ts(1)),
    ("P2", "L1", "I2", d(-80), D("1220.00"), "ACH", "confirmed", ts(1)),
    ("P3", "L1", "I404", d(-70), D("100.00"), "CASH", "CONFIRMED", ts(2)),     # orphan
    ("P4", "L1", "I4", d(-70), D("100.00"), None, "CONFIRMED", ts(2)),         # NULL channel
    ("P5", "L2", "I7", d(-20), D("200.00"), "ACH", "REVERSED", ts(3)),         # rejected
    ("P6", "L2", "I8", d(-20), D("200.00"), "ACH", "PENDING", ts(3)),          # rejected
    ("P7", "L2", "I8", d(-20), D("0.00"), "ACH", "CONFIRMED", ts(4)),          # zero -> rejected
    ("P8", "L2", "I10", d(-10), D("11.00"), "BRANCH", "CONFIRMED", ts(5)),     # to outlier #99
    ("P9", "L2", "I3", d(-10), D("50.00"), "", None, ts(5)),                   # other loan's inst., NULL status
    ("P10", "L3", None, d(-10), D("40.00"), "PSE", "CONFIRMED", ts(6)),        # NULL installment
]


def frames(spark):
    return {
        "customers": spark.createDataFrame(CUSTOMERS, schemas.CUSTOMERS),
        "loans": spark.createDataFrame(LOANS, schemas.LOANS),
        "installments": spark.createDataFrame(INSTALLMENTS, schemas.INSTALLMENTS),
        "payments": spark.createDataFrame(PAYMENTS, schemas.PAYMENTS),
    }


class FixtureRaw:
    """Duck-typed stand-in for ``RawTables`` over the fixture rows."""

    def __init__(self, spark, overrides=None):
        self.spark = spark
        f = frames(spark)
        f.update(overrides or {})
        self.customers, self.loans = f["customers"], f["loans"]
        self.installments, self.payments = f["installments"], f["payments"]
