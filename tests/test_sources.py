from fixtures import AS_OF, FixtureRaw
from loanlake.plans.model import LendingModel
from loanlake.plans.sql_views import register_views
from loanlake.sources import sinks
from loanlake.sources.files import read_landing


def test_csv_and_json_landing_roundtrip(spark, scratch):
    raw = FixtureRaw(spark)
    raw.payments.write.option("header", True).option("nullValue", "\\N").csv(f"{scratch}/csv")
    raw.payments.write.json(f"{scratch}/json")
    for fmt, opts in (("csv", {"nullValue": "\\N"}), ("json", None)):
        back = read_landing(spark, f"{scratch}/{fmt}", "payments", fmt, options=opts)
        assert back.schema == raw.payments.schema
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.payments.collect()))


def test_versioned_write_switches_pointer(spark, scratch):
    raw = FixtureRaw(spark)
    p1 = sinks.write_table(raw.loans, scratch, "t")
    p2 = sinks.write_table(raw.loans.limit(2), scratch, "t", audit_col="staged_at")
    assert p1 != p2 and sinks.current_path(spark, scratch, "t") == p2
    back = sinks.read_table(spark, scratch, "t")
    assert back.count() == 2 and "staged_at" in back.columns
    assert spark.read.parquet(p1).count() == raw.loans.count()  # old version intact


def test_sql_views(spark):
    m = LendingModel(FixtureRaw(spark), AS_OF)
    names = register_views(spark, m, prefix="fx_")
    assert "fx_portfolio_mart" in names
    n = spark.sql("SELECT COUNT(*) AS n FROM fx_portfolio_mart WHERE in_arrears").first()["n"]
    assert n == 2


def test_load_stamp_is_one_instant(spark):
    from loanlake.sources.files import stamp_load_time
    raw = FixtureRaw(spark)
    stamped = stamp_load_time(raw.payments.drop("loaded_at"))
    assert stamped.select("loaded_at").distinct().count() == 1
    assert dict(stamped.dtypes)["loaded_at"] == "timestamp_ntz"


def test_model_over_stored_raw_tables(spark, scratch):
    raw = FixtureRaw(spark)
    for name in ("customers", "loans", "installments", "payments"):
        getattr(raw, name).write.parquet(f"{scratch}/raw/{name}")
    stored = LendingModel.from_tables(spark, f"{scratch}/raw", AS_OF)
    direct = LendingModel(raw, AS_OF)
    cols = sorted(direct.mart.columns)
    assert sorted(map(tuple, stored.mart.select(cols).collect())) == sorted(map(tuple, direct.mart.select(cols).collect()))


def test_malformed_rows_are_kept_apart(spark, scratch):
    from loanlake.sources.files import read_landing_checked
    import os
    os.makedirs(f"{scratch}/in")
    head = "payment_id,loan_id,installment_id,payment_date,payment_amount,payment_channel,payment_status,loaded_at"
    with open(f"{scratch}/in/a.csv", "w") as f:
        f.write(head + "\nP1,L1,I1,2024-01-02,10.50,app,CONFIRMED,2024-01-02 00:00:00\n"
                "P2,L1,I1,not a date,ten,app,CONFIRMED,2024-01-02 00:00:00\n")
    good, bad = read_landing_checked(spark, f"{scratch}/in", "payments")
    assert [r.payment_id for r in good.collect()] == ["P1"]
    rows = bad.collect()
    assert len(rows) == 1 and rows[0].raw_text.startswith("P2,") and rows[0].source_file.endswith("a.csv")


def test_literal_rows_are_cast_or_refused(spark):
    import datetime as dt
    from decimal import Decimal as D

    import pytest

    from loanlake.sources.literals import literal_rows
    schema = "id string, day date, amount decimal(18,2), n int, at timestamp_ntz, ok boolean"
    rows = [("a", "2030-01-31", 5, "7", "2030-01-01 10:00:00", True), (None,) * 6, ("b", dt.date(2030, 2, 1), "5.25", 3, dt.datetime(2030, 1, 2, 3), "false")]
    got = literal_rows(spark, rows, schema)
    assert got.dtypes == [tuple(x.split(" ")) for x in schema.split(", ")]
    assert [tuple(r) for r in got.collect()] == [
        ("a", dt.date(2030, 1, 31), D("5.00"), 7, dt.datetime(2030, 1, 1, 10), True), (None,) * 6,
        ("b", dt.date(2030, 2, 1), D("5.25"), 3, dt.datetime(2030, 1, 2, 3), False)]
    assert literal_rows(spark, [], schema).collect() == []
    for bad in (("a", "31/01/2030", 1, 1, None, None), ("a", None, "x", 1, None, None), ("a", None, 1, 1.5, None, "maybe")):
        with pytest.raises(Exception):
            literal_rows(spark, [bad], schema).collect()
    with pytest.raises(ValueError):
        literal_rows(spark, [("a",)], schema)
    with pytest.raises(TypeError):
        literal_rows(spark, [("a", [1], 1, 1, None, None)], schema)


def test_a_failed_land_leaves_the_raw_tables(spark, scratch, monkeypatch):
    import pytest

    from conftest import SMALL
    from loanlake.sources import sinks
    from loanlake.sources.binding import RawTables
    first = RawTables(spark, SMALL).land(scratch)
    before = {n: getattr(first, n).count() for n in ("customers", "loans", "installments", "payments")}
    write = sinks.Publication.write

    def failing(self, df, name, *a, **k):
        if name == "payments":
            raise RuntimeError("lost")
        return write(self, df.limit(1), name, *a, **k)

    monkeypatch.setattr(sinks.Publication, "write", failing)
    with pytest.raises(RuntimeError):
        RawTables(spark, SMALL).land(scratch)
    assert {n: getattr(first, n).count() for n in before} == before and before["loans"] > 1
