import datetime as dt

from loanlake.operators.history import history_series, initial_history, scd2_apply

D1, D2, D3 = dt.date(2030, 1, 1), dt.date(2030, 2, 1), dt.date(2030, 3, 1)


def snap(spark, rows):
    return spark.createDataFrame(rows, "loan_id string, bucket string, late boolean")


def test_scd2_versions(spark):
    h = initial_history(snap(spark, [("A", "ok", False), ("B", "ok", False), ("C", "1-30", True)]),
                        "loan_id", ["bucket", "late"], D1)
    h = scd2_apply(h, snap(spark, [("A", "ok", False), ("B", "1-30", True), ("D", "ok", None)]),
                   "loan_id", ["bucket", "late"], D2)
    h = scd2_apply(h, snap(spark, [("A", "ok", False), ("B", "1-30", True), ("D", "ok", None)]),
                   "loan_id", ["bucket", "late"], D3)  # replay of an unchanged snapshot
    rows = sorted((r["loan_id"], r["bucket"], r["valid_from"], r["valid_to"]) for r in h.collect())
    assert rows == [
        ("A", "ok", D1, None),          # unchanged: one open version
        ("B", "1-30", D2, None),        # changed: new open version
        ("B", "ok", D1, D2),            # ... and the closed old one
        ("C", "1-30", D1, D2),          # gone from the snapshot: closed
        ("D", "ok", D2, None),          # new key (NULL tracked value compares null-safe)
    ]


def test_series_works_out_the_states_once(spark):
    """No filter inferred from the generator: it would repeat the array of states inside its lambda, so that the work
    grew with the cube of the cut-offs."""
    loans = spark.createDataFrame([("A", "ACTIVE"), ("B", "DEFAULT"), ("C", "ACTIVE"), ("C", "ACTIVE")],
                                  "loan_id string, loan_status string")
    units = spark.createDataFrame([("A", "DUE", dt.date(2030, 1, 20)), ("C", "PAID", D1)],
                                  "loan_id string, installment_status string, due_date date")
    series = history_series(loans, units, [D1, D2, D3])
    assert "size(filter(" not in series._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((r["loan_id"], r["in_arrears"], r["valid_from"], r["valid_to"]) for r in series.collect())
    assert [r for r in rows if r[0] != "A"] == [("B", True, D1, None), ("C", False, D1, None), ("C", False, D1, None)]
    a = [r for r in rows if r[0] == "A"]
    assert a[0] == ("A", False, D1, D2) and a[1][1:3] == (True, D2) and a[-1][3] is None
