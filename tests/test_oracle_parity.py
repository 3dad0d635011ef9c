"""Every registered query vs. its DuckDB oracle on the smallest driver tables (the driver runs the
same comparison at sf0.01)."""

import os
import sys

import pytest

from conftest import ROOT, SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from loanlake.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(E.oracle_sql()))
    assert missing == []


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SMALL, verbose=False)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "loan_id" in df.columns


def test_entry_works_without_the_optional_parts(monkeypatch):
    import builtins
    real = builtins.__import__

    def without(name, *args, **kw):
        if name in ("corpus_pipeline", "loanlake.llm") or name.startswith("loanlake.llm."):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, *args, **kw)

    monkeypatch.setattr(builtins, "__import__", without)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(QUERIES)


def test_a_missing_library_leaves_out_the_operators_that_need_it_and_says_so(monkeypatch):
    import builtins
    real = builtins.__import__

    def broken(name, *args, **kw):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("No module named 'numpy'", name="numpy")
        return real(name, *args, **kw)

    monkeypatch.setattr(builtins, "__import__", broken)
    with pytest.warns(UserWarning, match="numpy"):
        assert set(E.queries()) == set(QUERIES)
    with pytest.warns(UserWarning, match="numpy"):
        assert set(E.oracle_sql()) == set(QUERIES)

    def wrong(name, *args, **kw):
        if name == "corpus_pipeline":
            raise ImportError("a name that is not there")
        return real(name, *args, **kw)

    monkeypatch.setattr(builtins, "__import__", wrong)
    with pytest.raises(ImportError):
        E.queries()


# what each rule finds in the smallest tables: none of these can pass on an empty or a wrong result
MUST_FIND = {"payment_doubles": 5, "late_versions": 5, "rejected_loans": 1, "fk_violations": 1, "overcollected_loans": 1, "loans_without_installments": 1}


@pytest.mark.parametrize("name", sorted(MUST_FIND))
def test_planted_defects_are_found(spark, name):
    assert QUERIES[name](spark, SMALL).count() >= MUST_FIND[name]


def test_binding_discriminates(spark):
    report = {r.seq: r.failed_count for r in QUERIES["quality_report"](spark, "/root/testdata/sf0.01").collect()}
    assert [seq for seq, n in report.items() if n == 0] == []
    rows = {n: QUERIES[n](spark, SMALL).count() for n in (
        "stage_payments", "dedup_payments", "incremental_upsert", "incremental_append", "incremental_merge")}
    assert rows["dedup_payments"] < rows["stage_payments"] and rows["incremental_merge"] < rows["dedup_payments"]
    classes = {r.cohort_class for r in QUERIES["q3_cohort_health"](spark, "/root/testdata/sf0.01").collect()}
    assert len(classes) >= 4
