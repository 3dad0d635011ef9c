"""Property tests against brute force: SQL NOT IN three-valued semantics and dedup-latest."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loanlake.operators.existence import not_in_rows, with_not_in_flag
from loanlake.operators.upsert import dedup_latest

KEYS = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def sql_not_in(x, parent):
    """x NOT IN (parent) in SQL: TRUE / FALSE / None (unknown)."""
    if not parent:
        return True
    if x is None:
        return None
    if x in parent:
        return False
    return None if any(p is None for p in parent) else True


@SETTINGS
@given(child=st.lists(KEYS, max_size=8), parent=st.lists(KEYS, max_size=6))
def test_not_in_matches_sql_semantics(spark, child, parent):
    c = spark.createDataFrame([(i, k) for i, k in enumerate(child)], "id int, k string")
    p = spark.createDataFrame([(k,) for k in parent], "k string")
    want_rows = sorted(i for i, k in enumerate(child) if sql_not_in(k, parent) is True)
    got_rows = sorted(r["id"] for r in not_in_rows(c, "k", p, "k").collect())
    assert got_rows == want_rows
    flags = {r["id"]: r["f"] for r in with_not_in_flag(c, c["k"], p, "k", "f").collect()}
    assert flags == {i: sql_not_in(k, parent) is True for i, k in enumerate(child)}


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["p1", "p2", "p3"]), st.integers(0, 3), st.integers(0, 9)),
                     min_size=1, max_size=12))
def test_dedup_latest_matches_brute_force(spark, rows):
    base = dt.datetime(2030, 1, 1)
    data = [(k, base + dt.timedelta(hours=h), v) for k, h, v in rows]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v int")
    got = {r["k"]: (r["t"], r["v"]) for r in dedup_latest(df, ["k"], ["t"]).collect()}
    want = {}
    for k, t, v in data:  # latest stamp wins; ties go to the greatest remaining value
        if k not in want or (t, v) > want[k]:
            want[k] = (t, v)
    assert got == want


@SETTINGS
@given(stored=st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 9), max_size=4),
       updates=st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", "e"]), st.integers(0, 5), st.integers(10, 19)),
                        max_size=6))
def test_upsert_is_merge(spark, stored, updates):
    from loanlake.operators.upsert import upsert
    base = dt.datetime(2030, 1, 1)
    old = spark.createDataFrame([(k, base, v) for k, v in stored.items()], "k string, t timestamp_ntz, v int")
    new = spark.createDataFrame([(k, base + dt.timedelta(hours=h), v) for k, h, v in updates],
                                "k string, t timestamp_ntz, v int")
    got = {r["k"]: r["v"] for r in upsert(old, new, ["k"], ["t"]).collect()}
    want = dict(stored)
    latest = {}
    for k, h, v in updates:  # among updates of one key: latest stamp, then greatest value
        if k not in latest or (h, v) > latest[k]:
            latest[k] = (h, v)
    want.update({k: v for k, (h, v) in latest.items()})
    assert got == want


SNAP = st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.one_of(st.none(), st.sampled_from(["x", "y"])),
                       max_size=4)


@SETTINGS
@given(snaps=st.lists(SNAP, min_size=1, max_size=3))
def test_scd2_history_matches_brute_force(spark, snaps):
    from loanlake.operators.history import initial_history, scd2_apply
    days = [dt.date(2030, 1, 1) + dt.timedelta(days=i) for i in range(len(snaps))]
    frame = lambda snap: spark.createDataFrame(sorted(snap.items()), "k string, v string")
    h = initial_history(frame(snaps[0]), "k", ["v"], days[0])
    for snap, day in zip(snaps[1:], days[1:]):
        h = scd2_apply(h, frame(snap), "k", ["v"], day)
    order = lambda r: (r[0], r[1] or "", r[2], r[3] or dt.date.max)  # noqa: E731  NULL-safe sort key
    got = sorted(((r["k"], r["v"], r["valid_from"], r["valid_to"]) for r in h.collect()), key=order)
    versions, open_ = [], {}
    for snap, day in zip(snaps, days):
        for k in list(open_):
            if k not in snap or snap[k] != open_[k][0]:
                versions.append((k, open_[k][0], open_[k][1], day))
                del open_[k]
        for k, v in snap.items():
            if k not in open_:
                open_[k] = (v, day)
    versions += [(k, v, since, None) for k, (v, since) in open_.items()]
    assert got == sorted(versions, key=order)
