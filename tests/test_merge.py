"""Keyed merges and incremental helpers: idempotence, winners, file log,
step isolation and view registration."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hearth.operators import incremental as INC
from hearth.operators import merge as K

SCHEMA = "k long, v string, n int"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_incoming_wins_and_is_idempotent(spark):
    cur = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA)
    new = spark.createDataFrame([(2, "B", 2), (3, "c", 2), (3, "c2", 3)], SCHEMA)
    once = K.upsert(cur, new.withColumn("ord", F.col("n")), ["k"], ordinal="ord")
    assert _rows(once) == [(1, "a", 1), (2, "B", 2), (3, "c2", 3)]
    twice = K.upsert(once, new.withColumn("ord", F.col("n")), ["k"], ordinal="ord")
    assert _rows(twice) == _rows(once)


def test_upsert_keeps_protected_columns(spark):
    cur = spark.createDataFrame([(1, "accepted", 1)], SCHEMA)
    new = spark.createDataFrame([(1, "created", 5), (2, "created", 5)], SCHEMA)
    got = _rows(K.upsert(cur, new, ["k"], keep_current=("v",)))
    assert got == [(1, "accepted", 5), (2, "created", 5)]


def test_insert_if_absent(spark):
    cur = spark.createDataFrame([(1, "old", 1)], SCHEMA)
    new = spark.createDataFrame([(1, "new", 2), (2, "first", 3), (2, "second", 4)], SCHEMA)
    got = _rows(K.insert_new(cur, new.withColumn("ord", F.col("n")), ["k"], ordinal="ord"))
    assert got == [(1, "old", 1), (2, "first", 3)]


def test_merge_sites_coalesce_rules(spark):
    cur = spark.createDataFrame([(1, "Old", "Nick", True), (2, "Two", None, True)],
                                "business_location_id long, business_name string, nickname string, active boolean")
    new = spark.createDataFrame([(1, "New", "Other", True), (3, None, "Three", True)],
                                "business_location_id long, business_name string, nickname string, active boolean")
    got = {r.business_location_id: (r.business_name, r.nickname) for r in K.merge_sites(cur, new).collect()}
    assert got == {1: ("New", "Nick"), 2: ("Two", None), 3: (None, "Three")}


def test_watermark_ignores_nulls(spark):
    t = dt.datetime
    state = spark.createDataFrame([(1, "sales", t(2026, 8, 1)), (2, "sales", None)],
                                  "business_location_id long, resource string, last_watermark timestamp")
    batch = spark.createDataFrame([(1, "sales", t(2026, 7, 1)), (2, "sales", t(2026, 8, 2)), (3, "sales", None)],
                                  "business_location_id long, resource string, last_watermark timestamp")
    got = {r.business_location_id: r.last_watermark for r in K.advance_watermark(state, batch).collect()}
    assert got == {1: t(2026, 8, 1), 2: t(2026, 8, 2), 3: None}


def test_fill_location_ids(spark):
    sites = spark.createDataFrame([(10, "Tap Harbour"), (11, "Tap Quay."), (12, "Quay Darts")],
                                  "business_location_id long, nickname string")
    m = spark.createDataFrame([(1, "Harbour", None), (2, "quay", 99), (3, "Nowhere", 5)],
                              "code int, site_name string, business_location_id long")
    only_null = {r.code: r.business_location_id for r in K.fill_location_ids(m, sites).collect()}
    assert only_null == {1: 10, 2: 99, 3: 5}
    overwrite = {r.code: r.business_location_id for r in K.fill_location_ids(m, sites, only_null=False).collect()}
    assert overwrite == {1: 10, 2: 11, 3: 5}


def test_new_files_and_predicates(spark):
    files = spark.createDataFrame([("a.csv", "h1"), ("a.csv", "h2"), ("b.csv", "h3")], "filename string, sha256 string")
    log = spark.createDataFrame([("a.csv", "h1")], "filename string, sha256 string")
    assert _rows(K.new_files(files, log)) == [("a.csv", "h2"), ("b.csv", "h3")]
    assert K.new_files(files, log, force=True).count() == 3
    df = spark.createDataFrame([(1, "x", None), (2, "y", 1)], SCHEMA)
    assert _rows(K.delete_where(df, F.col("n") == 1)) == [(1, "x", None)]
    assert _rows(K.update_where(df, F.col("k") == 2, {"v": F.lit("z")})) == [(1, "x", None), (2, "z", 1)]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (None, "c", 1)], SCHEMA)
    got = {(r.k, r.kind, r.rows) for r in K.key_violations(df, ["k"]).collect()}
    assert got == {(1, "duplicate", 2), (None, "null_key", 1)}


def test_write_version(spark):
    root = tempfile.mkdtemp(prefix="hearth-table-")
    df = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    p = K.write_version(df, root, 1)
    assert os.path.exists(f"{p}/_SUCCESS")
    with pytest.raises(Exception):
        K.write_version(df, root, 1)     # versions are immutable


def test_incremental_window(spark):
    t = dt.datetime
    sites = spark.createDataFrame([(1,), (2,), (3,)], "business_location_id long")
    state = spark.createDataFrame([(1, t(2026, 8, 10)), (3, t(2020, 1, 1))], "business_location_id long, last_watermark timestamp")
    first = spark.createDataFrame([(2, t(2026, 6, 1))], "business_location_id long, first_time timestamp")
    got = {r.business_location_id: r.window_from
           for r in INC.incremental_window(state, sites, "2026-08-20 00:00:00", first_seen=first).collect()}
    assert got[1] == t(2026, 8, 8)                    # watermark - 48 h
    assert got[2] == t(2026, 6, 1)                    # backfill clamped to the first data
    assert got[3] == t(2025, 8, 21)                   # capped at 364 days


def test_date_grid_and_steps(spark):
    r = spark.createDataFrame([(1, dt.date(2026, 8, 1), dt.date(2026, 8, 3))],
                              "business_location_id long, date_from date, date_to date")
    assert INC.date_grid(r).count() == 3

    def boom():
        raise RuntimeError("feed down")

    ran = []
    status, ok = INC.run_steps([("a", lambda: ran.append("a")), ("b", boom), ("c", lambda: ran.append("c"))], spark)
    assert not ok and ran == ["a", "c"]
    assert {(s.step, s.status) for s in status.collect()} == {("a", "ok"), ("b", "failed"), ("c", "ok")}
    names = INC.register_views(spark, [("v_one", lambda: spark.range(3)),
                                       ("v_two", lambda: spark.sql("SELECT id * 2 AS x FROM v_one"))])
    assert names == ["v_one", "v_two"] and spark.sql("SELECT sum(x) FROM v_two").first()[0] == 6


def test_rolling_window(spark):
    lo, hi = INC.rolling_window("2026-08-20", 14)
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert row.lo == dt.date(2026, 8, 6) and row.hi == dt.date(2026, 8, 20)
