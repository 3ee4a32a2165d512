"""Receipt tables by business period: grains, pruning, and the stored layout; the head
of CSV files; the staff-name dimension."""

import contextlib
import datetime as dt
import io
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from hearth.operators.staff import merge_staff_names
from hearth.plans.catalog import load_all
from hearth.sources import periods as P
from hearth.sources import store
from hearth.sources.feeds import csv_header, csv_headers, scan_csv
from hearth.sources.testdata import Warehouse


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_the_grain_follows_the_bytes_of_a_day():
    day = P.PARTITION_BYTES
    assert P.choose_grain(100 * day, 100) == "day"
    assert P.choose_grain(100 * day, 101) == "month"
    assert P.choose_grain(100 * day, 4000) == "year"
    assert P.choose_grain(0, 0) == "year"


@pytest.mark.parametrize("grain", sorted(P.GRAINS))
def test_within_is_exact_at_every_grain(spark, grain):
    days = [dt.date(2023, 12, 30) + dt.timedelta(days=7 * i) for i in range(12)] + [None]
    df = P.with_period(spark.createDataFrame([(d,) for d in days], "business_date date"), grain)
    folder = tempfile.mkdtemp(prefix="hearth-periods-") + "/t"
    df.write.partitionBy(P.PERIOD).parquet(folder)
    stored = spark.read.schema("business_date date, business_period string").parquet(folder)
    known = [d for d in days if d]
    for a, b in ((dt.date(2024, 1, 6), dt.date(2024, 1, 20)), (dt.date(2024, 1, 1), dt.date(2024, 1, 31)), (dt.date(2024, 2, 3), dt.date(2024, 2, 3))):
        found = P.within(stored, a, b)
        assert sorted(r.business_date for r in found.collect()) == [d for d in known if a <= d <= b]
        assert "PartitionFilters: [isnotnull(business_period" in plan(found)
    assert sorted(r.business_date for r in P.within(stored, F.lit("2024-01-10")).collect()) == [d for d in known if d >= dt.date(2024, 1, 10)]
    plain = df.select("business_date")
    assert P.within(plain, "2024-01-01") is plain


def test_reports_read_the_partitions_of_their_days(spark):
    queries, _ = load_all()
    for name in ("v63_uncategorised_best_sellers", "v64_category_report_total", "v65_shift_report", "v66_shift_compare", "v28_basket_base"):
        scans = [x for x in plan(queries[name](spark, SF_SMALL)).split("\n") if "PartitionFilters: [" in x and "business_period" in x]
        pruned = [x for x in scans if "business_period" in x.split("PartitionFilters: [")[1]]
        assert len(pruned) >= 2, name       # lines and receipts


def test_stored_lines_carry_the_date_of_their_receipt(spark):
    w = store.stored_warehouse(spark, SF_SMALL)
    key = store.RECEIPT_KEY
    both = w.sales_lines.join(w.sales.select(*key, F.col("business_date").alias("d"), F.col("business_period").alias("p")), key)
    assert both.count() == Warehouse(spark, SF_SMALL).sales_lines.count()
    assert both.filter(~F.col("d").eqNullSafe(F.col("business_date")) | (F.col("p") != F.col("business_period"))).count() == 0


def test_buckets_are_bounded(spark, monkeypatch):
    w = store.StoredWarehouse(Warehouse(spark, SF_SMALL))
    monkeypatch.setattr(w, "_input_bytes", lambda: 100 * 10 ** 12)
    assert w._buckets() == store.MAX_BUCKETS < 100_000


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_follow_the_bytes_of_the_receipt_tables(spark, monkeypatch):
    w = store.StoredWarehouse(Warehouse(spark, SF_SMALL))
    assert w._input_bytes() == sum(os.path.getsize(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    for mb in (512, 4096):
        monkeypatch.setattr(w, "_input_bytes", lambda mb=mb: mb * 1024 ** 2)
        assert w._buckets() >= mb // 4      # a task reads a whole bucket


def test_lines_are_shuffled_for_their_part_and_once_for_their_receipt(spark, no_broadcast):
    w = store.stored_warehouse(spark, SF_SMALL)
    w.sales
    src = w._dated("sales_lines", w._w.sales_lines, w._buckets(), store.BUCKETED["sales_lines"])
    assert shuffles(src) <= 3       # parts, lines by part, lines by reference
    assert {"business_date", "business_period"} <= set(src.columns)


def test_receipts_meet_their_lines_without_a_shuffle(spark, no_broadcast):
    w = store.stored_warehouse(spark, SF_SMALL)
    lines = w.sales_lines.groupBy(*store.RECEIPT_KEY, "p_staff_name").agg(F.sum("quantity").alias("q"))
    assert shuffles(w.sales.join(lines, store.RECEIPT_KEY).groupBy(*store.RECEIPT_KEY).agg(F.max("q"))) == 0


def test_names_are_read_from_the_stored_lines(spark):
    w = store.stored_warehouse(spark, SF_SMALL)
    w.sales_lines
    for name in ("staff_names", "item_name_categories"):
        assert not [f for f in getattr(w._w, name).inputFiles() if "lineitem.parquet" in f], name


def test_receipt_payloads_are_built_from_the_stored_buckets(spark, no_broadcast):
    w = store.stored_warehouse(spark, SF_SMALL)
    w.sales_lines, w.payments
    assert shuffles(w._w.receipt_docs) == 0


def test_market_lines_are_shuffled_once_for_their_receipt_and_order(spark, no_broadcast):
    w = store.stored_warehouse(spark, SF_SMALL)
    w.sales
    assert shuffles(w._w.peazi_order_lines) <= 3


def test_names_merge_to_the_least(spark):
    schema = "staff_id long, name string"
    old = spark.createDataFrame([(1, "Bea"), (2, "Cy")], schema)
    new = spark.createDataFrame([(1, "Ann"), (2, "Dee"), (3, "Eve")], schema)
    assert sorted(map(tuple, merge_staff_names(old, new).collect())) == [(1, "Ann"), (2, "Cy"), (3, "Eve")]


HEADS = {
    "plain.csv": ("a,b\n1,2\n", ["a", "b"]),
    "bom.csv": ("﻿a,b\r\n1,2\r\n", ["a", "b"]),
    "breaks.csv": ('"a\nlong ""one""","b,c"\n1,2\n', ['a\nlong "one"', "b,c"]),
    "no_end.csv": ("a,b", ["a", "b"]),
    "blank_first.csv": ("\n\na,b\n", ["a", "b"]),
    "long.csv": ('"' + "x" * 100_000 + '",b\n' + "1,2\n" * 1000, ["x" * 100_000, "b"]),
    "unclosed.csv": ('a,"b', ["a", "b"]),
}


def test_heads_of_csv_files(spark):
    folder = tempfile.mkdtemp(prefix="hearth-csv-")
    for name, (text, _) in HEADS.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
            f.write(text)
    for name, (_, want) in HEADS.items():
        if name != "unclosed.csv":      # no record: any cells, but an end
            assert csv_header(spark, f"file://{folder}/{name}") == want, name
    assert isinstance(csv_header(spark, f"file://{folder}/unclosed.csv"), list)
    open(f"{folder}/empty.csv", "w").close()
    assert not any(f.endswith("empty.csv") for _, files in csv_headers(spark, folder) for f in files)


def test_a_header_cell_may_hold_a_line_break(spark):
    folder = tempfile.mkdtemp(prefix="hearth-csv-")
    os.makedirs(f"{folder}/with space")
    with open(f"{folder}/with space/one.csv", "w", newline="") as f:
        f.write('"Guest\nname",Text\nAnn,"two\nlines"\nBo,x\n')
    with open(f"{folder}/two.csv", "w", newline="") as f:
        f.write('Text,Extra\ny,1\n')
    df = scan_csv(spark, folder)
    got = sorted((r["source_file"], r["Guest\nname"], r["Text"], r["Extra"]) for r in df.collect())
    assert got == [("one.csv", "Ann", "two\nlines", None), ("one.csv", "Bo", "x", None), ("two.csv", None, "y", "1")]


def test_deliveries_are_built_in_even_parts_however_the_events_lie(spark):
    w = store.stored_warehouse(spark, SF_SMALL)      # its events are one row group
    rows = [r["count"] for r in w._w.webhook_deliveries.groupBy(F.input_file_name()).count().collect()]
    assert len(rows) >= spark.sparkContext.defaultParallelism and max(rows) < 2 * sum(rows) / len(rows)


def test_parts_of_the_events_follow_their_bytes(spark, monkeypatch):
    w = store.StoredWarehouse(Warehouse(spark, SF_SMALL))
    asked = []
    monkeypatch.setattr(w, "_input_bytes", lambda *t: (asked.append(t), 4096 * 1024 ** 2)[1])
    assert w._w.spread(spark.range(1), "events", "id").rdd.getNumPartitions() == 4096 * 1024 ** 2 // store.BUCKET_INPUT_BYTES
    assert asked == [("events",)]


def test_whole_events_are_shuffled_once(spark, no_broadcast):
    w = store.stored_warehouse(spark, SF_SMALL)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        w._w.storekit_orders.explain("formatted")
    dealt = [re.sub(r"#\d+L?", "", x).split(", ") for x in re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", out.getvalue())]
    assert len(dealt) > 1 and sum(not set(x) <= {"svix_id", "seq", "order_id"} for x in dealt) == 1
