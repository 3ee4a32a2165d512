"""The nightly load end to end on landed files: every step succeeds, the merged
tables hold the feed's rows, and a rerun (same files) writes a new version with
the same content."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hearth.plans.nightly import VersionedTables, nightly
from hearth.sources.testdata import Warehouse


def _content(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_nightly_is_idempotent(spark):
    w = Warehouse(spark, SF_SMALL)
    landing = tempfile.mkdtemp(prefix="hearth-landing-")
    root = tempfile.mkdtemp(prefix="hearth-wh-")
    w.receipt_docs.write.mode("overwrite").json(f"{landing}/receipts")
    w.sentiment_reviews.select(F.col("sentiment_label").alias("Business"), F.col("source").alias("Source"),
                               F.date_format("review_date", "yyyy-MM-dd").alias("Date"),
                               F.col("rating").cast("string").alias("Rating"), F.col("review_text").alias("Text"),
                               F.col("reviewer").alias("User")) \
        .write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", True) \
        .csv(f"{landing}/reviews")
    w.webhook_deliveries.write.mode("overwrite").json(f"{landing}/webhooks")

    status, ok = nightly(spark, landing, root)
    assert ok, status.collect()
    t = VersionedTables(spark, root)
    sales_cols = ["business_location_id", "account_reference", "time_closed", "owner_name"]
    assert _content(t.current("sales"), sales_cols) == _content(w.sales, sales_cols)
    # the line key is enforced by the merge (the smallest test set has one repeated line)
    line_key = ["business_location_id", "account_reference", "line_id"]
    assert t.current("sales_lines").count() == w.sales_lines.select(*line_key).distinct().count()
    assert t.current("sentiment_reviews").count() == w.sentiment_reviews.count()
    assert t.current("storekit_orders").count() == w.storekit_orders.count()
    wm = {r.business_location_id: r.last_watermark for r in t.current("ingest_state").collect()}
    assert wm == {r[0]: r[1] for r in w.sales.groupBy("business_location_id").agg(F.max("time_closed")).collect()}
    first = _content(t.current("payments"), ["account_reference", "payment_uuid", "tip"])

    # a killed run left a folder without its marker: the next run goes past it
    os.makedirs(f"{root}/sales/v=2")
    status, ok = nightly(spark, landing, root)
    assert ok, status.collect()
    assert t.versions("sales") == [1, 3]
    # no review file is new, so none is parsed again
    assert t.versions("sentiment_reviews") == [1] and t.versions("file_log") == [1]
    assert _content(t.current("payments"), ["account_reference", "payment_uuid", "tip"]) == first
    assert _content(t.current("sales"), sales_cols) == _content(w.sales, sales_cols)
    assert os.path.exists(f"{root}/sales/v=3/_SUCCESS")


def test_watermarks_of_other_resources_stay(spark):
    root, landing = tempfile.mkdtemp(prefix="hearth-wh-"), tempfile.mkdtemp(prefix="hearth-landing-")
    os.makedirs(f"{landing}/reviews")
    os.makedirs(f"{landing}/webhooks")
    spark.createDataFrame([(7, '{"accountReference": "a", "timeClosed": "2024-01-02T10:00:00Z"}')],
                          "business_location_id long, doc string").write.json(f"{landing}/receipts")
    t = VersionedTables(spark, root)
    t.commit("ingest_state", spark.createDataFrame([(7, "items", "2024-01-01 00:00:00")], "business_location_id long, resource string, w string")
             .select("business_location_id", "resource", F.col("w").cast("timestamp").alias("last_watermark")))
    nightly(spark, landing, root)
    assert {r.resource for r in t.current("ingest_state").collect()} == {"items", "sales"}


def test_later_file_wins(spark):
    from hearth.plans.nightly import _merge, arrived
    root = tempfile.mkdtemp(prefix="hearth-wh-")
    folder = tempfile.mkdtemp(prefix="hearth-files-")
    for i, (name, big) in enumerate([("a", 1), ("b", 4000)]):     # the later file is the larger one, read first
        with open(f"{folder}/{name}.json", "w") as f:
            f.writelines('{"order_id": "x", "n": %d}\n' % (i * 100 + k) for k in range(big))
        os.utime(f"{folder}/{name}.json", (1_700_000_000 - i * 1000, 1_700_000_000 - i * 1000))
    t = VersionedTables(spark, root)
    _merge(t, "storekit_orders", arrived(spark.read.schema("order_id string, n long").json(folder)))
    assert t.current("storekit_orders").collect()[0].n == 0       # file a was modified last


def _receipt(ref, closed, lines=1, owner="Ann", net="5"):
    return (f'{{"accountReference": "{ref}", "timeClosed": "{closed}", "ownerName": "{owner}", "ownerId": "7", "salesLines": ['
            + ", ".join(f'{{"id": "{i}", "name": "x", "totalNetAmountWithoutTax": "{net}", "staffId": "8", "staffName": "Bo"}}' for i in range(lines))
            + f'], "payments": [{{"uuid": "p{ref}"}}]}}')


def _land(spark, landing, day, rows):
    spark.createDataFrame(rows, "business_location_id long, doc string").coalesce(1).write.mode("append").json(f"{landing}/receipts/day={day}")


def _files(root, name):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{root}/{name}") for f in fs if f.endswith(".parquet")}


def test_only_touched_periods_are_written_and_only_window_files_read(spark):
    root, landing = tempfile.mkdtemp(prefix="hearth-wh-"), tempfile.mkdtemp(prefix="hearth-landing-")
    for folder in ("reviews", "webhooks"):
        os.makedirs(f"{landing}/{folder}")
    for day in range(1, 7):
        _land(spark, landing, f"2024-01-0{day}", [(7, _receipt(f"a{day}", f"2024-01-0{day}T12:00:00Z")), (8, _receipt(f"b{day}", f"2024-01-0{day}T13:00:00Z"))])
    nightly(spark, landing, root, now="2024-01-07 05:30:00", grain="day")
    t = VersionedTables(spark, root)
    assert sorted(t.period_paths("sales")) == [f"2024-01-0{d}" for d in range(1, 7)]
    before = {n: _files(root, n) for n in ("sales", "sales_lines", "payments")}
    # day 5 is corrected: one receipt moves to day 6, one changes, one is new
    _land(spark, landing, "2024-01-07", [(7, _receipt("a5", "2024-01-06T09:00:00Z", lines=3)), (8, _receipt("b5", "2024-01-05T13:00:00Z", owner="Zoe")),
                                         (8, _receipt("c6", "2024-01-06T18:00:00Z"))])
    # an old folder whose content would change the table, were it read
    _land(spark, landing, "2024-01-02", [(7, _receipt("old", "2024-01-02T12:00:00Z"))])
    status, ok = nightly(spark, landing, root, now="2024-01-08 05:30:00")
    assert status.filter("step = 'receipts'").first().status == "ok"
    sales = {r.account_reference: r for r in t.current("sales").collect()}
    assert "old" not in sales and sales["b5"].owner_name == "Zoe" and str(sales["a5"].business_date) == "2024-01-06" and len(sales) == 13
    assert t.current("sales_lines").filter("account_reference = 'a5'").count() == 3
    assert t.current("sales_lines").filter("account_reference = 'a5'").select("business_period").distinct().collect()[0][0] == "2024-01-06"
    paths = t.period_paths("sales")
    assert {p for p, f in paths.items() if "/v=2/" in f} == {"2024-01-04", "2024-01-05", "2024-01-06"}      # the window's days
    for name, files in before.items():
        now = _files(root, name)
        assert all(now[f] == m for f, m in files.items())       # nothing that was written is touched
        assert not any("/v=2/business_period=2024-01-02" in f or "/v=2/business_period=2024-01-03" in f for f in now)
    assert {(r.staff_id, r.name) for r in t.current("staff_names").collect()} == {(7, "Ann"), (8, "Bo")}


def test_a_window_prunes_the_landing_folder(spark):
    from hearth.plans.nightly import landed_receipts
    landing = tempfile.mkdtemp(prefix="hearth-landing-")
    for day in range(1, 9):
        _land(spark, landing, f"2024-02-0{day}", [(7, _receipt(f"a{day}", f"2024-02-0{day}T12:00:00Z"))] * day)
    windows = spark.createDataFrame([(7, "2024-02-06 00:00:00")], "business_location_id long, f string").select(
        "business_location_id", F.col("f").cast("timestamp").alias("window_from"), F.lit("2024-02-09").cast("timestamp").alias("window_to"))
    df = landed_receipts(spark, f"{landing}/receipts", windows)
    assert df.count() == 5 + 6 + 7 + 8 and len(df.select(F.input_file_name()).distinct().collect()) == 4
    assert landed_receipts(spark, f"{landing}/receipts", None).count() == 36


def test_a_period_that_lost_its_rows_is_empty(spark):
    from hearth.plans.nightly import merge_periods
    from hearth.sources.periods import with_period
    root = tempfile.mkdtemp(prefix="hearth-wh-")
    t = VersionedTables(spark, root)

    def batch(rows):
        return with_period(spark.createDataFrame(rows, "business_location_id long, account_reference string, business_date string")
                           .withColumn("business_date", F.col("business_date").cast("date")), "month")
    assert merge_periods(t, "sales", batch([(1, "a", "2024-01-05"), (1, "b", "2024-02-05"), (1, "c", None)])) == 1
    assert merge_periods(t, "sales", batch([(1, "a", "2024-03-05")])) == 2
    assert merge_periods(t, "sales", batch([(1, "c", "2024-03-06")]).limit(0)) is None
    got = {(r.account_reference, r.business_period) for r in t.current("sales").collect()}
    assert got == {("a", "2024-03"), ("b", "2024-02"), ("c", "undated")}
    assert t.current("sales", ["2024-01"]) is None
