"""The webhook stream (events stored batch by batch, touched orders folded anew) ends
in the same orders as the batch fold, however it is cut, replayed or delayed."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from hearth.sources.testdata import Warehouse
from hearth.streaming import orders as ST

COLS = ST.OUT_COLS


def _land(spark, root, deliveries, n_files=4):
    """Write deliveries as JSON files in arrival order (one file per seq band)."""
    bounds = deliveries.agg(F.min("seq"), F.max("seq")).first()
    lo, hi = bounds[0], bounds[1] + 1
    step = (hi - lo) // n_files + 1
    for i in range(n_files):
        part = deliveries.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step))
        tmp = f"{root}/tmp{i}"
        part.coalesce(1).write.mode("overwrite").json(tmp)
        (f,) = [x for x in os.listdir(tmp) if x.endswith(".json")]
        os.rename(f"{tmp}/{f}", f"{root}/landing/part-{i:03d}.json")


def _rows(df):
    return sorted(tuple(map(repr, r)) for r in df.select(*COLS).collect())


def _batch(deliveries):
    return _rows(ST.fold_orders(ST.dedupe_deliveries(ST.normalise_events(deliveries))))


def _land_rows(spark, root, name, rows):
    """One landed JSON file."""
    tmp = f"{root}/tmp-{name}"
    spark.createDataFrame(rows, "seq long, received_at string, svix_id string, body string").coalesce(1).write.json(tmp)
    (f,) = [x for x in os.listdir(tmp) if x.endswith(".json")]
    os.rename(f"{tmp}/{f}", f"{root}/landing/{name}.json")


def test_stream_equals_batch(spark):
    w = Warehouse(spark, SF_SMALL)
    deliveries = w.webhook_deliveries
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    _land(spark, root, deliveries)
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(deliveries)
    # replay: the checkpoint says everything was processed; nothing changes
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(deliveries)
    # another checkpoint over the same table delivers everything a second time
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt2")
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(deliveries)


def _order(event, order, venue, created="2024-03-01T10:00:00Z", **more):
    return json.dumps({"event": event, "data": {"id": order, "venue": {"id": venue, "name": f"V{venue}"}, "createdAt": created,
                                               "total": 12.5, **more}})


BIG = 9007199254740993


def _hand_made():
    """Orders split over batches, 16-digit ids, a NULL venue beside them, a delivery
    weeks late, and a delivery id seen again."""
    return [
        [(1, "2024-03-20T10:00:00Z", "a", _order("order.created", "o1", BIG)),
         (2, "2024-03-20T10:00:01Z", "b", json.dumps({"event": "order.completed", "data": {"order": {"id": "o2"}}}))],
        [(3, "2024-03-20T11:00:00Z", "c", _order("order.accepted", "o1", BIG, "2024-03-01T10:00:05Z")),
         (4, "2024-03-20T11:00:01Z", "a", _order("order.created", "o1", 5))],
        [(5, "2024-03-02T09:00:00Z", "d", _order("order.created", "late", BIG + 2)),
         (6, "2024-03-20T12:00:00Z", "e", _order("order.created", "o2", BIG))],
    ]


def test_columns_types_and_late_deliveries(spark):
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    batches = _hand_made()
    for i, rows in enumerate(batches):
        _land_rows(spark, root, f"part-{i}", rows)
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    everything = spark.read.schema(ST.DELIVERY_SCHEMA).json(f"{root}/landing")
    got = {r.order_id: r for r in ST.current_orders(spark, f"{root}/orders").collect()}
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(everything)
    assert got["o1"].venue_id == BIG and got["late"].venue_id == BIG + 2 and got["o2"].venue_id == BIG
    assert got["o1"].status == "accepted" and got["o1"].created_at is not None


def test_crash_between_write_and_commit(spark):
    """The batch's folders exist but the checkpoint does not know: the batch runs
    again, as after a crash just before the commit."""
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    batches = _hand_made()
    for i, rows in enumerate(batches):
        _land_rows(spark, root, f"part-{i}", rows)
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    before = _rows(ST.current_orders(spark, f"{root}/orders"))
    last = max(os.listdir(f"{root}/ckpt/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    os.rename(f"{root}/ckpt/commits/{last}", f"{root}/lost-commit")
    if os.path.exists(f"{root}/ckpt/commits/.{last}.crc"):
        os.rename(f"{root}/ckpt/commits/.{last}.crc", f"{root}/lost-commit-crc")
    # and half of what it wrote is gone
    (marker,) = [os.path.join(d, f) for d, _, fs in os.walk(f"{root}/orders/changes") for f in fs
                 if f == "_SUCCESS" and d.endswith(f"{int(last):012d}")]
    os.rename(marker, f"{root}/lost-marker")
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == before


def test_fold_rules(spark):
    """Out-of-order, duplicate and stub cases on a hand-made event list."""
    ev = spark.createDataFrame([
        # refund before the order exists -> stub with status ''
        (1, "a", "order.refund.created", "o1", None, None, 500),
        (2, "b", "order.created", "o1", 7, "V", None),
        (3, "c", "order.ready_for_pickup", "o1", 9, "W", None),
        (4, "", "order.refund.created", "o1", None, None, None),
        # created then completed; a lifecycle venue only fills a gap
        (5, "d", "order.created", "o2", None, None, None),
        (6, "e", "order.completed", "o2", 8, "X", None),
        (7, "f", "order.preparing", "o3", None, None, None),
        (8, "g", "store.updated", "o3", None, None, None),
    ], "seq long, svix_id string, event string, order_id string, venue_id long, venue_name string, "
       "refund_amount long")
    for c in ST.ORDER_COLS:
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    got = {r.order_id: r for r in ST.fold_orders(ev).collect()}
    assert got["o1"].status == "ready_for_pickup" and got["o1"].is_refunded and got["o1"].refund_total_pence == 500
    assert got["o1"].venue_id == 7 and got["o1"].last_svix_id == ""
    assert got["o2"].status == "completed" and got["o2"].venue_id == 8 and not got["o2"].is_refunded
    assert got["o3"].status == "preparing" and got["o3"].last_event == "order.preparing"


def test_one_shuffle_of_events_gives_the_rows_of_two(spark):
    """Delivery ids seen again: in the order, in other orders, after a row without an order
    or an event that is not handled; empty ids all count."""
    status = lambda event, order: json.dumps({"event": event, "data": {"order": {"id": order}}})
    rows = [
        (1, "a", _order("order.created", "o1", 1)), (2, "a", _order("order.created", "o2", 2)),
        (3, "b", status("order.completed", "o2")), (4, "a", status("order.rejected", "o1")),
        (5, "c", status("store.updated", "o3")), (6, "c", _order("order.created", "o3", 3)),
        (7, "d", json.dumps({"event": "order.completed"})), (8, "d", _order("order.created", "o4", 4)),
        (9, "", _order("order.created", "o5", 5)), (10, "", status("order.completed", "o5")), (11, "", status("order.canceled", "o5")),
        (12, "e", _order("order.created", "o6", 6)), (13, "e", _order("order.created", "o6", 7)), (14, "e", status("order.refund.created", "o7")),
        (16, "f", _order("order.created", "o9", 9)), (17, "f", status("order.completed", "o9")), (15, "f", _order("order.created", "o8", 8)),
    ]
    deliveries = spark.createDataFrame([(n, None, i, b) for n, i, b in reversed(rows)], "seq long, received_at timestamp, svix_id string, body string")
    folded = ST.orders_from_deliveries(deliveries)
    assert _rows(folded) == _batch(deliveries)
    got = {r.order_id: r for r in ST.fold_deliveries(ST.normalise_events(deliveries)).collect()}
    assert {o: (r.venue_id, r.status) for o, r in got.items()} == {
        "o1": (1, "created"), "o2": (None, "completed"), "o5": (5, "canceled"), "o6": (6, "created"), "o8": (8, "created")}


def test_a_batch_reads_only_its_parts(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    _land_rows(spark, root, "part-0", _hand_made()[0])
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt")
    asked = []
    stored = ST._stored
    monkeypatch.setattr(ST, "_stored", lambda s, r, buckets=None, skip=None: (asked.append((os.path.basename(r), buckets)), stored(s, r, buckets, skip))[1])
    _land_rows(spark, root, "part-1", _hand_made()[1])
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt")
    assert {r for r, _ in asked} == {"events", "deliveries", "repeats"}
    assert all(buckets is not None and len(buckets) < 20 for _, buckets in asked)
    monkeypatch.undo()
    everything = spark.read.schema(ST.DELIVERY_SCHEMA).json(f"{root}/landing")
    assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(everything)


def test_compaction_changes_no_order(spark):
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    batches = _hand_made()
    for i, rows in enumerate(batches):
        _land_rows(spark, root, f"part-{i}", rows)
        ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt")
        ST.compact(spark, f"{root}/orders")
        everything = spark.read.schema(ST.DELIVERY_SCHEMA).json(f"{root}/landing")
        assert _rows(ST.current_orders(spark, f"{root}/orders")) == _batch(everything)
    assert len(ST._subfolders(spark, f"{root}/orders/events")) == 1


def test_a_delivery_id_of_two_orders_counts_for_the_earlier(spark):
    """The copy with the least seq counts, whichever batch it comes in."""
    ids = spark.createDataFrame([("s", 9, "x"), ("t", 10, "x"), ("s", 12, "x")], "svix_id string, seq long, order_id string")
    seen = spark.createDataFrame([("s", 4, "y"), ("u", 1, "y")], "svix_id string, seq long, order_id string")
    assert sorted(map(tuple, ST.repeated_ids(ids, seen).select("svix_id", "order_id", "first_seq").collect())) == [("s", "x", 4), ("s", "y", 4)]
    assert ST.repeated_ids(ids, None).count() == 0
    root = tempfile.mkdtemp(prefix="hearth-stream-")
    os.makedirs(f"{root}/landing")
    first, second = _hand_made()[:2]
    late = [(r[0] - 10_000, r[1], r[2], r[3].replace("o1", "other")) for r in first]      # the same ids, earlier, in another order
    for i, rows in enumerate((first, second, late)):
        _land_rows(spark, root, f"part-{i}", rows)
    ST.run_order_stream(spark, f"{root}/landing", f"{root}/orders", f"{root}/ckpt", files_per_trigger=1)
    everything = spark.read.schema(ST.DELIVERY_SCHEMA).json(f"{root}/landing")
    got, want = _rows(ST.current_orders(spark, f"{root}/orders")), _batch(everything)
    assert [r for r in want if r not in got] == []
