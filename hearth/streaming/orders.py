"""Online-order webhook processing (I05, I06, K04): batch fold and stream.

Semantics, per order in arrival order after de-duplication by delivery id:

* ``order.created`` / ``order.accepted`` carry the whole order and overwrite
  every order field (status and refund fields excepted); the first event of
  an order creates it with status 'created'; ``order.accepted`` also sets
  status 'accepted'.
* lifecycle events set the status they imply; ``order.refund.created`` sets
  only the refund flag (OR-ed) and amount (last non-NULL wins); a lifecycle
  event for an unknown order creates a stub (status '' for a refund).
  Venue id/name from a lifecycle event only fill a missing value.
* a delivery id seen before is ignored; an empty delivery id never counts
  as seen.

The batch fold is one aggregation keyed by order id; the stream stores typed
events in parts by order, and folds the orders that each micro-batch touches with
the same function, from the parts they lie in.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators.merge import net_sales_pence
from hearth.sources.feeds import normalise_events

FULL_EVENTS = ["order.created", "order.accepted"]
# Status implied by each lifecycle event (None = leave unchanged).
EVENT_STATUS = {
    "order.accepted": "accepted",
    "order.preparing": "preparing",
    "order.ready_for_pickup": "ready_for_pickup",
    "order.out_for_delivery": "out_for_delivery",
    "order.completed": "completed",
    "order.rejected": "rejected",
    "order.canceled": "canceled",
    "order.refund.created": None,
}
REFUND = "order.refund.created"
ORDER_COLS = ["venue_slug", "code", "order_type", "asap", "created_at", "delivery_time", "total_pence",
              "tip_pence", "delivery_fee_pence", "discount_pence", "customer_first", "customer_last",
              "customer_email", "customer_phone", "marketing_consent", "covers", "items", "raw"]
OUT_COLS = (["order_id", "venue_id", "venue_name"] + ORDER_COLS
            + ["status", "is_refunded", "refund_total_pence", "last_event", "last_svix_id"])


def dedupe_deliveries(ev: DataFrame) -> DataFrame:
    """I05 (batch): the first arrival of each delivery id; empty ids all pass."""
    keyed = ev.filter(F.col("svix_id") != "")
    first = keyed.groupBy("svix_id").agg(F.min_by(F.struct(*[c for c in ev.columns if c != "svix_id"]),
                                                  F.col("seq")).alias("_f"))
    first = first.select("svix_id", "_f.*").select(*ev.columns)
    return first.unionByName(ev.filter(F.col("svix_id") == ""))


def fold_orders(ev: DataFrame) -> DataFrame:
    """I06/K04 (batch): current order rows from de-duplicated, typed events."""
    handled = FULL_EVENTS + [e for e in EVENT_STATUS if e not in FULL_EVENTS]
    ev = ev.filter(F.col("event").isin(*handled) & F.col("order_id").isNotNull())
    is_full = F.col("event").isin(*FULL_EVENTS)
    implied = F.create_map(*[F.lit(x) for k, v in EVENT_STATUS.items() if v for x in (k, v)])[F.col("event")]
    w = Window.partitionBy("order_id")
    ev = ev.withColumn("_lf", F.max(F.when(is_full, F.col("seq"))).over(w))
    after_full = F.col("seq") >= F.coalesce(F.col("_lf"), F.lit(-1))

    def first_after_full(c):
        return F.min_by(F.col(c), F.when(after_full & F.col(c).isNotNull(), F.col("seq")))

    g = ev.groupBy("order_id").agg(
        F.max_by(F.struct(*ORDER_COLS), F.when(is_full, F.col("seq"))).alias("_o"),
        first_after_full("venue_id").alias("venue_id"),
        first_after_full("venue_name").alias("venue_name"),
        F.min_by(F.col("event"), F.col("seq")).alias("_first"),
        F.max_by(implied, F.when(implied.isNotNull(), F.col("seq"))).alias("_st"),
        F.bool_or(F.col("event") == REFUND).alias("is_refunded"),
        F.max_by(F.col("refund_amount"),
                 F.when((F.col("event") == REFUND) & F.col("refund_amount").isNotNull(), F.col("seq")))
         .alias("refund_total_pence"),
        F.max_by(F.struct(F.col("event").alias("e"), F.col("svix_id").alias("s")), F.col("seq")).alias("_last"),
    )
    status = F.coalesce(F.col("_st"), F.when(F.col("_first").isin(*FULL_EVENTS), F.lit("created")), F.lit(""))
    return g.select("order_id", "venue_id", "venue_name", *[F.col(f"_o.{c}").alias(c) for c in ORDER_COLS],
                    status.alias("status"), "is_refunded", "refund_total_pence",
                    F.col("_last.e").alias("last_event"), F.col("_last.s").alias("last_svix_id"))


def copies_elsewhere(ev: DataFrame) -> DataFrame:
    """``order_id, svix_id`` of the delivery ids that came first in another order."""
    arrival = Window.partitionBy("svix_id").orderBy("seq", "order_id")
    ids = ev.filter(F.col("svix_id") != "").select("svix_id", "seq", "order_id")
    return (ids.withColumn("_first", F.first("order_id").over(arrival))
               .filter(~F.col("order_id").eqNullSafe(F.col("_first"))).select("order_id", "svix_id").distinct())


def fold_deliveries(ev: DataFrame) -> DataFrame:
    """I05 and I06 (batch): the rows of ``fold_orders(dedupe_deliveries(ev))``. Whole events
    are shuffled once, to their order, where copies of an id within the order meet; copies
    in other orders are found on the ids alone."""
    before = F.lag("svix_id").over(Window.partitionBy("order_id").orderBy("svix_id", "seq"))
    own = ev.filter(F.col("order_id").isNotNull()).withColumn("_before", before).filter(
        (F.col("svix_id") == "") | F.col("_before").isNull() | (F.col("_before") != F.col("svix_id")))
    return fold_orders(own.drop("_before").join(copies_elsewhere(ev), ["order_id", "svix_id"], "left_anti"))


def with_net_sales(orders: DataFrame) -> DataFrame:
    """The generated column."""
    return orders.withColumn("net_sales_pence", net_sales_pence())


def orders_from_deliveries(deliveries: DataFrame) -> DataFrame:
    """Landed deliveries -> current online orders (batch)."""
    return with_net_sales(fold_deliveries(normalise_events(deliveries)))


# ------------------------------------------------------------------ streaming
DELIVERY_SCHEMA = "seq long, received_at timestamp, svix_id string, body string"

#: Parts of each store, by a hash of the order (of the delivery id for ``deliveries``).
#: A micro-batch reads the parts it touches. The number belongs to the stored layout.
BUCKETS = 256
STORES = ("events", "deliveries", "repeats", "changes")


def _bucket(c: str):
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("int")


def _fs(spark, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _subfolders(spark, root: str, committed: bool = True) -> list[str]:
    """Folders ``root/<run>/batch=<n>``; with ``committed``, those whose write ended.
    ``compact`` keeps them few."""
    fs, base = _fs(spark, root)
    if not fs.exists(base):
        return []
    out = []
    for run in fs.listStatus(base):
        for batch in fs.listStatus(run.getPath()):
            path = batch.getPath().toString()
            if not committed or fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]):
                out.append(path)
    return sorted(out)


def _parts(spark, folder: str) -> dict[int, str]:
    """Bucket -> its folder inside a batch's folder."""
    fs, p = _fs(spark, folder)
    names = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
    return {int(n.getName()[7:]): n.toString() for n in names if n.getName().startswith("bucket=")}


def _stored(spark, root: str, buckets=None, skip: str | None = None) -> DataFrame | None:
    """The store's rows in ``buckets`` (None: all), but for the batch ``skip``."""
    paths = [path for f in _subfolders(spark, root) if skip is None or not f.endswith(skip)
             for b, path in _parts(spark, f).items() if buckets is None or b in buckets]
    return spark.read.parquet(*paths) if paths else None


def _write(df: DataFrame, folder: str) -> None:
    """``df`` by its column ``bucket``, one file each, in place of an earlier attempt."""
    df.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)


def _union(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    if a is None or b is None:
        return b if a is None else a
    return a.unionByName(b)


def fold_touched(events: DataFrame, orders: DataFrame, repeats: DataFrame | None) -> DataFrame:
    """Current rows of ``orders`` from their stored events: the same fold as in batch, so
    late deliveries and deliveries split over batches end in the same row. A delivery
    id counts once over all time, for the copy with the least ``seq``; ``repeats``
    holds that number for the ids of several orders."""
    own = events.join(orders, "order_id", "left_semi")
    counted = own
    if repeats is not None:
        first = repeats.groupBy("svix_id").agg(F.min("first_seq").alias("_first"))
        counted = own.join(first, "svix_id", "left").filter(
            (F.col("svix_id") == "") | F.col("_first").isNull() | (F.col("seq") <= F.col("_first"))).drop("_first")
    folded = fold_orders(dedupe_deliveries(counted.select(*events.columns)))
    # a delivery that was stored twice (a second checkpoint, a crash in ``compact``) is one event
    n = own.groupBy("order_id").agg(F.count_distinct(F.struct("seq", "svix_id", "event")).alias("n_events"))
    return folded.join(n, "order_id").select(*OUT_COLS, "n_events")


def repeated_ids(ids: DataFrame, seen: DataFrame | None) -> DataFrame:
    """``svix_id, order_id, first_seq`` of the delivery ids in ``ids`` that stand in
    several orders, here or among those ``seen`` before: a row for each of the orders."""
    copies = _union(ids, None if seen is None else seen.join(ids.select("svix_id").distinct(), "svix_id", "left_semi"))
    several = copies.groupBy("svix_id").agg(F.min("seq").alias("first_seq"), F.count_distinct("order_id").alias("n")).filter("n > 1")
    return copies.select("svix_id", "order_id").distinct().join(several.drop("n"), "svix_id")


def run_order_stream(spark, landing_dir: str, table_root: str, checkpoint: str, files_per_trigger=None):
    """Drain the landing folder (``availableNow``). A micro-batch stores its typed
    events by order, its delivery ids by id, and the ids it finds in several orders by
    order; then it folds the orders it touches from their parts of the event store and
    stores their new rows. It reads no part without one of its orders or ids, and
    no delivery is ever too late.

    Each store has a folder named after the run (its checkpoint) and the batch. A batch
    that is replayed after a crash, at whatever point, leaves its own folders out of
    what it reads and writes them anew, so it ends the same."""
    run = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def merge_batch(batch: DataFrame, batch_id: int):
        own = f"run={run}/batch={batch_id:012d}"
        folder = {s: f"{table_root}/{s}/{own}" for s in STORES}
        _write(normalise_events(batch).withColumn("bucket", _bucket("order_id")), folder["events"])
        touched = set(_parts(spark, folder["events"]))
        if not touched:
            return
        fresh = spark.read.parquet(*_parts(spark, folder["events"]).values())
        ids = fresh.filter(F.col("svix_id") != "").filter("order_id is not null").select("svix_id", "seq", "order_id").distinct()
        _write(ids.withColumn("bucket", _bucket("svix_id")), folder["deliveries"])
        seen = _stored(spark, f"{table_root}/deliveries", set(_parts(spark, folder["deliveries"])), skip=own)
        _write(repeated_ids(ids, seen).withColumn("bucket", _bucket("order_id")), folder["repeats"])
        shared = _parts(spark, folder["repeats"])
        orders = fresh.select("order_id")
        if shared:
            orders = orders.union(spark.read.parquet(*shared.values()).select("order_id"))
        touched |= set(shared)
        known = _stored(spark, f"{table_root}/events", touched, skip=own)
        repeats = _stored(spark, f"{table_root}/repeats", touched)
        rows = fold_touched(_union(known, fresh), orders.filter("order_id is not null").distinct(), repeats)
        _write(rows.withColumn("bucket", _bucket("order_id")), folder["changes"])

    r = spark.readStream.schema(DELIVERY_SCHEMA)
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    q = (r.json(landing_dir).writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _newest(changes: DataFrame) -> DataFrame:
    """The newest row of every order: that folded from most of its events."""
    newest = changes.groupBy("order_id").agg(F.max_by(
        F.struct(*[c for c in [*OUT_COLS, "n_events"] if c != "order_id"]), "n_events").alias("o"))
    return newest.select("order_id", "o.*").select(*OUT_COLS, "n_events")


def current_orders(spark, table_root: str) -> DataFrame | None:
    """One row per order (None: nothing is stored yet)."""
    changes = _stored(spark, f"{table_root}/changes")
    return None if changes is None else _newest(changes).select(*OUT_COLS)


def compact(spark, table_root: str) -> None:
    """Put the folders of all batches together, one file per part, and keep one row per
    order of the changes. Run it while no stream writes to ``table_root``. The folders
    it has read go last; if it is killed before, rows stand twice for a while, which
    changes no order."""
    for store in STORES:
        root = f"{table_root}/{store}"
        folders = _subfolders(spark, root)
        if len(folders) < 2:
            continue
        rows = _stored(spark, root)
        key = "svix_id" if store == "deliveries" else "order_id"
        if rows is not None:
            if store == "changes":
                rows = _newest(rows)
            elif store == "repeats":
                rows = rows.groupBy("svix_id", "order_id").agg(F.min("first_seq").alias("first_seq"))
            else:
                rows = rows.distinct() if store == "deliveries" else rows
            last = max((int(f.rsplit("=", 1)[1]) for f in _subfolders(spark, root, committed=False) if "/run=base/" in f), default=0)
            _write(rows.withColumn("bucket", _bucket(key)), f"{root}/run=base/batch={last + 1:012d}")
        for f in folders:
            fs, p = _fs(spark, f)
            fs.delete(p, True)
