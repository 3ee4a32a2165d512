"""The nightly load as Spark jobs: landed feeds -> parsers -> keyed merges ->
a new immutable version of each warehouse table, one isolated step per feed
(I01, I02, I07, K01, K02, K05, K08, K09). Ten feeds; one whose landing folder does not
exist is left out.

Tables live under ``root/<table>/v=<n>``; a version is visible once its
``_SUCCESS`` marker exists, so a failed or killed run leaves the previous
version in place and a rerun simply writes the next one. A version of the receipt
tables holds only the business periods it touches: a period is read from the newest
version that has it, and the files of all others stay where they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.functions.semantics import business_date, nonempty
from hearth.operators.incremental import incremental_window, rolling_window, run_steps
from hearth.operators.merge import advance_watermark, insert_new, new_files, upsert, write_version
from hearth.operators.staff import merge_staff_names, staff_names
from hearth.plans.joins import broadcast_if_small
from hearth.session import ensure_checkpoint_dir
from hearth.sources.feeds import (classify_files, csv_headers, file_digests, fold_shifts, labour_breakdown, labour_daily_rows,
                                  map_items, merge_order_lines, normalise_bookings, parse_cashoff, parse_manager_report,
                                  parse_overview, parse_receipts, parse_reviews, read_labour, scan_csv, split_receipts)
from hearth.sources.periods import DATE, GRAINS, PERIOD, choose_grain, with_period
from hearth.streaming.orders import OUT_COLS, current_orders, run_order_stream

RECEIPT_KEY = ["business_location_id", "account_reference"]
KEYS = {"sales": RECEIPT_KEY, "sales_lines": RECEIPT_KEY + ["line_id"],
        "payments": RECEIPT_KEY + ["payment_uuid"], "sentiment_reviews": ["review_hash"],
        "storekit_orders": ["order_id"], "ingest_state": ["business_location_id", "resource"],
        "items": ["business_location_id", "item_id"], "staff_shifts": ["business_location_id", "shift_uuid"],
        "nory_labour_daily": ["branch_id", "biz_date"], "nory_labour_breakdown": ["branch_id", "biz_date", "category"],
        "bookings": ["ft_site_code", "booking_ref_no"], "cashoff_daily": ["site", "business_date"],
        "manager_daily_report": ["site", "business_date"], "peazi_order_lines": ["site", "order_number", "plu"],
        "sentiment_overview": ["sentiment_label", "period_start", "grain"]}

# Days that a rolling re-pull (I02) reads again.
ROLLING_DAYS = {"shifts": 30, "bookings": 14, "market": 7}

MARKET_SCHEMA = ("site string, order_number string, plu int, seq long, order_time timestamp, name string, quantity decimal(14,3), "
                 "price decimal(14,2), total decimal(14,2), discount_amount decimal(14,2), tip decimal(14,2), charge decimal(14,2), "
                 "commission decimal(14,2), payout decimal(14,2), payment_method string, reporting_labels array<string>")


class VersionedTables:
    """Latest committed version of each table under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _folders(self, name: str, committed: bool) -> list[int]:
        p = self._Path(f"{self.root}/{name}")
        fs = p.getFileSystem(self._conf)
        if not fs.exists(p):
            return []
        found = [st.getPath() for st in fs.listStatus(p) if st.getPath().getName().startswith("v=")]
        return sorted(int(f.getName()[2:]) for f in found if not committed or fs.exists(self._Path(f, "_SUCCESS")))

    def versions(self, name: str) -> list[int]:
        """Committed versions."""
        return self._folders(name, committed=True)

    def period_paths(self, name: str) -> dict[str, str]:
        """Period -> the folder that holds it now: that of the newest version with the
        period (an empty folder: no row of it is left)."""
        out = {}
        for v in self.versions(name):
            p = self._Path(f"{self.root}/{name}/v={v}")
            for st in p.getFileSystem(self._conf).listStatus(p):
                key, _, period = st.getPath().getName().partition("=")
                if key == PERIOD:
                    out[period] = st.getPath().toString()
        return out

    def current(self, name: str, periods: list[str] | None = None) -> DataFrame | None:
        """The table (of one stored by periods, only ``periods`` if given); None: no rows."""
        v = self.versions(name)
        if not v:
            return None
        held = self.period_paths(name)
        if not held:
            return self.spark.read.parquet(f"{self.root}/{name}/v={v[-1]}")
        paths = [p for k, p in held.items() if (periods is None or k in periods) and
                 any(not s.getPath().getName().startswith("_") for s in self._Path(p).getFileSystem(self._conf).listStatus(self._Path(p)))]
        if not paths:
            return None
        fields = self.spark.read.parquet(paths[-1]).schema.fields
        schema = T.StructType([*fields, T.StructField(PERIOD, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths).drop("v")

    def grain(self, name: str) -> str | None:
        """Grain of a table's periods (None: it has none yet)."""
        size = next((len(p) for p in self.period_paths(name) if p[:4].isdigit()), None)
        return next((g for g, (n, _) in GRAINS.items() if n == size), None)

    def commit(self, name: str, df: DataFrame) -> int:
        nxt = self._next(name)
        write_version(df, f"{self.root}/{name}", nxt)
        return nxt

    def _next(self, name: str) -> int:
        # a killed run may have left a folder without its marker: its number is
        # spent, the rerun takes the one after it
        return max(self._folders(name, committed=False), default=0) + 1

    def commit_periods(self, name: str, df: DataFrame, touched: list[str]) -> int:
        """A version of the ``touched`` periods alone: ``df`` holds all their rows. A
        period that has lost its last row gets an empty folder."""
        nxt = self._next(name)
        for period in touched:
            p = self._Path(f"{self.root}/{name}/v={nxt}/{PERIOD}={period}")
            p.getFileSystem(self._conf).mkdirs(p)
        write_version(df, f"{self.root}/{name}", nxt, partition_by=(PERIOD,), mode="append")
        return nxt


def arrived(landed: DataFrame) -> DataFrame:
    """``landed`` (rows read from files) with ``_arrival``: the file's modification
    time, its name, and the row's place in it. Spark packs files into tasks by
    size, so a row number alone would not follow the order of arrival."""
    m = "_metadata."
    return landed.select("*", F.struct(
        F.col(m + "file_modification_time").alias("t"), F.col(m + "file_path").alias("f"),
        F.col(m + "file_block_start").alias("b"), F.monotonically_increasing_id().alias("r")).alias("_arrival"))


def _merge(tables: VersionedTables, name: str, batch: DataFrame, insert_only: bool = False) -> int:
    """K01 (or K02) of a batch into the current version; between duplicates inside
    the batch its ``_arrival`` decides (of equal ones, such as the lines of one
    receipt, the last or first row)."""
    cur = tables.current(name)
    columns = [c for c in batch.columns if c != "_arrival"]
    if cur is None:
        cur = batch.select(*columns).limit(0)
    ordinal = "_arrival" if "_arrival" in batch.columns else None
    merged = (insert_new(cur, batch, KEYS[name], ordinal=ordinal) if insert_only
              else upsert(cur, batch, KEYS[name], ordinal=ordinal))
    return tables.commit(name, merged.select(*columns))


def merge_periods(tables: VersionedTables, name: str, batch: DataFrame) -> int | None:
    """K01 of a batch (with ``DATE`` and ``PERIOD``) into a table stored by periods. Read
    and rewritten are the periods of the batch's rows and those where rows of the same
    keys stand now (a corrected receipt may change its day); to find these, only the
    key columns of the table are read. None: the batch has no rows."""
    keys = KEYS[name]
    touched = {r[0] for r in batch.select(PERIOD).distinct().collect()}
    if not touched:
        return None
    table = tables.current(name)
    if table is not None:
        own = broadcast_if_small(batch.select(*keys).distinct())
        touched |= {r[0] for r in table.select(*keys, PERIOD).join(own, keys, "left_semi").select(PERIOD).distinct().collect()}
    columns = [c for c in batch.columns if c != "_arrival"]
    cur = tables.current(name, sorted(touched))
    cur = batch.select(*columns).limit(0) if cur is None else cur
    merged = upsert(cur, batch, keys, ordinal="_arrival" if "_arrival" in batch.columns else None)
    return tables.commit_periods(name, merged.select(*columns), sorted(touched))


def _bytes(spark: SparkSession, folder: str) -> int:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _has_days(spark: SparkSession, folder: str) -> bool:
    """Whether a landing folder is dealt into ``day=<date>`` folders."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(st.getPath().getName().startswith("day=") for st in fs.listStatus(p))


def _exists(spark: SparkSession, folder: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def landed(spark: SparkSession, folder: str, schema: str, since=None) -> DataFrame:
    """JSON rows of a landing folder. Of one dealt into ``day=`` folders only the days
    from ``since`` on are read, if given, and ``day`` is a column."""
    if not _has_days(spark, folder):
        return spark.read.schema(schema).json(folder)
    rows = spark.read.schema(schema + ", day date").json(folder)
    return rows if since is None else rows.filter(F.col("day") >= since)


def landed_sheets(spark: SparkSession, folder: str) -> list[tuple[list[str], DataFrame]]:
    """(header, rows ``site, ordinal, cells``) for every distinct header of the sheets that
    landed as JSON rows, where row 0 of a sheet is its header (``site`` is NULL where one
    sheet holds all). A sheet is pulled whole, so of several ``day=`` folders the newest
    with the sheet counts. Sheets are as many as sites."""
    rows = landed(spark, folder, "site string, ordinal long, cells array<string>")
    rows = rows.withColumn("site", F.coalesce("site", F.lit("")))
    if "day" in rows.columns:
        newest = rows.groupBy("site").agg(F.max("day").alias("day"))
        rows = rows.join(newest, ["site", "day"], "left_semi").drop("day")
    sheets: dict[tuple, list[str]] = {}
    for r in rows.filter("ordinal = 0").select("site", "cells").distinct().orderBy("site").collect():
        sheets.setdefault(tuple(r.cells), []).append(r.site)
    return [(list(header), rows.filter(F.col("site").isin(sites) & (F.col("ordinal") > 0))) for header, sites in sheets.items()]


def merge_dated(tables: VersionedTables, name: str, batch: DataFrame, date, folder: str, grain: str | None = None) -> int | None:
    """``merge_periods`` of a batch by the date in column ``date``: the table is stored by
    its periods, whose grain is chosen from the bytes of a day at the first load (unless
    ``grain`` is given) and kept. The batch is parsed once."""
    ensure_checkpoint_dir(tables.spark)
    batch = batch.withColumn(DATE, F.col(date).cast("date")).checkpoint()
    kept = tables.grain(name) or grain
    if kept is None:
        first, last = batch.agg(F.min(DATE), F.max(DATE)).first()
        kept = choose_grain(_bytes(tables.spark, folder), (last - first).days + 1 if first else 1)
    return merge_periods(tables, name, with_period(batch, kept))


def landed_receipts(spark: SparkSession, folder: str, windows: DataFrame | None) -> DataFrame:
    """Landed receipt payloads. With ``windows`` (I01, per site) only the ``day=`` folders
    from the earliest window on are read (of a folder without days all files); the
    exact cut per site comes after the parse (``in_receipt_window``)."""
    since = None if windows is None else windows.agg(F.min("window_from")).first()[0]
    return landed(spark, folder, "business_location_id long, doc string",
                  None if since is None else F.date_sub(F.lit(since).cast("date"), 1))


def in_receipt_window(parsed: DataFrame, windows: DataFrame) -> DataFrame:
    """Parsed receipts that were closed inside their site's window; those without a close
    time stay, as no window can tell them."""
    closed = F.try_to_timestamp(F.coalesce(nonempty(F.col("r.timeClosed")), F.col("r.timeofCloseAndPaid")))
    j = parsed.join(broadcast_if_small(windows), "business_location_id", "left")
    return j.filter(closed.isNull() | F.col("window_from").isNull() | closed.between(F.col("window_from"), F.col("window_to"))).select(
        *parsed.columns)


def nightly(spark: SparkSession, landing: str, root: str, now=None, grain: str | None = None,
            registry: dict[str, DataFrame] | None = None):
    """Run every feed step; returns (status DataFrame, all_ok). ``now``, the time of the
    run, turns on the windows: a site's receipts are pulled anew from 48 hours before
    its watermark (I01; a site without one: the backfill). Without it all that has
    landed is read. Shifts, bookings and market lines are pulled anew for the last
    ``ROLLING_DAYS`` days (I02); a ``day=`` folder of theirs holds the rows of that day,
    whole orders, as last pulled. ``grain`` of the tables' periods: chosen from the bytes
    of a day at the first load, and kept. ``registry``: the ``sites`` that manager forms
    may name and the ``ft_site_map`` of bookings; else the tables of these names."""
    t = VersionedTables(spark, root)

    def feed(name):
        """Folder of a feed (None: it is not set up)."""
        return f"{landing}/{name}" if _exists(spark, f"{landing}/{name}") else None

    def known(name):
        df = (registry or {}).get(name)
        df = t.current(name) if df is None else df
        if df is None:
            raise ValueError(f"no {name} known")
        return df

    def since(name):
        return None if now is None else rolling_window(now, ROLLING_DAYS[name])[0]

    def in_rolling(name, df, day):
        """Rows of the feed's window, and those without a date, as no window can tell them."""
        return df if now is None else df.filter(day.isNull() | day.between(*rolling_window(now, ROLLING_DAYS[name])))

    def items():
        if folder := feed("items"):
            pages = arrived(spark.read.schema("business_location_id long, doc string").json(folder))
            _merge(t, "items", map_items(pages, keep=("_arrival",)).filter("item_id IS NOT NULL"))

    def shifts():
        if folder := feed("shifts"):
            docs = arrived(landed(spark, folder, "business_location_id long, doc string", since("shifts")))
            rows = in_rolling("shifts", fold_shifts(docs, keep=("_arrival",)), F.col("date_in_utc").cast("date"))
            merge_dated(t, "staff_shifts", rows, "date_in_utc", folder, grain)

    def labour():
        # each file carries its site's last weeks, so the newest folder heals them all
        if folder := feed("labour"):
            ensure_checkpoint_dir(spark)
            records = read_labour(spark, folder, "latest").withColumn("_arrival", F.struct("folder", "_path")).checkpoint()
            merge_dated(t, "nory_labour_daily", labour_daily_rows(records, keep=("_arrival",)), "biz_date", folder, grain)
            merge_dated(t, "nory_labour_breakdown", labour_breakdown(records, keep=("_arrival",)), "biz_date", folder, grain)

    def bookings():
        if folder := feed("bookings"):
            rows = landed(spark, folder, "site_code long, the_date date, doc string", since("bookings"))
            docs = arrived(in_rolling("bookings", rows, F.col("the_date")))
            merge_dated(t, "bookings", normalise_bookings(docs, known("ft_site_map"), keep=("_arrival",)), "booking_date", folder, grain)

    def cashoff():
        if folder := feed("cashoff"):
            parts = [parse_cashoff(rows, header) for header, rows in landed_sheets(spark, folder)]
            if parts:
                merge_dated(t, "cashoff_daily", reduce(DataFrame.unionByName, parts), DATE, folder, grain)

    def manager_report():
        if folder := feed("manager_report"):
            sites = known("sites")
            parts = [parse_manager_report(rows, header, sites) for header, rows in landed_sheets(spark, folder)]
            if parts:
                merge_dated(t, "manager_daily_report", reduce(DataFrame.unionByName, parts), DATE, folder, grain)

    def market():
        if folder := feed("market"):
            merge_dated(t, "peazi_order_lines", merge_order_lines(landed(spark, folder, MARKET_SCHEMA, since("market"))), "order_time", folder, grain)

    def receipts():
        state = t.current("ingest_state")
        windows = None
        if now is not None and state is not None:
            windows = incremental_window(state.filter("resource = 'sales'"), state.select("business_location_id").distinct(), now)
        docs = arrived(landed_receipts(spark, f"{landing}/receipts", windows))
        # four tables come from one parse, kept in the shared folder meanwhile
        ensure_checkpoint_dir(spark)
        parsed = parse_receipts(docs)
        parsed = (parsed if windows is None else in_receipt_window(parsed, windows)).checkpoint()
        sales, lines, pays = split_receipts(docs, parsed=parsed)
        sales = sales.withColumn(DATE, business_date("time_closed"))
        span = sales.agg(F.min(DATE), F.max(DATE), F.count(F.lit(1))).first()
        if span[2] == 0:
            return
        chosen = t.grain("sales") or grain or choose_grain(
            _bytes(spark, f"{landing}/receipts"), (span[1] - span[0]).days + 1 if span[0] else 1)
        sales = with_period(sales, chosen)
        # a receipt that lands twice has one date: that of its last arrival
        dates = sales.groupBy(*RECEIPT_KEY).agg(F.max_by(F.struct(DATE, PERIOD), "_arrival").alias("_d")).select(
            *RECEIPT_KEY, "_d.*")
        merge_periods(t, "sales", sales)
        merge_periods(t, "sales_lines", lines.join(dates, RECEIPT_KEY))
        merge_periods(t, "payments", pays.join(dates, RECEIPT_KEY))
        names = staff_names(sales, lines)
        stored = t.current("staff_names")
        t.commit("staff_names", names if stored is None else merge_staff_names(stored, names))
        seen = (sales.groupBy("business_location_id").agg(F.max("time_closed").alias("last_watermark"))
                     .withColumn("resource", F.lit("sales")))
        if state is None:
            state = seen.limit(0)
        t.commit("ingest_state", advance_watermark(state, seen))

    def reviews():
        ensure_checkpoint_dir(spark)
        # Only files whose name and content the log does not have yet
        files = file_digests(spark, f"{landing}/reviews", "*.csv")
        log = t.current("file_log")
        todo = files if log is None else new_files(files, log)
        todo = todo.checkpoint()
        paths = [r.path for r in todo.select("path").orderBy("path").collect()]
        if not paths:
            return
        headers = spark.createDataFrame([(f, h) for h, fs in csv_headers(spark, paths) for f in fs], "path string, header array<string>")
        kinds: dict[str, list[str]] = {}
        for r in classify_files(headers).orderBy("path").collect():     # a row per new file
            kinds.setdefault(r.kind, []).append(r.path)
        if "reviews" in kinds:
            _merge(t, "sentiment_reviews", parse_reviews(scan_csv(spark, kinds["reviews"])), insert_only=True)
        if "overview" in kinds:     # of two files of one period the later name counts
            overview = parse_overview(scan_csv(spark, kinds["overview"]))
            _merge(t, "sentiment_overview", overview.withColumn("_arrival", F.col("source_file")))
        done = todo.select("filename", "sha256").distinct()
        t.commit("file_log", done if log is None else log.unionByName(done))

    def online_orders():
        # the stream reads each landed file once and folds the orders it touches
        store = f"{root.rstrip('/')}/_orders"
        run_order_stream(spark, f"{landing}/webhooks", store, f"{store}/_checkpoint")
        orders = current_orders(spark, store)
        if orders is not None:
            _merge(t, "storekit_orders", orders.select(*OUT_COLS))

    return run_steps([("items", items), ("receipts", receipts), ("shifts", shifts), ("labour", labour), ("bookings", bookings),
                      ("cashoff", cashoff), ("manager_report", manager_report), ("market", market), ("reviews", reviews),
                      ("online_orders", online_orders)], spark)
