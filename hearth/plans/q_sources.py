"""Registered queries: feed parsers (S01-S05, S10, S12, S21, S25) and keyed
merges over warehouse tables (K01-K07, K11) and incremental windows (I01-I04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import merge as K
from hearth.plans import oracle as O
from hearth.plans.catalog import Ctx, dbl, register
from hearth.sources import feeds as FE

SALES_COLS = ["business_location_id", "account_reference", "receipt_id", "time_opening", "time_closed", "cancelled",
              "dine_in", "nb_covers", "table_name", "owner_name", "device_name", "p_owner_id"]
LINE_TEXT = ["business_location_id", "account_reference", "line_id", "sku", "name", "accounting_group_id",
             "accounting_group_name", "revenue_center", "time_of_sale", "p_staff_name", "p_staff_id",
             "p_void_reason", "p_discount_name"]
LINE_NUM = ["quantity", "net_with_tax", "net_without_tax", "menu_list_price", "unit_cost_price", "tax_amount",
            "discount_amount"]
PAY_TEXT = ["business_location_id", "account_reference", "payment_uuid", "code", "description", "payment_method_id",
            "type"]
PAY_NUM = ["net_with_tax", "tip", "surcharge"]


def _split(c: Ctx):
    return FE.split_receipts(c.w.receipt_docs)


def _num_sql(cols):
    return ", ".join(f"CAST({x} AS DOUBLE) AS {x}" for x in cols)


@register("s01_receipt_headers", f"SELECT {', '.join(SALES_COLS)} FROM sales")
def s01(c: Ctx):
    return _split(c)[0].select(*SALES_COLS)


@register("s02_receipt_lines", f"SELECT {', '.join(LINE_TEXT)}, {_num_sql(LINE_NUM)} FROM sales_lines")
def s02(c: Ctx):
    return _split(c)[1].select(*LINE_TEXT, *dbl(*LINE_NUM))


@register("s03_payments", f"SELECT {', '.join(PAY_TEXT)}, {_num_sql(PAY_NUM)} FROM payments")
def s03(c: Ctx):
    return _split(c)[2].select(*PAY_TEXT, *dbl(*PAY_NUM))


@register("s05_fold_shifts", """
SELECT business_location_id, shift_uuid, staff_id, clock_in, clock_out, date_in_utc
FROM staff_shifts WHERE CAST(shift_uuid AS BIGINT) % 41 <> 0""")
def s05(c: Ctx):
    return FE.fold_shifts(c.w.shift_docs)


BOOK_COLS = ["ft_site_code", "booking_ref_no", "booking_code", "business_location_id", "site_name", "booking_date",
             "booking_time_secs", "duration_mins", "guest_count", "status_code", "status", "sale_channel_code",
             "sale_channel", "interface_type_code", "interface_type", "table_no", "is_reward_member", "visits",
             "created_on"]


@register("s10_normalise_bookings", f"""
SELECT {', '.join(BOOK_COLS)}, CAST(total_amount AS DOUBLE) AS total_amount, CAST(deposit AS DOUBLE) AS deposit
FROM bookings""")
def s10(c: Ctx):
    b = FE.normalise_bookings(c.w.booking_docs, c.w.ft_site_map)
    return b.select(*BOOK_COLS, *dbl("total_amount", "deposit"))


@register("s12_merge_order_lines", """
SELECT site, order_number, plu, order_time, name, CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price,
       CAST(total AS DOUBLE) AS total, CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(tip AS DOUBLE) AS tip,
       CAST(charge AS DOUBLE) AS charge, CAST(commission AS DOUBLE) AS commission, CAST(payout AS DOUBLE) AS payout,
       payment_method, reporting_labels
FROM peazi_order_lines""")
def s12(c: Ctx):
    m = FE.merge_order_lines(c.w.market_lines_raw)
    return m.select("site", "order_number", "plu", "order_time", "name",
                    *dbl("quantity", "price", "total", "discount_amount", "tip", "charge", "commission", "payout"),
                    "payment_method", "reporting_labels")


@register("s21_review_hash", """
SELECT review_hash, sentiment_label, source, review_date, CAST(rating AS DOUBLE) AS rating, reviewer,
       length(review_text) AS text_len
FROM sentiment_reviews""")
def s21(c: Ctx):
    r = c.w.sentiment_reviews
    return r.select("review_hash", "sentiment_label", "source", "review_date", *dbl("rating"), "reviewer",
                    F.length("review_text").alias("text_len"))


ITEM_COLS = ["business_location_id", "item_id", "sku", "name", "docket_name", "accounting_group_name", "item_type",
             "active"]


@register("s04_map_items", f"SELECT {', '.join(ITEM_COLS)}, CAST(cost_price AS DOUBLE) AS cost_price FROM items")
def s04(c: Ctx):
    """S04 + S07: catalogue pages in every wrapper shape -> item rows."""
    return FE.map_items(c.w.item_pages).select(*ITEM_COLS, *dbl("cost_price"))


@register("s06_flatten_locations", "SELECT business_location_id, nickname AS business_name, nickname FROM sites")
def s06(c: Ctx):
    return FE.flatten_locations(c.w.business_docs, ["1"]).select("business_location_id", "business_name", "nickname")


CASHOFF_HEADER = ["Date", "Total Sales", "Card machine total", "Online Orders", "Uber Eats", "Just Eat", "Deliveroo",
                  "Petty cash / expenses", "Expected cash", "Actual cash", "Card tips", "Cash tips", "Service charge",
                  "Covers"]
_CO_NUM = ["total_sales", "card_sales", "online_orders", "uber_eats", "just_eat", "deliveroo", "petty_cash",
           "expected_cash", "actual_cash", "card_tips", "cash_tips", "service_charge", "covers"]


@register("s16_parse_cashoff", f"SELECT site, business_date, {_num_sql(_CO_NUM)} FROM cashoff_daily")
def s16(c: Ctx):
    return FE.parse_cashoff(c.w.cashoff_sheet, CASHOFF_HEADER).select("site", "business_date", *dbl(*_CO_NUM))


MANAGER_HEADER = ["Timestamp", "What site are you reporting on?", "Date of Shift", "Manager Name",
                  "Highlights / achievements", "Any critical stockouts?", "Describe the equipment issue",
                  "Any notable comments from customers?", "Number of incidents / accidents", "Any further comments?"]
_MR_COLS = ["site", "business_date", "manager_name", "positive_highlights", "stockout_detail", "equipment_detail",
            "customer_comments", "incidents", "further_comments"]


@register("s17_parse_manager_report", f"""
SELECT {', '.join(_MR_COLS)}, CAST(business_date AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 15 MINUTE AS submitted_at
FROM manager_daily_report""")
def s17(c: Ctx):
    return FE.parse_manager_report(c.w.manager_sheet, MANAGER_HEADER, c.w.sites).select(*_MR_COLS, "submitted_at")


@register("s21_parse_review_files", """
SELECT review_hash, sentiment_label, source, review_date, CAST(rating AS DOUBLE) AS rating, reviewer,
       length(review_text) AS text_len
FROM sentiment_reviews""")
def s21f(c: Ctx):
    """S18 + S21: review rows landed as CSV files (Business, Source, Date, Rating,
    Text, User), scanned recursively and parsed back into hashed reviews."""
    r = c.w.sentiment_reviews
    rows = r.select(F.col("sentiment_label").alias("Business"), F.col("source").alias("Source"),
                    F.date_format("review_date", "yyyy-MM-dd").alias("Date"),
                    F.col("rating").cast("string").alias("Rating"), F.col("review_text").alias("Text"),
                    F.col("reviewer").alias("User"))
    path = c.w.landed_csv("reviews", rows)
    p = FE.parse_reviews(FE.scan_csv(c.spark, path))
    return p.select("review_hash", "sentiment_label", "source", "review_date", *dbl("rating"), "reviewer",
                    F.length("review_text").alias("text_len"))


@register("s18_csv_mixed_headers", """
SELECT review_hash, sentiment_label, source, review_date, CAST(rating AS DOUBLE) AS rating, reviewer,
       length(review_text) AS text_len
FROM sentiment_reviews""")
def s18(c: Ctx):
    """Review files whose columns stand in two different orders, one of them
    with a column more, read by their own headers."""
    r = c.w.sentiment_reviews
    rows = r.select(F.col("sentiment_label").alias("Business"), F.col("source").alias("Source"),
                    F.date_format("review_date", "yyyy-MM-dd").alias("Date"),
                    F.col("rating").cast("string").alias("Rating"), F.col("review_text").alias("Text"),
                    F.col("reviewer").alias("User"))
    later = F.col("Date") >= "2024-02-01"
    c.w.landed_csv("reviews_mixed/early", rows.filter(~later))
    path = c.w.landed_csv("reviews_mixed/late", rows.filter(later).select("Text", "User", F.lit("x").alias("Extra"), "Date", "Rating",
                                                                         "Business", "Source"))
    p = FE.parse_reviews(FE.scan_csv(c.spark, path.rsplit("/", 1)[0]))
    return p.select("review_hash", "sentiment_label", "source", "review_date", *dbl("rating"), "reviewer",
                    F.length("review_text").alias("text_len"))


@register("s09_labour_breakdown", """
SELECT branch_id, biz_date, category, CAST(value AS DOUBLE) AS value, CAST(planned_value AS DOUBLE) AS planned_value
FROM nory_labour_breakdown""")
def s09(c: Ctx):
    """Daily labour records with both breakdown arrays, every planned name
    given twice (the last one counts)."""
    entry = lambda v: F.struct(F.col("category").alias("name"), F.col(v).cast("string").alias("value"))
    rec = c.w.nory_labour_breakdown.groupBy("branch_id", F.col("biz_date").cast("string").alias("date")).agg(
        F.collect_list(entry("value")).alias("breakdown"), F.collect_list(entry("planned_value")).alias("planned"))
    stale = F.transform("planned", lambda p: F.struct(p["name"].alias("name"), F.lit("-1").alias("value")))
    rec = rec.select("branch_id", "date", "breakdown", F.concat(stale, "planned").alias("planned_breakdown"))
    return FE.labour_breakdown(rec).select("branch_id", "biz_date", "category", *dbl("value", "planned_value"))


OVERVIEW_INT = [name for name, whole in FE.OVERVIEW_MAP.values() if whole]
OVERVIEW_NUM = [name for name, whole in FE.OVERVIEW_MAP.values() if not whole]


@register("s22_parse_overview", f"""
SELECT sentiment_label, period_start, grain, {', '.join(OVERVIEW_INT)}, {_num_sql(OVERVIEW_NUM)},
       'overview' AS kind FROM sentiment_overview""")
def s22(c: Ctx):
    """Overview files of both grains, named by their period (a month as
    MONYY, a day as an ISO date), among review files. Files are told apart by their
    header, and those of overviews are read by it."""
    o = c.w.sentiment_overview
    named = F.when(F.col("grain") == "month", F.upper(F.date_format("period_start", "MMMyy"))).otherwise(
        F.concat(F.lit("Overview_"), F.date_format("period_start", "yyyy-MM-dd")))
    cells = [F.col(name).cast("string").alias(header) for header, (name, _) in FE.OVERVIEW_MAP.items()]
    path = c.w.landed_csv_files("overview", o.select(F.col("sentiment_label").alias("Label"), *cells, F.concat(named, F.lit(".csv")).alias("file")))
    files = c.spark.createDataFrame([(f, h) for h, fs in FE.csv_headers(c.spark, path) for f in fs], "path string, header array<string>")
    kinds = FE.classify_files(files).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"), "kind")
    p = FE.parse_overview(FE.scan_csv(c.spark, path)).join(kinds, "source_file")
    return p.select("sentiment_label", "period_start", "grain", *OVERVIEW_INT, *dbl(*OVERVIEW_NUM), "kind")


LABOUR_NUM = ["col", "planned_col", "hours", "planned_hours", "sales", "percentage", "planned_percentage", "splh", "oplh"]


@register("s08_labour_files", f"""
SELECT branch_id, biz_date, {_num_sql(LABOUR_NUM)}, orders, lower(replace(site_name, ' ', '-')) AS site_name
FROM nory_labour_daily WHERE branch_id IN (SELECT branch_id FROM nory_site_map WHERE is_core)""")
def s08(c: Ctx):
    """Labour files in folders by the date they were taken (here the first day of
    the next month) and by site, all read in one pass; only core sites' folders."""
    d = c.w.nory_labour_daily
    slug = lambda n: F.lower(F.replace(n, F.lit(" "), F.lit("-")))
    taken = F.date_format(F.add_months(F.trunc("biz_date", "month"), 1), "yyyy-MM-dd")
    fields = ["branch_id", F.col("biz_date").cast("string").alias("date"), *[F.col(x).cast("string").alias(x) for x in LABOUR_NUM],
              F.col("orders").cast("string").alias("orders")]
    file = F.concat_ws("/", taken, slug("site_name"), F.lit("wfm/labour_insights.json"))
    path = c.w.landed_text_files("labour", d.groupBy(file.alias("file")).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("value")))
    # the registry of sites: configuration, a row per branch
    core = [r[0] for r in c.w.nory_site_map.filter("is_core").select(slug("site_name")).collect()]
    r = FE.labour_daily_rows(FE.read_labour(c.spark, path, "all", core))
    return r.select("branch_id", "biz_date", *dbl(*LABOUR_NUM), "orders", "site_name")


# one file per label and day; of the files of every third day the log knows other content,
# of those of the days after them nothing
O.TABLES["overview_files"] = """
  SELECT label || '_' || CAST(day AS VARCHAR) || '.txt' AS filename, CAST(day(day) AS INTEGER) % 3 AS known, sha256(line || chr(10)) AS sha256
  FROM (SELECT replace(sentiment_label, ' ', '-') AS label, period_start AS day,
               concat_ws(',', sentiment_label, period_start, reviews, star5, star4, star3, star2, star1) AS line
        FROM sentiment_overview WHERE grain = 'day')"""


@register("k08_new_files", "SELECT filename, sha256 FROM overview_files WHERE known <> 2")
def k08(c: Ctx):
    """Landed files whose name and content hash the load log does not have."""
    o = c.w.sentiment_overview.filter("grain = 'day'")
    name = F.concat(F.replace("sentiment_label", F.lit(" "), F.lit("-")), F.lit("_"), F.col("period_start").cast("string"), F.lit(".txt"))
    line = F.concat_ws(",", "sentiment_label", "period_start", "reviews", "star5", "star4", "star3", "star2", "star1")
    path = c.w.landed_text_files("overview_log", o.select(name.alias("file"), line.alias("value")))
    known = F.dayofmonth("period_start") % 3
    log = o.filter(known != 1).select(
        name.alias("filename"), F.when(known == 2, F.sha2(F.concat(line, F.lit("\n")), 256)).otherwise(F.sha2(line, 256)).alias("sha256"))
    return K.new_files(FE.file_digests(c.spark, path, "*.txt"), log).select("filename", "sha256")
