"""Registered queries: keyed merges (K01-K03, K05, K07, K10, K11) and
incremental windows (I01, I03, I04) over warehouse tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions.semantics import business_date
from hearth.operators import incremental as INC
from hearth.operators import merge as K
from hearth.plans import oracle as O
from hearth.plans.catalog import Ctx, dbl, register

CUTOFF = "2000-01-01 00:00:00"
NOW = "2000-01-15 00:00:00"
SALES_KEY = ["business_location_id", "account_reference"]
SALES_COLS = ["business_location_id", "account_reference", "receipt_id", "time_closed", "cancelled", "nb_covers",
              "table_name", "owner_name"]


def _state(c: Ctx):
    """Watermark per site: the newest close time before the cutoff; site 1004
    has never been loaded."""
    s = c.w.sales.filter(F.col("time_closed") < F.lit(CUTOFF).cast("timestamp"))
    return (s.filter(F.col("business_location_id") != 1004).groupBy("business_location_id")
             .agg(F.max("time_closed").alias("last_watermark")).withColumn("resource", F.lit("sales")))


O.TABLES["wm_state"] = f"""
  SELECT business_location_id, MAX(time_closed) AS last_watermark FROM sales
  WHERE time_closed < TIMESTAMP '{CUTOFF}' AND business_location_id <> 1004 GROUP BY 1"""

O.TABLES["pull_window"] = f"""
  SELECT s.business_location_id,
         greatest(COALESCE(w.last_watermark - INTERVAL 48 HOUR, TIMESTAMP '{NOW}' - INTERVAL 365 DAY),
                  TIMESTAMP '{NOW}' - INTERVAL 364 DAY) AS window_from,
         TIMESTAMP '{NOW}' AS window_to
  FROM sites s LEFT JOIN wm_state w ON w.business_location_id = s.business_location_id"""


def _windows(c: Ctx):
    return INC.incremental_window(_state(c), c.w.sites, NOW)


@register("i01_incremental_window", "SELECT business_location_id, window_from, window_to FROM pull_window")
def i01(c: Ctx):
    return _windows(c)


@register("i04_clamped_window", """
SELECT p.business_location_id, greatest(p.window_from, f.first_time) AS window_from, p.window_to
FROM pull_window p LEFT JOIN (SELECT business_location_id, MIN(time_closed) AS first_time FROM sales GROUP BY 1) f
  ON f.business_location_id = p.business_location_id""")
def i04(c: Ctx):
    first = c.w.sales.groupBy("business_location_id").agg(F.min("time_closed").alias("first_time"))
    return INC.incremental_window(_state(c), c.w.sites, NOW, first_seen=first)


@register("k01_upsert_repull", f"""
SELECT {', '.join(SALES_COLS)} FROM sales
WHERE time_closed < TIMESTAMP '{CUTOFF}'
   OR time_closed BETWEEN (SELECT MIN(window_from) FROM pull_window p WHERE p.business_location_id = sales.business_location_id)
                      AND TIMESTAMP '{NOW}'""")
def k01(c: Ctx):
    """Yesterday's table (rows before the cutoff, the overlap rows stale) merged
    with a re-pull of each site's window: the overlap is healed, new rows added."""
    s = c.w.sales.select(*SALES_COLS)
    cut = F.lit(CUTOFF).cast("timestamp")
    # rows of the last day before the cutoff at sites with a watermark went stale;
    # they sit inside the 48-hour overlap, so the re-pull must heal them
    overlap = (F.col("time_closed") >= cut - F.make_dt_interval(F.lit(0), F.lit(24))) & \
              (F.col("business_location_id") != 1004)
    current = s.filter(F.col("time_closed") < cut).withColumn(
        "owner_name", F.when(overlap, F.lit("STALE")).otherwise(F.col("owner_name")))
    incoming = INC.in_window(s, _windows(c))
    return K.upsert(current, incoming, SALES_KEY).select(*SALES_COLS)


@register("k02_insert_new_reviews", """
SELECT review_hash, sentiment_label, review_date,
       CAST(CASE WHEN day(review_date) % 2 = 1 THEN rating ELSE 0 END AS DOUBLE) AS rating
FROM sentiment_reviews""")
def k02(c: Ctx):
    """Existing reviews win: the stored odd-day reviews keep their rating; the
    incoming batch (every review, rating zeroed) only adds the missing ones."""
    r = c.w.sentiment_reviews.select("review_hash", "sentiment_label", "review_date", "rating")
    current = r.filter(F.dayofmonth("review_date") % 2 == 1)
    incoming = r.withColumn("rating", F.lit(0).cast("decimal(3,1)"))
    return K.insert_new(current, incoming, ["review_hash"]).select(
        "review_hash", "sentiment_label", "review_date", *dbl("rating"))


@register("k03_merge_sites", """
SELECT s.business_location_id,
       COALESCE(n.business_name, s.business_name) AS business_name,
       COALESCE(s.nickname, n.nickname) AS nickname
FROM (SELECT business_location_id, business_name,
             CASE WHEN business_location_id % 2 = 0 THEN NULL ELSE nickname END AS nickname FROM sites) s
FULL JOIN (SELECT business_location_id, lower(business_name) AS business_name, 'new ' || business_name AS nickname
           FROM sites) n ON n.business_location_id = s.business_location_id""")
def k03(c: Ctx):
    s = c.w.sites
    cur = s.withColumn("nickname", F.when(F.col("business_location_id") % 2 == 0, F.lit(None)).otherwise(F.col("nickname")))
    new = s.select("business_location_id", F.lower("business_name").alias("business_name"),
                   F.concat(F.lit("new "), F.col("business_name")).alias("nickname"), "active")
    return K.merge_sites(cur, new).select("business_location_id", "business_name", "nickname")


@register("k05_advance_watermark", """
SELECT COALESCE(w.business_location_id, b.business_location_id) AS business_location_id,
       greatest(w.last_watermark, b.last_watermark) AS last_watermark
FROM wm_state w FULL JOIN (SELECT business_location_id, MAX(time_closed) AS last_watermark FROM sales GROUP BY 1) b
  ON b.business_location_id = w.business_location_id""")
def k05(c: Ctx):
    batch = c.w.sales.groupBy("business_location_id").agg(F.max("time_closed").alias("last_watermark")) \
                     .withColumn("resource", F.lit("sales"))
    return K.advance_watermark(_state(c), batch).select("business_location_id", "last_watermark")


@register("k07_fill_location_ids", "SELECT ft_site_code, site_name, business_location_id, is_core FROM ft_site_map")
def k07(c: Ctx):
    return c.w.ft_site_map


@register("k10_relabel_and_delete", """
SELECT booking_ref_no, CASE WHEN booking_time_secs >= 79200 THEN site_name || ' (Late)' ELSE site_name END AS site_name,
       booking_date
FROM bookings WHERE COALESCE(status, '') <> 'Cancelled' OR guest_count <= 6""")
def k10(c: Ctx):
    """Split late-evening bookings onto their own reporting line (update) and
    remove large cancelled bookings (delete)."""
    b = c.w.bookings
    b = K.delete_where(b, (F.coalesce(F.col("status"), F.lit("")) == "Cancelled") & (F.col("guest_count") > 6))
    b = K.update_where(b, F.col("booking_time_secs") >= 79200,
                       {"site_name": F.concat(F.col("site_name"), F.lit(" (Late)"))})
    return b.select("booking_ref_no", "site_name", "booking_date")


@register("k11_key_violations", """
SELECT business_location_id, account_reference, split_part(line_id, '-', 1) AS line_no, COUNT(*) AS rows,
       'duplicate' AS kind
FROM sales_lines GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def k11(c: Ctx):
    """(receipt, line number) is not a key of the line table: report it."""
    l = c.w.sales_lines.withColumn("line_no", F.split("line_id", "-").getItem(0))
    return K.key_violations(l, ["business_location_id", "account_reference", "line_no"])


@register("i03_date_grid", f"""
SELECT s.business_location_id, CAST(g.d AS DATE) AS day
FROM (SELECT business_location_id, MIN({O.bdate('time_closed')}) AS f, MAX({O.bdate('time_closed')}) AS t
      FROM sales GROUP BY 1) s,
     LATERAL (SELECT unnest(generate_series(s.f, s.t, INTERVAL 1 DAY)) AS d) g""")
def i03(c: Ctx):
    d = business_date("time_closed")
    ranges = c.w.sales.groupBy("business_location_id").agg(F.min(d).alias("date_from"), F.max(d).alias("date_to"))
    return INC.date_grid(ranges)
