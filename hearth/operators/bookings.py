"""Bookings and cross-source day views.

Bookings are per-site facts; the site-day aggregations run before any join, and
the two FULL joins of V45 are on (site, date) keys of already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, iso_dow, not_cancelled, round_div
from hearth.plans.joins import broadcast_if_small


def _time_text(secs):
    s = secs % 86400
    return F.format_string("%02d:%02d:%02d", (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), (s % 60).cast("int"))


def bookings_view(bookings: DataFrame) -> DataFrame:
    """Calendar parts, channel (third-party -> its interface), flags.
    A NULL status is live (IS DISTINCT FROM 'Cancelled')."""
    b = bookings
    st = F.col("status")
    return b.select(
        "ft_site_code", "booking_ref_no", "booking_code", "business_location_id",
        F.col("site_name").alias("site"), "booking_date",
        F.to_date(F.date_trunc("month", "booking_date")).alias("booking_month"),
        F.date_format("booking_date", "EEEE").alias("day_of_week"),
        iso_dow("booking_date").alias("dow_iso"),
        _time_text(F.col("booking_time_secs")).alias("booking_time"),
        ((F.col("booking_time_secs") % 86400) / 3600).cast("int").alias("booking_hour"),
        "duration_mins", F.col("guest_count").alias("covers"), "status_code", "status",
        "sale_channel_code", "sale_channel", "interface_type",
        F.when(F.col("sale_channel_code") == 103, F.coalesce(F.col("interface_type"), F.lit("Third-party")))
         .otherwise(F.col("sale_channel")).alias("channel"),
        "table_no", "is_reward_member", "visits",
        (F.col("visits").isNotNull() & (F.col("visits") > 1)).alias("is_returning"),
        "total_amount", "deposit",
        st.isin("Show", "Complete").alias("showed"),
        (st == "NoShow").alias("is_noshow"),
        (st == "Cancelled").alias("is_cancelled"),
        (~st.eqNullSafe("Cancelled")).alias("is_live"),
    )


def bookings_site_day(v: DataFrame) -> DataFrame:
    """Counts, covers, channel mix, shown duration, no-show and cancel rates."""
    live, showed = F.col("is_live"), F.col("showed")
    cov = F.col("covers")
    cnt = lambda cond: F.count_if(F.coalesce(cond, F.lit(False)))
    csum = lambda cond: F.sum(F.when(cond, cov))
    return v.groupBy("site", "business_location_id", "booking_date").agg(
        F.first(iso_dow("booking_date")).alias("dow_iso"),
        F.count(F.lit(1)).alias("bookings"),
        cnt(live).alias("live_bookings"),
        F.sum(cov).alias("booked_covers"),
        csum(live).alias("live_covers"),
        csum(showed).alias("shown_covers"),
        cnt(F.col("is_noshow")).alias("noshow_bookings"),
        csum(F.col("is_noshow")).alias("noshow_covers"),
        cnt(F.col("is_cancelled")).alias("cancelled_bookings"),
        csum(F.col("is_cancelled")).alias("cancelled_covers"),
        cnt((F.col("channel") == "Web") & live).alias("web_bookings"),
        cnt((F.col("channel") == "Phone") & live).alias("phone_bookings"),
        cnt((F.col("channel") == "Walk-in") & live).alias("walkin_bookings"),
        cnt((F.col("sale_channel_code") == 103) & live).alias("thirdparty_bookings"),
        F.round(F.avg(F.when(showed, F.col("duration_mins").cast("decimal(10,0)"))), 0).alias("avg_duration_mins"),
        F.round(100.0 * csum(F.col("is_noshow")) / F.nullif(csum(live), F.lit(0)).cast("double"), 1)
         .alias("noshow_rate_pct"),
        F.round(100.0 * cnt(F.col("is_cancelled")) / F.count(F.lit(1)).cast("double"), 1).alias("cancel_rate_pct"),
    )


def unified_site_day(bk_day: DataFrame, sales: DataFrame, lines: DataFrame, ft_site_map: DataFrame,
                     sentiment_overview_v: DataFrame) -> DataFrame:
    """Bookings FULL JOIN (receipts FULL JOIN line revenue) per (site, day),
    plus the review day row. Revenue here is inc-VAT, dated by time of sale and
    includes cancelled receipts, as in the source. NULL locations never match."""
    rec = (sales.filter(not_cancelled() & F.col("time_closed").isNotNull())
           .groupBy("business_location_id", business_date("time_closed").alias("biz_date"))
           .agg(F.count(F.lit(1)).alias("receipts"), F.sum("nb_covers").alias("pos_covers")))
    rev = (lines.filter(F.col("time_of_sale").isNotNull())
           .groupBy("business_location_id", business_date("time_of_sale").alias("biz_date"))
           .agg(F.sum("net_with_tax").alias("revenue")))
    r, v = rec.alias("r"), rev.alias("v")
    sd = r.join(v, (F.col("r.business_location_id") == F.col("v.business_location_id"))
                & (F.col("r.biz_date") == F.col("v.biz_date")), "full_outer").select(
        F.coalesce("r.business_location_id", "v.business_location_id").alias("sd_bl"),
        F.coalesce("r.biz_date", "v.biz_date").alias("sd_date"), "receipts", "pos_covers", "revenue")
    bk = bk_day.alias("bk")
    j = bk.join(sd, (F.col("sd_bl") == F.col("bk.business_location_id"))
                & (F.col("sd_date") == F.col("bk.booking_date")), "full_outer")
    bl = F.coalesce(F.col("bk.business_location_id"), F.col("sd_bl"))
    day = F.coalesce(F.col("bk.booking_date"), F.col("sd_date"))
    j = j.withColumn("_bl", bl).withColumn("_day", day)
    dim = broadcast_if_small(ft_site_map.filter(F.col("business_location_id").isNotNull())
                             .select(F.col("business_location_id").alias("_dbl"), "site_name").distinct(), basis=ft_site_map)
    sen = (sentiment_overview_v.filter(F.col("grain") == "day")
           .select(F.col("business_location_id").alias("_sbl"), F.col("period_start").alias("_sday"),
                   "rating", "nps", "reviews"))
    j = (j.join(dim, F.col("_dbl") == F.col("_bl"), "left")
          .join(sen, (F.col("_sbl") == F.col("_bl")) & (F.col("_sday") == F.col("_day")), "left"))
    return j.select(
        F.col("_bl").alias("business_location_id"),
        F.coalesce(F.col("site_name"), F.col("bk.site")).alias("site"),
        F.col("_day").alias("biz_date"),
        "revenue", "pos_covers", "receipts",
        *[F.col(f"bk.{c}") for c in ("bookings", "live_bookings", "booked_covers", "live_covers", "shown_covers",
                                     "noshow_bookings", "noshow_covers", "cancelled_bookings", "noshow_rate_pct",
                                     "cancel_rate_pct", "web_bookings", "phone_bookings", "walkin_bookings",
                                     "thirdparty_bookings", "avg_duration_mins")],
        round_div(F.col("revenue"), F.col("bk.booked_covers"), 2).alias("spend_per_booked_cover"),
        round_div(F.col("revenue"), F.col("pos_covers"), 2).alias("spend_per_pos_cover"),
        F.round(100.0 * F.col("bk.live_covers") / F.nullif(F.col("pos_covers"), F.lit(0)).cast("double"), 1)
         .alias("booked_share_of_pos_pct"),
        "rating", "nps", "reviews",
    )


def booking_pace(bookings: DataFrame) -> DataFrame:
    """Covers booked ahead vs on the day, by booking creation date (typed
    column, else the payload's CreatedOn); a booking with neither counts in neither."""
    created = F.coalesce(F.col("created_on"), F.try_to_timestamp(F.get_json_object("raw", "$.CreatedOn")))
    b = bookings.select(
        F.col("site_name").alias("site"), "business_location_id", "booking_date",
        F.col("guest_count").alias("covers"), "status",
        (~F.col("status").eqNullSafe("Cancelled")).alias("is_live"),
        F.col("status").isin("Show", "Complete").alias("showed"),
        F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), created.cast("timestamp_ntz")))
         .alias("created_date"))
    live, cov = F.col("is_live"), F.col("covers")
    pre = live & (F.col("created_date") < F.col("booking_date"))
    same = live & (F.col("created_date") >= F.col("booking_date"))
    return b.groupBy("site", "business_location_id", F.col("booking_date").alias("biz_date")).agg(
        F.first(iso_dow("booking_date")).alias("dow_iso"),
        F.first(F.date_format("booking_date", "EEEE")).alias("day_of_week"),
        F.sum(F.when(pre, cov)).alias("prebooked_covers"),
        F.count_if(F.coalesce(pre, F.lit(False))).alias("prebooked_bookings"),
        F.sum(F.when(same, cov)).alias("sameday_covers"),
        F.count_if(F.coalesce(same, F.lit(False))).alias("sameday_bookings"),
        F.sum(F.when(live, cov)).alias("total_booked_covers"),
        F.sum(F.when(F.col("showed"), cov)).alias("shown_covers"),
        F.sum(F.when(F.col("status") == "NoShow", cov)).alias("noshow_covers"),
        F.round(100.0 * F.sum(F.when(pre, cov)) / F.nullif(F.sum(F.when(live, cov)), F.lit(0)).cast("double"), 1)
         .alias("prebook_pct"))


def booking_pace_dow(pace: DataFrame, as_of, window_days: int = 84) -> DataFrame:
    """Weekday profile over the ``window_days`` before ``as_of`` (today excluded)."""
    end = F.lit(as_of).cast("date")
    d = F.col("biz_date")
    r = pace.filter((d >= F.date_sub(end, window_days)) & (d < end))
    return r.groupBy("site", "dow_iso").agg(
        F.max("day_of_week").alias("day_of_week"),
        F.count(F.lit(1)).alias("days_sampled"),
        F.round(F.avg(F.col("prebooked_covers").cast("decimal(20,0)")), 0).alias("avg_prebooked_covers"),
        F.round(F.avg(F.col("sameday_covers").cast("decimal(20,0)")), 0).alias("avg_sameday_covers"),
        F.round(F.avg(F.col("total_booked_covers").cast("decimal(20,0)")), 0).alias("avg_total_covers"),
        F.round(F.avg(F.col("prebook_pct").cast("decimal(10,1)")), 1).alias("avg_prebook_pct"))


def cover_forecast(pace: DataFrame, profile: DataFrame, for_date, method: str = "uplift") -> DataFrame:
    """Expected covers for ``for_date`` from the weekday profile:
    ``uplift`` = prebooked + typical same-day covers; ``ratio`` = prebooked / typical
    pre-booked share."""
    day = pace.filter(F.col("biz_date") == F.lit(for_date).cast("date"))
    j = day.join(profile.select("site", "dow_iso", "avg_sameday_covers", "avg_prebook_pct"),
                 ["site", "dow_iso"], "left")
    pre = F.coalesce(F.col("prebooked_covers"), F.lit(0))
    if method == "ratio":
        exp = F.round(pre / F.nullif(F.col("avg_prebook_pct") / 100.0, F.lit(0.0)), 0)
    else:
        exp = pre + F.coalesce(F.col("avg_sameday_covers"), F.lit(0))
    return j.select("site", "business_location_id", "biz_date", pre.alias("prebooked_covers"),
                    F.col("avg_sameday_covers").alias("typical_sameday"), exp.cast("double").alias("expected_covers"))
