"""Registered queries: bookings and cross-source days."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import bookings as BK
from hearth.plans import oracle as O
from hearth.plans.catalog import AS_OF_ORDERS, Ctx, dbl, register

WHOLE_WINDOW_DAYS = 3650

# what a status says of a booking; a status that is not listed, or none, is live
STATUS_FLAGS = """(VALUES ('Booked', FALSE, FALSE, FALSE), ('Confirmed', FALSE, FALSE, FALSE), ('Show', TRUE, FALSE, FALSE),
                 ('Complete', TRUE, FALSE, FALSE), ('NoShow', FALSE, TRUE, FALSE), ('Cancelled', FALSE, FALSE, TRUE))
                 AS meaning(status, showed, is_noshow, is_cancelled)"""

O.TABLES["v_bookings"] = f"""
  SELECT * EXCLUDE (site_name, guest_count, clock),
         site_name AS site, guest_count AS covers,
         booking_date - (day(booking_date)::INTEGER - 1) AS booking_month,
         strftime(booking_date, '%A') AS day_of_week, CAST(strftime(booking_date, '%u') AS INTEGER) AS dow_iso,
         strftime(clock, '%H:%M:%S') AS booking_time, CAST(hour(clock) AS INTEGER) AS booking_hour,
         COALESCE(CASE sale_channel_code WHEN 103 THEN interface_type END, sale_channel) AS channel,
         COALESCE(visits > 1, FALSE) AS is_returning, COALESCE(NOT is_cancelled, TRUE) AS is_live
  FROM (SELECT *, TIMESTAMP '2000-01-01' + to_seconds(booking_time_secs % 86400) AS clock FROM bookings)
  LEFT JOIN {STATUS_FLAGS} USING (status)"""

# a booking is counted under each of its headings; a day is read off the counts by heading
SITE_DAY_HEADINGS = {
    "bookings": ("any", "n"), "live_bookings": ("live", "n"), "booked_covers": ("any", "covers"), "live_covers": ("live", "covers"),
    "shown_covers": ("shown", "covers"), "noshow_bookings": ("missed", "n"), "noshow_covers": ("missed", "covers"),
    "cancelled_bookings": ("off", "n"), "cancelled_covers": ("off", "covers"), "web_bookings": ("live Web", "n"),
    "phone_bookings": ("live Phone", "n"), "walkin_bookings": ("live Walk-in", "n"), "thirdparty_bookings": ("live 103", "n")}


def _heading(heading: str, what: str) -> str:
    value = f"any_value({what}) FILTER (heading = '{heading}')"
    return f"COALESCE({value}, 0)" if what == "n" else value


O.TABLES["v_bookings_site_day"] = f"""
  SELECT *, round(100.0 * noshow_covers / CAST(NULLIF(live_covers, 0) AS DOUBLE), 1) AS noshow_rate_pct,
         round(100.0 * cancelled_bookings / CAST(bookings AS DOUBLE), 1) AS cancel_rate_pct
  FROM (SELECT site, business_location_id, booking_date, dow_iso,
               {', '.join(f"{_heading(*where)} AS {name}" for name, where in SITE_DAY_HEADINGS.items())},
               round({_heading('shown', 'stay')}, 0) AS avg_duration_mins
        FROM (SELECT site, business_location_id, booking_date, dow_iso, heading, count(*) AS n,
                     CAST(sum(covers) AS BIGINT) AS covers, avg(duration_mins) AS stay
              FROM (SELECT *, unnest(['any', CASE WHEN showed THEN 'shown' WHEN is_noshow THEN 'missed' WHEN is_cancelled THEN 'off' END]
                                     || CASE WHEN is_live THEN ['live', 'live ' || channel, CASE sale_channel_code WHEN 103 THEN 'live 103' END]
                                        ELSE [] END) AS heading
                    FROM v_bookings)
              GROUP BY ALL)
        GROUP BY ALL)"""

BV_COLS = ["ft_site_code", "booking_ref_no", "booking_code", "business_location_id", "site", "booking_date",
           "booking_month", "day_of_week", "dow_iso", "booking_time", "booking_hour", "duration_mins", "covers",
           "status_code", "status", "sale_channel_code", "sale_channel", "interface_type", "channel", "table_no",
           "is_reward_member", "visits", "is_returning", "showed", "is_noshow", "is_cancelled", "is_live"]


@register("v43_bookings", f"""
SELECT {', '.join(BV_COLS)}, CAST(total_amount AS DOUBLE) AS total_amount, CAST(deposit AS DOUBLE) AS deposit
FROM v_bookings""")
def v43(c: Ctx):
    return BK.bookings_view(c.w.bookings).select(*BV_COLS, *dbl("total_amount", "deposit"))


BSD_COLS = ["site", "business_location_id", "booking_date", "dow_iso", "bookings", "live_bookings",
            "booked_covers", "live_covers", "shown_covers", "noshow_bookings", "noshow_covers",
            "cancelled_bookings", "cancelled_covers", "web_bookings", "phone_bookings", "walkin_bookings",
            "thirdparty_bookings", "noshow_rate_pct", "cancel_rate_pct"]


def _bsd(c: Ctx):
    return BK.bookings_site_day(BK.bookings_view(c.w.bookings))


@register("v44_bookings_site_day", f"SELECT {', '.join(BSD_COLS)}, avg_duration_mins FROM v_bookings_site_day")
def v44(c: Ctx):
    return _bsd(c).select(*BSD_COLS, *dbl("avg_duration_mins"))


UNI_BK = ["bookings", "live_bookings", "booked_covers", "live_covers", "shown_covers", "noshow_bookings",
          "noshow_covers", "cancelled_bookings", "noshow_rate_pct", "cancel_rate_pct", "web_bookings",
          "phone_bookings", "walkin_bookings", "thirdparty_bookings"]


# bookings, receipts and lines stacked under (site, day), summed into one row each
@register("v45_unified_site_day", f"""
WITH day AS (
  SELECT business_location_id, biz_date, sum(revenue) AS revenue, CAST(sum(guests) AS BIGINT) AS pos_covers, count(receipt) AS n_receipts
  FROM (SELECT business_location_id, trading_day AS biz_date, nb_covers AS guests, account_reference AS receipt FROM live_sales
        WHERE time_closed IS NOT NULL
        UNION ALL BY NAME
        SELECT business_location_id, {O.bdate('time_of_sale')} AS biz_date, net_with_tax AS revenue FROM sales_lines
        WHERE time_of_sale IS NOT NULL)
  GROUP BY ALL),
joined AS (SELECT * FROM (SELECT * RENAME (booking_date AS biz_date) FROM v_bookings_site_day) FULL JOIN day USING (business_location_id, biz_date))
SELECT business_location_id, biz_date, COALESCE(names.site_name, joined.site) AS site, CAST(revenue AS DOUBLE) AS revenue,
       pos_covers, NULLIF(n_receipts, 0) AS receipts, {', '.join(UNI_BK)}, avg_duration_mins,
       {O.round_div('revenue', 'booked_covers', 2)} AS spend_per_booked_cover,
       {O.round_div('revenue', 'pos_covers', 2)} AS spend_per_pos_cover,
       round(100.0 * live_covers / CAST(NULLIF(pos_covers, 0) AS DOUBLE), 1) AS booked_share_of_pos_pct,
       CAST(said.rating AS DOUBLE) AS rating, CAST(said.nps AS DOUBLE) AS nps, said.reviews
FROM joined
LEFT JOIN (SELECT DISTINCT business_location_id, site_name FROM ft_site_map) AS names USING (business_location_id)
LEFT JOIN (SELECT business_location_id, period_start AS biz_date, rating, nps, reviews FROM v_sentiment_overview
           WHERE grain = 'day') AS said USING (business_location_id, biz_date)
""")
def v45(c: Ctx):
    u = BK.unified_site_day(_bsd(c), c.w.sales, c.w.sales_lines, c.w.ft_site_map, c.sentiment_overview_v)
    return u.select("business_location_id", "site", "biz_date", *dbl("revenue"),
                    F.col("pos_covers").cast("long").alias("pos_covers"), "receipts", *UNI_BK,
                    *dbl("avg_duration_mins"), "spend_per_booked_cover", "spend_per_pos_cover",
                    "booked_share_of_pos_pct", *dbl("rating", "nps"), "reviews")


# each booking is put under the headings it counts for, then one row per day is read off
O.TABLES["v_booking_pace"] = """
  SELECT * EXCLUDE (prebooked, sameday, live, shown, missed, nothing),
         dayname(biz_date) AS day_of_week, CAST(isodow(biz_date) AS INTEGER) AS dow_iso,
         prebooked.n AS prebooked_bookings, prebooked.covers AS prebooked_covers, sameday.n AS sameday_bookings,
         sameday.covers AS sameday_covers, live.covers AS total_booked_covers, shown.covers AS shown_covers,
         missed.covers AS noshow_covers, round(100.0 * prebooked.covers / CAST(NULLIF(live.covers, 0) AS DOUBLE), 1) AS prebook_pct
  FROM (SELECT site_name AS site, business_location_id, booking_date AS biz_date, 0 AS nothing,
               """ + ", ".join(f"""{{'n': count(*) FILTER (list_contains(headings, '{h}')),
                 'covers': CAST(sum(guest_count) FILTER (list_contains(headings, '{h}')) AS BIGINT)}} AS {h}"""
                               for h in ("prebooked", "sameday", "live", "shown", "missed")) + """
        FROM (SELECT *, [CASE WHEN status <> 'Cancelled' OR status IS NULL THEN 'live' END,
                         CASE WHEN status IN ('Complete', 'Show') THEN 'shown' WHEN status = 'NoShow' THEN 'missed' END,
                         CASE WHEN status = 'Cancelled' THEN NULL WHEN made < booking_date THEN 'prebooked'
                              WHEN made >= booking_date THEN 'sameday' END] AS headings
              FROM (SELECT *, CAST(COALESCE(created_on, TRY_CAST(raw->>'CreatedOn' AS TIMESTAMP)) AS DATE) AS made FROM bookings))
        GROUP BY ALL)"""

PACE_COLS = ["site", "business_location_id", "biz_date", "dow_iso", "day_of_week", "prebooked_covers",
             "prebooked_bookings", "sameday_covers", "sameday_bookings", "total_booked_covers", "shown_covers",
             "noshow_covers", "prebook_pct"]


@register("v46_booking_pace", f"SELECT {', '.join(PACE_COLS)} FROM v_booking_pace")
def v46(c: Ctx):
    return BK.booking_pace(c.w.bookings).select(*PACE_COLS)


# exact averages of whole covers and of tenths of a percent, over the days sampled
O.TABLES["v_booking_pace_dow"] = f"""
  SELECT site, dow_iso, day_of_week, days AS days_sampled,
         {O.round_div('prebooked.s', 'prebooked.n', 0)} AS avg_prebooked_covers,
         {O.round_div('sameday.s', 'sameday.n', 0)} AS avg_sameday_covers,
         {O.round_div('total.s', 'total.n', 0)} AS avg_total_covers,
         {O.round_div('tenths.s', 'tenths.n', 0)} / 10 AS avg_prebook_pct
  FROM (SELECT site, dow_iso, day_of_week, count(*) AS days,
               {', '.join(f"{{'s': sum({of}), 'n': count({of})}} AS {name}" for name, of in
                          [('prebooked', 'prebooked_covers'), ('sameday', 'sameday_covers'), ('total', 'total_booked_covers'),
                           ('tenths', 'CAST(round(10 * prebook_pct) AS BIGINT)')])}
        FROM v_booking_pace
        WHERE date_diff('day', biz_date, DATE '{AS_OF_ORDERS}') BETWEEN 1 AND {WHOLE_WINDOW_DAYS}
        GROUP BY ALL)"""


@register("v47_booking_pace_dow", "SELECT * FROM v_booking_pace_dow")
def v47(c: Ctx):
    p = BK.booking_pace_dow(BK.booking_pace(c.w.bookings), AS_OF_ORDERS, WHOLE_WINDOW_DAYS)
    return p.select("site", "dow_iso", "day_of_week", "days_sampled",
                    *dbl("avg_prebooked_covers", "avg_sameday_covers", "avg_total_covers", "avg_prebook_pct"))


@register("v48_cover_forecast", f"""
SELECT p.site, p.business_location_id, p.biz_date, COALESCE(p.prebooked_covers, 0) AS prebooked_covers,
       d.avg_sameday_covers AS typical_sameday,
       CAST(COALESCE(p.prebooked_covers, 0) + COALESCE(d.avg_sameday_covers, 0) AS DOUBLE) AS expected_covers
FROM v_booking_pace p
LEFT JOIN v_booking_pace_dow d ON d.site = p.site AND d.dow_iso = p.dow_iso
WHERE p.biz_date = DATE '{AS_OF_ORDERS}'
""")
def v48(c: Ctx):
    pace = BK.booking_pace(c.w.bookings)
    prof = BK.booking_pace_dow(pace, AS_OF_ORDERS, WHOLE_WINDOW_DAYS)
    f = BK.cover_forecast(pace, prof, AS_OF_ORDERS)
    return f.select("site", "business_location_id", "biz_date", F.col("prebooked_covers").cast("long").alias("prebooked_covers"),
                    *dbl("typical_sameday", "expected_covers"))
