"""Registered queries: reviews (V49-V51, V26), labour (V52-V53), manager forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import feeds as FD
from hearth.operators import staff as ST
from hearth.plans import oracle as O
from hearth.plans.catalog import AS_OF_ORDERS, Ctx, dbl, register
from hearth.sources.reference_data import ASPECTS

OV_COLS = ["period_start", "grain", "site", "business_location_id", "sentiment_label", "reviews", "star5", "star4",
           "star3", "star2", "star1", "critical", "positive_pct", "negative_pct", *(f"{a}_mentions" for a in ASPECTS)]
OV_NUM = ["rating", "competitor_rating", "nps", *(f"{a}_sentiment" for a in ASPECTS)]

# site keys of a vendor label; a label nobody maps keeps its rows
O.TABLES["labelled_site"] = "SELECT sentiment_label, business_location_id, nickname AS site FROM sentiment_site_map"

O.TABLES["v_sentiment_overview"] = """
  SELECT *, round(100.0 * COALESCE(list_sum([star4, star5]), 0) / CAST(NULLIF(reviews, 0) AS DOUBLE), 1) AS positive_pct,
         round(100.0 * COALESCE(list_sum([star1, star2]), 0) / CAST(NULLIF(reviews, 0) AS DOUBLE), 1) AS negative_pct
  FROM sentiment_overview NATURAL LEFT JOIN labelled_site"""


@register("v49_sentiment_overview", f"""
SELECT {', '.join(OV_COLS)}, {', '.join(f'CAST({n} AS DOUBLE) AS {n}' for n in OV_NUM)} FROM v_sentiment_overview""")
def v49(c: Ctx):
    return c.sentiment_overview_v.select(*OV_COLS, *dbl(*OV_NUM))


O.TABLES["v_sentiment_reviews"] = """
  SELECT * EXCLUDE (source_file), review_date - (day(review_date)::INTEGER - 1) AS review_month, NOT rating > 3 AS is_negative
  FROM sentiment_reviews NATURAL LEFT JOIN labelled_site"""

RV_COLS = ["review_date", "review_month", "site", "business_location_id", "sentiment_label", "source", "reviewer",
           "is_negative", "review_hash"]


@register("v50_sentiment_reviews", f"""
SELECT {', '.join(RV_COLS)}, CAST(rating AS DOUBLE) AS rating, length(review_text) AS text_len
FROM v_sentiment_reviews""")
def v50(c: Ctx):
    return c.reviews_v.select(*RV_COLS, *dbl("rating"), F.length("review_text").alias("text_len"))


# each monthly row looks up the cash-off days of its own month
@register("v51_sentiment_site_month", """
SELECT period_start, site, business_location_id, reviews, positive_pct, negative_pct, cashoff_sales, cashoff_covers,
       CAST(rating AS DOUBLE) AS rating, CAST(nps AS DOUBLE) AS nps
FROM v_sentiment_overview AS said
CROSS JOIN LATERAL (SELECT CAST(sum(total_sales) AS DOUBLE) AS cashoff_sales, CAST(sum(covers) AS DOUBLE) AS cashoff_covers
                    FROM cashoff_daily AS till
                    WHERE till.site = said.site AND date_diff('month', said.period_start, till.business_date) = 0)
WHERE said.grain = 'month'
""")
def v51(c: Ctx):
    m = FD.sentiment_site_month(c.sentiment_overview_v, c.w.cashoff_daily)
    return m.select("period_start", "site", "business_location_id", "reviews", *dbl("rating", "nps"),
                    "positive_pct", "negative_pct", *dbl("cashoff_sales", "cashoff_covers"))


# a review's words (letters of any script, digits, underscore), looked up by name
@register("v26_staff_reviews_month", r"""
SELECT business_location_id, site, staff, review_month AS mth, count(DISTINCT review_hash) AS reviews
FROM (SELECT business_location_id, review_month, review_hash,
             unnest(list_distinct(string_split_regex(lower(review_text), '[^\p{L}\p{N}_]+'))) AS word
      FROM v_sentiment_reviews WHERE rating >= 5)
JOIN (SELECT DISTINCT business_location_id, site, staff, lower(regexp_replace(staff, '[^a-zA-Z]', '', 'g')) AS word
      FROM v_staff_scorecard_day) USING (business_location_id, word)
WHERE len(word) >= 3 AND staff NOT IN ('Admin', 'Bar', 'Chef', 'Duty', 'Floor', 'Host', 'Kitchen', 'Manager', 'Server', 'Staff',
                                       'Team', 'Trainee', 'Waiter', 'Waitress')
GROUP BY ALL
""")
def v26(c: Ctx):
    return ST.staff_reviews_month(c.scorecard_day, c.reviews_v)


@register("v52_labour_last_night", """
SELECT last.site_name, last.biz_date, last.orders,
       CAST(last.col AS DOUBLE) AS labour_cost, CAST(last.planned_col AS DOUBLE) AS planned_labour_cost,
       CAST(round(last.col - last.planned_col, 2) AS DOUBLE) AS labour_cost_var,
       CAST(last.hours AS DOUBLE) AS hours, CAST(last.planned_hours AS DOUBLE) AS planned_hours,
       CAST(round(last.hours - last.planned_hours, 2) AS DOUBLE) AS hours_var,
       CAST(last.sales AS DOUBLE) AS sales, CAST(last.splh AS DOUBLE) AS splh, CAST(last.oplh AS DOUBLE) AS oplh,
       CAST(NULLIF(last.sales, 0) / NULLIF(last.sales, 0) * last.percentage AS DOUBLE) AS labour_pct,
       CAST(last.planned_percentage AS DOUBLE) AS planned_labour_pct,
       COALESCE(['GREEN', 'AMBER', 'RED'][CASE WHEN last.sales <> 0 THEN
                1 + CAST(last.percentage >= 27 AS INTEGER) + CAST(last.percentage > 30 AS INTEGER) END], 'N/A') AS labour_pct_rag,
       COALESCE(last.planned_col > 0 AND last.col > last.planned_col * 1.05, FALSE) AS over_plan_flag
FROM (SELECT arg_max(d, biz_date) AS last FROM nory_labour_daily AS d
      WHERE branch_id IN (SELECT branch_id FROM nory_site_map WHERE is_core) GROUP BY branch_id)
""")
def v52(c: Ctx):
    n = FD.labour_last_night(c.w.nory_labour_daily, c.w.nory_site_map)
    return n.select("site_name", "biz_date", *dbl("sales"), "orders",
                    *dbl("labour_cost", "planned_labour_cost", "labour_cost_var", "hours", "planned_hours",
                         "hours_var", "labour_pct", "planned_labour_pct", "splh", "oplh"),
                    "labour_pct_rag", "over_plan_flag")


@register("v53_labour_last_night_breakdown", """
SELECT site_name, biz_date, category, CAST(value AS DOUBLE) AS actual, CAST(planned_value AS DOUBLE) AS planned
FROM nory_labour_breakdown JOIN nory_site_map USING (branch_id)
WHERE is_core AND (branch_id, biz_date) IN (SELECT (branch_id, max(biz_date)) FROM nory_labour_breakdown GROUP BY branch_id)
""")
def v53(c: Ctx):
    b = FD.labour_last_night_breakdown(c.w.nory_labour_breakdown, c.w.nory_site_map)
    return b.select("site_name", "biz_date", "category", *dbl("actual", "planned"))


@register("v60_manager_report_last_night", f"""
SELECT site, manager_name AS manager, positive_highlights, stockout_detail AS stockouts,
       equipment_detail AS equipment, customer_comments, incidents, further_comments
FROM manager_daily_report WHERE business_date = DATE '{AS_OF_ORDERS}' - 1
""")
def v60(c: Ctx):
    return FD.manager_report_last_night(c.w.manager_daily_report, AS_OF_ORDERS)
