"""Registered queries: ad-hoc reports and catalogue discovery."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import reports as RP
from hearth.plans import oracle as O
from hearth.plans.catalog import AS_OF_ORDERS, Ctx, dbl, register

WHOLE_WINDOW_DAYS = 3650
CATEGORIES = ["poppadoms", "241 cocktails", "desserts"]
YDAY = f"DATE '{AS_OF_ORDERS}' - 1"
_cats = ", ".join(f"'{c}'" for c in CATEGORIES)


# an item meets a rule by one of three of its texts
@register("v61_rule_audit", """
SELECT category, match_type, match_value, business_location_id, sku, name, accounting_group_name
FROM (SELECT *, unnest([{'how': 'accounting_group', 'said': accounting_group_name}, {'how': 'sku', 'said': sku},
                        {'how': 'name_like', 'said': name}]) AS t FROM items)
JOIN item_rules ON match_type = t.how AND CASE t.how WHEN 'name_like' THEN t.said ILIKE match_value ELSE t.said = match_value END""")
def v61(c: Ctx):
    return RP.rule_audit(c.w.items, c.w.category_rules)


@register("v62_items_in_group", "SELECT DISTINCT accounting_group_name, name, sku FROM items WHERE accounting_group_name = 'Food'")
def v62(c: Ctx):
    return RP.items_in_group(c.w.items, "Food")


@register("v63_uncategorised_best_sellers", f"""
SELECT accounting_group_name, name, CAST(worth AS DOUBLE) AS net_sales, CAST(units AS DOUBLE) AS qty
FROM (SELECT accounting_group_name, name, sum(net_ex_vat) AS worth, sum(quantity) AS units
      FROM v_fact_lines ANTI JOIN v_line_item_category USING (business_location_id, account_reference, line_id)
      WHERE time_closed >= CAST(DATE '{AS_OF_ORDERS}' - {WHOLE_WINDOW_DAYS} AS TIMESTAMP) GROUP BY ALL)
ORDER BY worth DESC NULLS FIRST, accounting_group_name, name LIMIT 100""")
def v63(c: Ctx):
    lines = c.lines_with_cats_on(*RP.window_dates(AS_OF_ORDERS, WHOLE_WINDOW_DAYS))
    return RP.uncategorised_best_sellers(lines, AS_OF_ORDERS, WHOLE_WINDOW_DAYS).select(
        "accounting_group_name", "name", *dbl("net_sales", "qty"))


O.TABLES["v_category_day"] = f"""
  SELECT * FROM v_fact_lines JOIN v_line_item_category USING (business_location_id, account_reference, line_id)
  WHERE business_date = {YDAY} AND category IN ({_cats})"""


def _day(c: Ctx):
    return RP.category_day(c.lines_with_cats_on(*RP.yesterday_dates(AS_OF_ORDERS)), AS_OF_ORDERS, CATEGORIES)


@register("v64_category_report_total", f"""
SELECT k.category, CAST(COALESCE(SUM(d.quantity), 0) AS DOUBLE) AS units,
       CAST(ROUND(COALESCE(SUM(d.net_ex_vat), 0), 2) AS DOUBLE) AS net
FROM (SELECT unnest([{_cats}]) AS category) k LEFT JOIN v_category_day d ON d.category = k.category
GROUP BY k.category""")
def v64a(c: Ctx):
    return RP.category_report_total(_day(c), CATEGORIES).select("category", *dbl("units", "net"))


@register("v64_category_report_by_site", """
SELECT category, site, CAST(COALESCE(SUM(quantity), 0) AS DOUBLE) AS units FROM v_category_day GROUP BY category, site""")
def v64b(c: Ctx):
    return RP.category_report_by_site(_day(c)).select("category", "site", *dbl("units"))


@register("v64_category_report_names", "SELECT DISTINCT category, name FROM v_category_day")
def v64c(c: Ctx):
    return RP.category_report_names(_day(c))


@register("v65_shift_report", f"""
WITH f AS (SELECT * FROM v_fact_lines WHERE business_date = {YDAY} AND shift IN ('Lunch (12-5)', 'Dinner (5-10)')),
items AS (SELECT shift, name, SUM(quantity) AS units, ROUND(SUM(net_ex_vat), 2) AS net FROM f GROUP BY shift, name),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY shift ORDER BY units DESC NULLS FIRST, name) AS rank FROM items),
tot AS (SELECT shift, COALESCE(SUM(net_ex_vat), 0) AS shift_net FROM f GROUP BY shift)
SELECT r.shift, r.name, CAST(r.units AS DOUBLE) AS units, CAST(r.net AS DOUBLE) AS net, r.rank,
       CAST(t.shift_net AS DOUBLE) AS shift_net
FROM ranked r JOIN tot t ON t.shift = r.shift WHERE r.rank <= 10""")
def v65(c: Ctx):
    r = RP.shift_report(c.fact_lines_on(*RP.yesterday_dates(AS_OF_ORDERS)), AS_OF_ORDERS, 10)
    return r.select("shift", "name", *dbl("units", "net"), F.col("rank").cast("long").alias("rank"), *dbl("shift_net"))


@register("v66_shift_compare", f"""
WITH f AS (
  SELECT 'All day' AS view, * FROM v_fact_lines WHERE business_date IN ({YDAY}, {YDAY} - 7)
  UNION ALL
  SELECT shift AS view, * FROM v_fact_lines
  WHERE business_date IN ({YDAY}, {YDAY} - 7) AND shift IN ('Lunch (12-5)', 'Dinner (5-10)')
), s AS (
  SELECT view, COALESCE(site, '(unknown)') AS site,
         ROUND(COALESCE(SUM(net_ex_vat) FILTER (WHERE business_date = {YDAY}), 0), 2) AS this_net,
         ROUND(COALESCE(SUM(net_ex_vat) FILTER (WHERE business_date = {YDAY} - 7), 0), 2) AS last_net,
         COALESCE(SUM(quantity) FILTER (WHERE business_date = {YDAY}), 0) AS this_units
  FROM f GROUP BY 1, 2
), r AS (
  SELECT view, site, this_net, last_net, this_units FROM s
  UNION ALL
  SELECT view, 'TOTAL', SUM(this_net), SUM(last_net), SUM(this_units) FROM s GROUP BY view
)
SELECT view, site, CAST(this_net AS DOUBLE) AS this_net, CAST(last_net AS DOUBLE) AS last_net,
       CAST(this_units AS DOUBLE) AS this_units,
       CAST(CASE WHEN last_net <> 0 THEN this_net - last_net END AS DOUBLE) AS delta,
       CASE WHEN last_net <> 0 THEN round_even(CAST(this_net - last_net AS DOUBLE) / CAST(last_net AS DOUBLE) * 100, 0) END AS delta_pct
FROM r""")
def v66(c: Ctx):
    r = RP.shift_compare(c.fact_lines_on(*RP.yesterday_dates(AS_OF_ORDERS, 7)), AS_OF_ORDERS)
    return r.select("view", "site", *dbl("this_net", "last_net", "this_units", "delta"), "delta_pct")


@register("v67_cash_reconciliation", f"""
WITH pos AS (
  SELECT business_location_id, business_date, SUM(net_with_tax) AS pos_sales,
         SUM(net_with_tax) FILTER (WHERE tender_group = 'Cash') AS pos_cash, SUM(tip) AS pos_tips
  FROM v_fact_payments GROUP BY 1, 2
), co AS (
  SELECT s.business_location_id, c.business_date, SUM(c.total_sales) AS declared_sales,
         SUM(c.actual_cash) AS counted_cash,
         SUM(COALESCE(c.card_tips, 0) + COALESCE(c.cash_tips, 0) + COALESCE(c.service_charge, 0)) AS declared_tips
  FROM cashoff_daily c JOIN sites s ON {O.site_key('s.nickname')} = {O.site_key('c.site')}
  GROUP BY 1, 2
), j AS (
  SELECT COALESCE(pos.business_location_id, co.business_location_id) AS business_location_id,
         COALESCE(pos.business_date, co.business_date) AS business_date, pos.pos_sales, pos.pos_cash, pos.pos_tips,
         co.declared_sales, co.counted_cash, co.declared_tips
  FROM pos FULL JOIN co ON co.business_location_id = pos.business_location_id AND co.business_date = pos.business_date
)
SELECT j.business_location_id, st.nickname AS site, j.business_date,
       CAST(declared_sales AS DOUBLE) AS declared_sales, CAST(pos_sales AS DOUBLE) AS pos_sales,
       CAST(declared_sales - pos_sales AS DOUBLE) AS sales_diff,
       CAST(counted_cash AS DOUBLE) AS counted_cash, CAST(pos_cash AS DOUBLE) AS pos_cash,
       CAST(counted_cash - COALESCE(pos_cash, 0) AS DOUBLE) AS cash_diff,
       CAST(declared_tips AS DOUBLE) AS declared_tips, CAST(pos_tips AS DOUBLE) AS pos_tips,
       CAST(declared_tips - pos_tips AS DOUBLE) AS tips_diff
FROM j LEFT JOIN sites st ON st.business_location_id = j.business_location_id""")
def v67(c: Ctx):
    r = RP.cash_reconciliation(c.fact_payments, c.w.cashoff_daily, c.w.sites)
    return r.select("business_location_id", "site", "business_date",
                    *dbl("declared_sales", "pos_sales", "sales_diff", "counted_cash", "pos_cash", "cash_diff",
                         "declared_tips", "pos_tips", "tips_diff"))
