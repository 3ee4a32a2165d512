"""Registered queries: facts (V01-V09) and league tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import facts as V
from hearth.operators import leagues as L
from hearth.plans import oracle as O
from hearth.plans.catalog import END, START, Ctx, dbl, register

RANGE = f"time_closed BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


@register("v01_line_wet_dry", """
SELECT sl.business_location_id, sl.account_reference, sl.line_id,
       COALESCE(r.category, 'other') AS wet_dry
FROM sales_lines sl
LEFT JOIN category_rules r ON r.dimension = 'wet_dry' AND r.active
      AND r.match_type = 'accounting_group' AND r.match_value = sl.accounting_group_name
""")
def v01(c: Ctx):
    return V.line_wet_dry(c.w.sales_lines, c.w.category_rules)


@register("v02_line_item_category", "SELECT * FROM v_line_item_category")
def v02(c: Ctx):
    return V.line_item_category(c.w.sales_lines, c.w.category_rules)


FACT_COLS = ["business_location_id", "site", "account_reference", "line_id", "sku", "name",
             "accounting_group_name", "wet_dry", "business_date", "shift"]


@register("v03_fact_lines", f"""
SELECT {', '.join(FACT_COLS)},
       CAST(quantity AS DOUBLE) AS quantity, CAST(net_ex_vat AS DOUBLE) AS net_ex_vat,
       CAST(net_inc_vat AS DOUBLE) AS net_inc_vat, CAST(unit_cost_price AS DOUBLE) AS unit_cost_price
FROM v_fact_lines
""")
def v03(c: Ctx):
    return c.fact_lines.select(*FACT_COLS, *dbl("quantity", "net_ex_vat", "net_inc_vat", "unit_cost_price"))


@register("v04_fact_payments", """
SELECT business_location_id, site, account_reference, payment_uuid, business_date, shift,
       code, payment_method, tender_group,
       CAST(net_with_tax AS DOUBLE) AS net_with_tax, CAST(tip AS DOUBLE) AS tip,
       CAST(surcharge AS DOUBLE) AS surcharge
FROM v_fact_payments
""")
def v04(c: Ctx):
    return c.fact_payments.select(
        "business_location_id", "site", "account_reference", "payment_uuid", "business_date", "shift",
        "code", "payment_method", "tender_group", *dbl("net_with_tax", "tip", "surcharge"))


@register("v05_report_lines", f"""
SELECT {', '.join(FACT_COLS)}, item_category, line_staff, line_staff_id,
       CAST(quantity AS DOUBLE) AS quantity, CAST(net_ex_vat AS DOUBLE) AS net_ex_vat
FROM v_report_lines
""")
def v05(c: Ctx):
    return c.report_lines.select(*FACT_COLS, "item_category", "line_staff", "line_staff_id",
                                 *dbl("quantity", "net_ex_vat"))


@register("v06_void_lines", """
SELECT business_location_id, site, account_reference, line_id, sku, name, void_reason, staff_name,
       CAST(voided_value AS DOUBLE) AS voided_value, CAST(voided_qty AS DOUBLE) AS voided_qty,
       business_date, shift
FROM v_void_lines
""")
def v06(c: Ctx):
    return c.void_lines.select(
        "business_location_id", "site", "account_reference", "line_id", "sku", "name", "void_reason",
        "staff_name", *dbl("voided_value", "voided_qty"), "business_date", "shift")


LEAGUE_CATEGORIES = ("poppadoms", "cocktails", "desserts")

# every site's sums under every heading it is ranked by, from lines (once under "total",
# once under what they are), from their categories and from tips
O.TABLES["league_sums"] = f"""
  SELECT heading, site, sum(amount) AS amount, sum(units) AS units
  FROM (SELECT unnest(['total', wet_dry]) AS heading, site, net_ex_vat AS amount, quantity AS units FROM v_fact_lines WHERE {RANGE}
        UNION ALL BY NAME
        SELECT 'in ' || category AS heading, site, net_ex_vat AS amount, quantity AS units
        FROM v_fact_lines JOIN v_line_item_category USING (business_location_id, account_reference, line_id) WHERE {RANGE}
        UNION ALL BY NAME
        SELECT DISTINCT unnest({['wet', 'dry', *(f'in {c}' for c in LEAGUE_CATEGORIES)]}) AS heading, site FROM v_fact_lines WHERE {RANGE}
        UNION ALL BY NAME
        SELECT 'tips' AS heading, site, tip AS amount FROM v_fact_payments WHERE {RANGE})
  GROUP BY ALL"""


def _league(heading: str, rank: str, **columns: str) -> str:
    """Places of the sites under a heading: one more than the sites with a larger sum."""
    return f"""
SELECT 1 + (SELECT count(*) FROM league_sums AS ahead
            WHERE ahead.heading = own.heading AND COALESCE(ahead.amount, 0) > COALESCE(own.amount, 0)) AS {rank},
       own.site, {', '.join(f'{text} AS {name}' for name, text in columns.items())}
FROM league_sums AS own {"JOIN league_sums AS dry ON dry.site = own.site AND dry.heading = 'dry'" if heading == 'wet' else ''}
WHERE own.heading = '{heading}'
"""


def _pounds(of: str, digits: int = 2) -> str:
    return f"CAST(round(COALESCE({of}, 0), {digits}) AS DOUBLE)"


@register("v14_total_sales_league", _league("total", "rank", total_sales=_pounds("own.amount")))
def v14(c: Ctx):
    return L.total_sales_league(c.fact_lines, START, END)


@register("v15_wet_dry_league", _league(
    "wet", "rank_wet", wet_sales=_pounds("own.amount"), dry_sales=_pounds("dry.amount"),
    wet_pct="round(CAST(own.amount AS DOUBLE) * 100.0 / NULLIF(CAST(list_sum([own.amount, dry.amount]) AS DOUBLE), 0), 1)"))
def v15(c: Ctx):
    return L.wet_dry_league(c.fact_lines, START, END)


@register("v16_tips_league", _league("tips", "rank", total_tips=_pounds("own.amount")))
def v16(c: Ctx):
    return L.tips_league(c.fact_payments, START, END)


for _cat in LEAGUE_CATEGORIES:
    register(f"v17_{_cat}_league", _league(f"in {_cat}", "rank", net_sales=_pounds("own.amount"), units=_pounds("own.units", 0)))(
        lambda c, _c=_cat: L.category_league(c.lines_with_cats, _c, START, END))


# one row per site and measure, ranked together, then turned
@register("v18_scoreboard", f"""
WITH measured AS (
  SELECT site, 'sales' AS measure, net_ex_vat AS amount FROM v_fact_lines
  LEFT JOIN v_line_item_category USING (business_location_id, account_reference, line_id) WHERE {RANGE}
  UNION ALL
  SELECT site, unnest([wet_dry, category]), net_ex_vat FROM v_fact_lines
  LEFT JOIN v_line_item_category USING (business_location_id, account_reference, line_id) WHERE {RANGE}
  UNION ALL
  SELECT site, 'tips', tip FROM v_fact_payments WHERE {RANGE}),
grid AS (
  SELECT site, measure, COALESCE(sum(amount), 0) AS amount
  FROM (SELECT * FROM measured
        UNION ALL
        SELECT DISTINCT site, unnest(['wet', 'tips', 'poppadoms', 'cocktails', 'desserts']), NULL FROM measured)
  GROUP BY ALL),
placed AS (SELECT g.*, 1 + (SELECT count(*) FROM grid AS o WHERE o.measure = g.measure AND o.amount > g.amount) AS place FROM grid AS g)
SELECT site, CAST(round(any_value(amount) FILTER (measure = 'sales'), 2) AS DOUBLE) AS total_sales,
       {', '.join(f"any_value(place) FILTER (measure = '{m}') AS rank_{n}" for m, n in
                  [('sales', 'sales'), ('wet', 'wet'), ('tips', 'tips'), ('poppadoms', 'poppadoms'),
                   ('cocktails', 'cocktails'), ('desserts', 'desserts')])}
FROM placed GROUP BY site HAVING any_value(amount) FILTER (measure = 'sales') IS NOT NULL
""")
def v18(c: Ctx):
    return L.scoreboard(c.lines_with_cats, c.fact_payments, START, END)
