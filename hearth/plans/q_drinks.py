"""Registered queries: drinks ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import drinks as D
from hearth.plans import oracle as O
from hearth.plans.catalog import AS_OF_ORDERS, Ctx, dbl, register

WHOLE_WINDOW_DAYS = 3650
CLEAN_SITE = "regexp_replace(regexp_replace(st.nickname, '\\.+$', ''), '^Tap ', '')"
LO = f"timezone('Europe/London', CAST(DATE '{AS_OF_ORDERS}' - {WHOLE_WINDOW_DAYS} AS TIMESTAMP))"
HI = f"timezone('Europe/London', CAST(DATE '{AS_OF_ORDERS}' AS TIMESTAMP))"

O.TABLES["v_drinks_base"] = f"""
  SELECT {O.site_label('nickname')} AS site, sku, name, accounting_group_name, menu_list_price, sum(quantity) AS qty
  FROM (SELECT *, timezone('UTC', time_of_sale) AS sold_at FROM sales_lines) JOIN sites USING (business_location_id)
  WHERE accounting_group_name LIKE '%Alcoholic Drinks' AND quantity > 0 AND sold_at >= {LO} AND sold_at < {HI}
  GROUP BY ALL"""

O.TABLES["v_drinks_kegs"] = f"""
  SELECT * EXCLUDE (ml), {O.round_div('ml', '1000', 1, 3)} AS litres_sold, {O.round_div('ml', '568', 1, 3)} AS pints_sold,
         {O.round_div('ml', 'keg_size_l * 1000', 2, 3)} AS kegs_consumed, CEIL(ml / (keg_size_l * 1000.0)) AS kegs_to_order
  FROM (SELECT site, keg_name, keg_litres AS keg_size_l, sum(qty) AS pints_halves_sold, sum(qty * serve_ml) AS ml
        FROM keg_ref JOIN v_drinks_base USING (sku) GROUP BY ALL)"""

O.TABLES["v_drinks_packaged"] = """
  SELECT *, CEIL(units_sold) AS units_to_order
  FROM (SELECT site, product, sum(qty) AS units_sold FROM packaged_ref JOIN v_drinks_base USING (sku) GROUP BY ALL)"""

# every pour of a spirit: measures named on the line, and what its cocktails hold
O.TABLES["spirit_pours"] = r"""
  SELECT site, spirit, CAST(qty * ml AS DECIMAL(24,5)) AS ml, TRUE AS mixed FROM cocktail_bom JOIN v_drinks_base USING (sku)
  UNION ALL BY NAME
  SELECT site, trim(regexp_extract(name, '^(.*?)\s*(25|50)ml', 1)) AS spirit, FALSE AS mixed,
         CAST(qty * CAST(regexp_extract(name, '(^| )(25|50)ml( |$)', 2) AS INTEGER) AS DECIMAL(24,5)) AS ml
  FROM v_drinks_base
  WHERE accounting_group_name = 'Alcoholic Drinks' AND name NOT LIKE '%0\%%' ESCAPE '\'
    AND regexp_extract(name, '(^| )(25|50)ml( |$)', 2) <> ''"""

O.TABLES["v_drinks_spirits"] = f"""
  SELECT *, {O.round_div('total_ml', '700', 2, 5)} AS bottles_700ml, CEIL((total_ml - 350) / 700) AS bottles_to_order
  FROM (SELECT site, spirit, sum(ml) AS total_ml, COALESCE(sum(ml) FILTER (mixed), 0) AS cocktail_ml,
               COALESCE(sum(ml) FILTER (NOT mixed), 0) AS straight_ml FROM spirit_pours GROUP BY ALL)"""

O.TABLES["v_drinks_wine"] = f"""
  SELECT *, {O.round_div('ml_poured', '750', 2, 3)} AS bottles_equiv, CEIL(ml_poured / 750.0) AS bottles_to_order
  FROM (SELECT site, wine_name, CAST(sum(qty * ml) AS DECIMAL(24,3)) AS ml_poured
        FROM v_drinks_base JOIN (SELECT sku, wine_name, ml FROM wine_ref
                                 UNION ALL SELECT DISTINCT sku, 'Prosecco', 100 FROM cocktail_ref WHERE is_spritz) USING (sku)
        GROUP BY ALL)"""

def _served(noun: str) -> str:
    """Quantities by whether the menu price was charged."""
    return (f"sum(qty) AS total_{noun}, COALESCE(sum(qty) FILTER (menu_list_price > 0), 0) AS paid_{noun}, "
            f"COALESCE(sum(qty) FILTER (menu_list_price = 0), 0) AS bottomless_{noun}")


O.TABLES["v_drinks_cocktails"] = f"""
  SELECT site, cocktail_name, {_served('serves')} FROM cocktail_ref JOIN v_drinks_base USING (sku) GROUP BY ALL"""

O.TABLES["v_drinks_softs"] = f"""
  SELECT site, name AS product, {_served('units')} FROM v_drinks_base WHERE accounting_group_name LIKE 'Non-%' GROUP BY ALL"""


def _base(c: Ctx):
    return D.drinks_base(c.w.sales_lines, c.w.sites, AS_OF_ORDERS, WHOLE_WINDOW_DAYS)


@register("v34_drinks_base", """
SELECT site, sku, name, accounting_group_name, CAST(menu_list_price AS DOUBLE) AS menu_list_price,
       CAST(qty AS DOUBLE) AS qty FROM v_drinks_base""")
def v34(c: Ctx):
    return _base(c).select("site", "sku", "name", "accounting_group_name", *dbl("menu_list_price", "qty"))


@register("v35_drinks_kegs", """
SELECT site, keg_name, keg_size_l, CAST(pints_halves_sold AS DOUBLE) AS pints_halves_sold, litres_sold, pints_sold,
       kegs_consumed, CAST(kegs_to_order AS DOUBLE) AS kegs_to_order FROM v_drinks_kegs""")
def v35(c: Ctx):
    k = D.kegs(_base(c), c.w.keg_ref)
    return k.select("site", "keg_name", "keg_size_l", *dbl("pints_halves_sold"), "litres_sold", "pints_sold",
                    "kegs_consumed", *dbl("kegs_to_order"))


@register("v36_drinks_packaged", """
SELECT site, product, CAST(units_sold AS DOUBLE) AS units_sold, CAST(units_to_order AS DOUBLE) AS units_to_order
FROM v_drinks_packaged""")
def v36(c: Ctx):
    return D.packaged(_base(c), c.w.packaged_ref).select("site", "product", *dbl("units_sold", "units_to_order"))


@register("v37_drinks_spirits", """
SELECT site, spirit, CAST(straight_ml AS DOUBLE) AS straight_ml, CAST(cocktail_ml AS DOUBLE) AS cocktail_ml,
       CAST(total_ml AS DOUBLE) AS total_ml, bottles_700ml, CAST(bottles_to_order AS DOUBLE) AS bottles_to_order
FROM v_drinks_spirits""")
def v37(c: Ctx):
    s = D.spirits(_base(c), c.w.cocktail_bom)
    return s.select("site", "spirit", *dbl("straight_ml", "cocktail_ml", "total_ml"), "bottles_700ml",
                    *dbl("bottles_to_order"))


@register("v38_drinks_wine", """
SELECT site, wine_name, CAST(ml_poured AS DOUBLE) AS ml_poured, bottles_equiv,
       CAST(bottles_to_order AS DOUBLE) AS bottles_to_order FROM v_drinks_wine""")
def v38(c: Ctx):
    w = D.wine(_base(c), c.w.wine_ref, c.w.cocktail_ref)
    return w.select("site", "wine_name", *dbl("ml_poured"), "bottles_equiv", *dbl("bottles_to_order"))


@register("v39_drinks_cocktails", """
SELECT site, cocktail_name, CAST(paid_serves AS DOUBLE) AS paid_serves,
       CAST(bottomless_serves AS DOUBLE) AS bottomless_serves, CAST(total_serves AS DOUBLE) AS total_serves
FROM v_drinks_cocktails""")
def v39(c: Ctx):
    return D.cocktails(_base(c), c.w.cocktail_ref).select(
        "site", "cocktail_name", *dbl("paid_serves", "bottomless_serves", "total_serves"))


@register("v40_drinks_softs", """
SELECT site, product, CAST(paid_units AS DOUBLE) AS paid_units, CAST(bottomless_units AS DOUBLE) AS bottomless_units,
       CAST(total_units AS DOUBLE) AS total_units FROM v_drinks_softs""")
def v40(c: Ctx):
    return D.softs(_base(c)).select("site", "product", *dbl("paid_units", "bottomless_units", "total_units"))


_REPORT = [     # category, its table, product, consumed, unit, litres, bottomless, to order, order unit
    ("Draught Beer", "kegs", "keg_name", "pints_sold", "pints", "litres_sold", "NULL", "kegs_to_order", "kegs"),
    ("Packaged Beer/Cider", "packaged", "product", "units_sold", "units", "NULL", "NULL", "units_to_order", "units"),
    ("Spirit", "spirits", "spirit", "total_ml", "ml", "NULL", "NULL", "bottles_to_order", "700ml bottles"),
    ("Wine", "wine", "wine_name", "ml_poured", "ml", "NULL", "NULL", "bottles_to_order", "75cl bottles"),
    ("Cocktail", "cocktails", "cocktail_name", "total_serves", "serves", "NULL", "bottomless_serves", "NULL", ""),
    ("Soft Drink", "softs", "product", "total_units", "units", "NULL", "bottomless_units", "NULL", ""),
]


@register("v41_drinks_order_report", " UNION ALL ".join(
    f"SELECT site, '{category}' AS category, {rank} AS category_rank, {product} AS product, CAST({used} AS DOUBLE) AS consumed, "
    f"'{unit}' AS unit, CAST({litres} AS DOUBLE) AS litres, CAST({free} AS DOUBLE) AS bottomless, "
    f"CAST({order} AS DOUBLE) AS to_order, '{order_unit}' AS order_unit FROM v_drinks_{table}"
    for rank, (category, table, product, used, unit, litres, free, order, order_unit) in enumerate(_REPORT, 1)))
def v41(c: Ctx):
    b = _base(c)
    w = c.w
    return D.order_report(D.kegs(b, w.keg_ref), D.packaged(b, w.packaged_ref), D.spirits(b, w.cocktail_bom),
                          D.wine(b, w.wine_ref, w.cocktail_ref), D.cocktails(b, w.cocktail_ref), D.softs(b))


@register("v42_drinks_intel", f"""
SELECT CAST({O.lon('sl.time_of_sale')} AS DATE) AS sale_day, {CLEAN_SITE} AS site,
       CASE sl.accounting_group_name WHEN 'Alcoholic Drinks' THEN 'Alcoholic'
            WHEN 'Non-Alcoholic Drinks' THEN 'Non-Alcoholic' ELSE sl.accounting_group_name END AS category,
       sl.name AS product, CAST(SUM(sl.quantity) AS DOUBLE) AS units,
       CAST(ROUND(SUM(sl.quantity * sl.menu_list_price), 2) AS DOUBLE) AS est_revenue
FROM sales_lines sl JOIN sites st ON st.business_location_id = sl.business_location_id
WHERE sl.quantity > 0 AND sl.accounting_group_name IN ('Alcoholic Drinks', 'Non-Alcoholic Drinks')
GROUP BY 1, 2, 3, 4""")
def v42(c: Ctx):
    return D.drinks_intel(c.w.sales_lines, c.w.sites).select("sale_day", "site", "category", "product",
                                                              *dbl("units", "est_revenue"))
