"""Ad-hoc reports and catalogue discovery."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.semantics import site_key
from hearth.operators.facts import active_rules
from hearth.plans.joins import broadcast_if_small

SHIFTS = ["Lunch (12-5)", "Dinner (5-10)"]
ALL_DAY = "All day"


def rule_audit(items: DataFrame, rules: DataFrame) -> DataFrame:
    """Every (active item-category rule, catalogue item) it matches.
    Each rule has one match type, so the OR splits into three disjoint joins;
    the ILIKE part runs on distinct item names only."""
    r = active_rules(rules, "item_category").select("category", "match_type", "match_value")
    it = items.select("business_location_id", "sku", "name", "accounting_group_name")
    by_group = it.join(broadcast_if_small(r.filter(F.col("match_type") == "accounting_group"), basis=rules),
                       F.col("accounting_group_name") == F.col("match_value"))
    by_sku = it.join(broadcast_if_small(r.filter(F.col("match_type") == "sku"), basis=rules),
                     F.col("sku") == F.col("match_value"))
    like = broadcast_if_small(r.filter(F.col("match_type") == "name_like"), basis=rules)
    names = it.select(F.col("name").alias("_n")).where(F.col("_n").isNotNull()).distinct()
    hits = names.join(like, F.expr("_n ILIKE match_value"))
    by_name = it.join(broadcast_if_small(hits), F.col("name") == F.col("_n")).drop("_n")
    cols = ["category", "match_type", "match_value", "business_location_id", "sku", "name", "accounting_group_name"]
    return by_group.select(*cols).unionByName(by_sku.select(*cols)).unionByName(by_name.select(*cols))


def items_in_group(items: DataFrame, group: str = "Food") -> DataFrame:
    """Distinct catalogue items of one accounting group."""
    return items.filter(F.col("accounting_group_name") == group) \
                .select("accounting_group_name", "name", "sku").distinct()


def uncategorised_best_sellers(lines_with_cats: DataFrame, as_of, window_days: int = 90, top: int = 100) -> DataFrame:
    """Items in no category, by ex-VAT sales over the window, top ``top``
    (ties broken by group and name so the cut is deterministic)."""
    since = F.date_sub(F.lit(as_of).cast("date"), window_days).cast("timestamp")
    f = lines_with_cats.filter((F.size("categories") == 0) & (F.col("time_closed") >= since))
    g = f.groupBy("accounting_group_name", "name").agg(F.sum("net_ex_vat").alias("net_sales"),
                                                       F.sum("quantity").alias("qty"))
    return g.orderBy(F.col("net_sales").desc_nulls_first(), F.col("accounting_group_name").asc_nulls_last(),
                     F.col("name").asc_nulls_last()).limit(top)


def _yesterday(as_of):
    return F.date_sub(F.lit(as_of).cast("date"), 1)


def yesterday_dates(as_of, days_before: int = 0):
    """(first, last) business date that a report on yesterday reads."""
    return F.date_sub(_yesterday(as_of), days_before), _yesterday(as_of)


def window_dates(as_of, days: int):
    """(first, None): business dates of receipts closed at or after ``as_of - days`` (a
    London date may be a day off the clock's)."""
    return F.date_sub(F.lit(as_of).cast("date"), days + 1), None


def category_day(lines_with_cats: DataFrame, as_of, categories) -> DataFrame:
    """Lines of ``as_of - 1`` in the given categories, one row per (line, category)."""
    f = lines_with_cats.filter(F.col("business_date") == _yesterday(as_of))
    return f.withColumn("category", F.explode("categories")).filter(F.col("category").isin(*categories))


def category_report_total(day: DataFrame, categories) -> DataFrame:
    """V64 (total): units and ex-VAT sales per category yesterday (0 when none)."""
    cats = day.sparkSession.createDataFrame([(c,) for c in categories], "category string")
    g = day.groupBy("category").agg(F.sum("quantity").alias("q"), F.sum("net_ex_vat").alias("n"))
    return broadcast_if_small(cats).join(g, "category", "left").select(
        "category", F.coalesce("q", F.lit(0)).alias("units"), F.round(F.coalesce("n", F.lit(0)), 2).alias("net"))


def category_report_by_site(day: DataFrame) -> DataFrame:
    """V64 (by site): units per category and site."""
    return day.groupBy("category", "site").agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("units"))


def category_report_names(day: DataFrame) -> DataFrame:
    """V64 (names): the distinct item names counted."""
    return day.select("category", "name").distinct()


def shift_report(fact_lines: DataFrame, as_of, top_n: int = 10) -> DataFrame:
    """yesterday's net sales per shift and its top ``top_n`` items by units
    (one pass with a row number per shift instead of a query per shift)."""
    f = fact_lines.filter((F.col("business_date") == _yesterday(as_of)) & F.col("shift").isin(*SHIFTS))
    items = f.groupBy("shift", "name").agg(F.sum("quantity").alias("units"), F.sum("net_ex_vat").alias("sold"))
    w = Window.partitionBy("shift").orderBy(F.col("units").desc_nulls_first(), F.col("name").asc_nulls_last())
    ranked = items.select("shift", "name", "units", F.round("sold", 2).alias("net"), F.row_number().over(w).alias("rank"),
                          F.coalesce(F.sum("sold").over(Window.partitionBy("shift")), F.lit(0)).alias("shift_net"))
    return ranked.filter(F.col("rank") <= top_n)


def shift_compare(fact_lines: DataFrame, as_of) -> DataFrame:
    """Per shift view (lunch, dinner, all day) and site: yesterday vs the
    same weekday last week, delta in pounds and percent, plus a TOTAL row that
    adds up the rounded site figures (as the printed report does)."""
    d0 = _yesterday(as_of)
    d1 = F.date_sub(d0, 7)
    f = fact_lines.filter(F.col("business_date").isin(d0, d1))
    views = F.array(F.lit(ALL_DAY), F.when(F.col("shift").isin(*SHIFTS), F.col("shift")))
    f = f.withColumn("view", F.explode(F.filter(views, lambda x: x.isNotNull())))
    this = F.col("business_date") == d0
    last = F.col("business_date") == d1
    site = (f.groupBy("view", F.coalesce(F.col("site"), F.lit("(unknown)")).alias("site")).agg(
        F.round(F.coalesce(F.sum(F.when(this, F.col("net_ex_vat"))), F.lit(0)), 2).alias("this_net"),
        F.round(F.coalesce(F.sum(F.when(last, F.col("net_ex_vat"))), F.lit(0)), 2).alias("last_net"),
        F.coalesce(F.sum(F.when(this, F.col("quantity"))), F.lit(0)).alias("this_units")))
    rolled = (site.rollup("view", "site")
              .agg(F.sum("this_net").alias("this_net"), F.sum("last_net").alias("last_net"),
                   F.sum("this_units").alias("this_units"), F.grouping_id().alias("_g"))
              .filter(F.col("_g") < 3)
              .withColumn("site", F.when(F.col("_g") == 1, F.lit("TOTAL")).otherwise(F.col("site"))))
    t, l = F.col("this_net"), F.col("last_net")
    return rolled.select(
        "view", "site", "this_net", "last_net", "this_units",
        F.when(l != 0, t - l).alias("delta"),
        F.when(l != 0, F.bround((t - l).cast("double") / l.cast("double") * 100, 0)).alias("delta_pct"))


def cash_reconciliation(fact_payments: DataFrame, cashoff: DataFrame, sites: DataFrame) -> DataFrame:
    """Per site-day, the manager's declared sales, counted cash and tips
    against the POS: total payments, cash-tender payments and tips."""
    pos = fact_payments.groupBy("business_location_id", "business_date").agg(
        F.sum("net_with_tax").alias("pos_sales"),
        F.sum(F.when(F.col("tender_group") == "Cash", F.col("net_with_tax"))).alias("pos_cash"),
        F.sum("tip").alias("pos_tips"))
    sk = broadcast_if_small(sites.select("business_location_id", "nickname", site_key(F.col("nickname")).alias("_k")), basis=sites)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    co = (cashoff.join(sk, site_key(F.col("site")) == sk["_k"])
          .groupBy("business_location_id", "business_date")
          .agg(F.sum("total_sales").alias("declared_sales"), F.sum("actual_cash").alias("counted_cash"),
               F.sum(z("card_tips") + z("cash_tips") + z("service_charge")).alias("declared_tips")))
    j = pos.join(co, ["business_location_id", "business_date"], "full_outer")
    j = j.join(broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites),
               "business_location_id", "left")
    return j.select(
        "business_location_id", "site", "business_date", "declared_sales", "pos_sales",
        (F.col("declared_sales") - F.col("pos_sales")).alias("sales_diff"),
        "counted_cash", "pos_cash", (F.col("counted_cash") - z("pos_cash")).alias("cash_diff"),
        "declared_tips", "pos_tips", (F.col("declared_tips") - F.col("pos_tips")).alias("tips_diff"))
