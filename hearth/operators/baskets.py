"""Basket analysis (V28-V31) and kitchen prep.

Pair counting: the basket base is DISTINCT (receipt, item), so a receipt holds
at most one row per menu item. One pass counts items and baskets; items below the
pairs' threshold can be in no pair that is kept, so they go before lists are made.
The counts of the others (part of the menu) ride along in the lists, and only
pair counts are shuffled, after a partial sum in each task; no join follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.semantics import business_date, clean_site_label, iso_dow, not_cancelled
from hearth.plans.joins import BROADCAST_MAX_BYTES, broadcast_if_small
from hearth.sources.periods import within

BASKET_GROUPS = ["Food", "Alcoholic Drinks", "Non-Alcoholic Drinks"]
DRINK_GROUPS = ["Alcoholic Drinks", "Non-Alcoholic Drinks"]

# Side dishes and desserts that do not make a basket a "main" basket,
# and the attach patterns.
NOT_MAIN = ("(rice|naan|roti|paratha|poppadom|papad|pappad|chutney|raita|pickle|fries|chips|kulfi|gulab|"
            "jamun|brownie|ice cream|dessert|croquet|bowl)")
ATTACH = {"rice": "rice", "naan": "naan", "pop": "poppadom|papad|pappad"}


def basket_base(lines: DataFrame, sales: DataFrame, sites: DataFrame, as_of, window_days: int = 60) -> DataFrame:
    """Distinct (receipt, item) over the last ``window_days`` before ``as_of``;
    no modifiers ('.' prefix), three groups, positive quantity, live receipts."""
    first = F.date_sub(F.lit(as_of).cast("date"), window_days)
    since = first.cast("timestamp")
    # a London date may be a day off the clock's: the stored dates prune, the time decides
    lines, sales = within(lines, F.date_sub(first, 1)), within(sales, F.date_sub(first, 1))
    s = sales.filter(not_cancelled() & (F.col("time_closed") >= since)).select(
        "business_location_id", "account_reference")
    st = broadcast_if_small(sites.select("business_location_id", clean_site_label(F.col("nickname")).alias("site")), basis=sites)
    l = lines.filter((F.col("quantity") > 0) & (F.substring("name", 1, 1) != ".")
                     & F.col("accounting_group_name").isin(*BASKET_GROUPS))
    return (l.join(s, ["business_location_id", "account_reference"]).join(st, "business_location_id")
             .select(F.col("business_location_id").alias("bl"), F.col("account_reference").alias("ar"), "site",
                     F.col("name").alias("item"), F.col("accounting_group_name").alias("agn"))
             .distinct())


def basket_pairs(base: DataFrame, min_count: int = 10, by_site: bool = False, menu: DataFrame | None = None,
                 sites: DataFrame | None = None) -> DataFrame:
    """V29 (all sites) / V30 (``by_site``): item pairs with support, both
    confidences and lift, kept when at least ``min_count`` baskets share them.

    ``menu`` (a row per item name) and ``sites`` (a row per site) bound the counts of
    frequent items: these are broadcast if the menu, once per site where needed, is
    small. Without ``menu`` the bound is that of ``base``."""
    keys = ["site"] if by_site else []
    # one pass: a NULL item in each basket counts the baskets
    counts = (base.groupBy(*keys, "bl", "ar").agg(F.collect_list("item").alias("items"))
              .select(*keys, F.explode(F.concat("items", F.array(F.lit(None).cast("string")))).alias("item"))
              .groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("sc")))
    # the window sees a row per menu item (and site)
    per = Window.partitionBy(*keys)
    counts = counts.withColumn("n", F.max(F.when(F.col("item").isNull(), F.col("sc"))).over(per))
    frequent = counts.filter(F.col("item").isNotNull() & (F.col("sc") >= min_count))
    if menu is not None:
        times = sites.count() if by_site and sites is not None else 1
        frequent = broadcast_if_small(frequent, BROADCAST_MAX_BYTES // max(1, times), basis=menu)
    baskets = (base.join(frequent, [*keys, "item"]).groupBy(*keys, "bl", "ar")
               .agg(F.array_sort(F.collect_list(F.struct("item", "sc"))).alias("items"), F.max("n").alias("n")))
    later = F.transform("items", lambda x, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda y: F.struct(x["item"].alias("item_a"), y["item"].alias("item_b"),
                                                                     x["sc"].alias("s1"), y["sc"].alias("s2"))))
    pairs = (baskets.select(*keys, "n", F.inline(F.flatten(later))).filter(F.col("item_a") < F.col("item_b"))
             .groupBy(*keys, "item_a", "item_b", "s1", "s2", "n").agg(F.count(F.lit(1)).alias("baskets"))
             .filter(F.col("baskets") >= min_count))
    n, pc = F.col("n").cast("double"), F.col("baskets").cast("double")
    return pairs.select(
        *keys, "item_a", "item_b", "baskets",
        F.round(100.0 * pc / n, 1).alias("support_pct"),
        F.round(100.0 * pc / F.col("s1"), 0).alias("a_to_b_pct"),
        F.round(100.0 * pc / F.col("s2"), 0).alias("b_to_a_pct"),
        F.round((pc / n) / ((F.col("s1") / n) * (F.col("s2") / n)), 2).alias("lift"))


def basket_attach(base: DataFrame) -> DataFrame:
    """Share of baskets with a main that also have rice / naan / poppadom / a drink."""
    item = F.col("item")
    flags = base.groupBy("bl", "ar", "site").agg(
        F.bool_or((F.col("agn") == "Food") & ~item.rlike("(?i)" + NOT_MAIN)).alias("has_main"),
        F.bool_or(item.rlike("(?i)" + ATTACH["rice"])).alias("has_rice"),
        F.bool_or(item.rlike("(?i)" + ATTACH["naan"])).alias("has_naan"),
        F.bool_or(item.rlike("(?i)" + ATTACH["pop"])).alias("has_pop"),
        F.bool_or(F.col("agn").isin(*DRINK_GROUPS)).alias("has_drink"))
    mains = F.count_if(F.col("has_main"))

    def attach(flag):
        return F.round(100.0 * F.count_if(F.col("has_main") & F.col(flag))
                       / F.nullif(mains, F.lit(0)).cast("double"), 0)

    return flags.groupBy("site").agg(
        mains.alias("main_baskets"), attach("has_rice").alias("rice_attach_pct"),
        attach("has_naan").alias("naan_attach_pct"), attach("has_pop").alias("poppadom_attach_pct"),
        attach("has_drink").alias("drink_attach_pct"))


def kitchen_dish_day(report_lines: DataFrame, market_lines: DataFrame,
                     market_channel: str = "Market stall") -> DataFrame:
    """Units and value per (channel, day, dish), restaurant food plus market
    stall lines (the tip pseudo-line excluded); only days with units > 0."""
    rest = (report_lines.filter(F.col("accounting_group_name") == "Food")
            .groupBy("business_date", F.col("name").alias("dish"))
            .agg(F.sum("quantity").alias("units"), F.sum("net_ex_vat").alias("net_value"))
            .withColumn("channel", F.lit("Restaurant")))
    mk = (market_lines.filter(~F.col("name").eqNullSafe("Tip"))
          .groupBy(business_date("order_time").alias("business_date"), F.col("name").alias("dish"))
          .agg(F.sum("quantity").alias("units"), F.sum("total").alias("net_value"))
          .withColumn("channel", F.lit(market_channel)))
    out = rest.unionByName(mk).filter(F.col("units") > 0)
    return out.select("channel", "business_date", "dish", F.col("units").cast("decimal(20,3)").alias("units"),
                      F.col("net_value").cast("decimal(20,4)").alias("net_value"))


def kitchen_prep_dow(dish_day: DataFrame, as_of, window_days: int = 84) -> DataFrame:
    """Per (channel, dish, weekday) over the days before ``as_of``: days sold,
    average, exact interpolated 80th percentile, max and value. Days with no
    sales are not rows, as in the source."""
    d = F.col("business_date")
    end = F.lit(as_of).cast("date")
    recent = dish_day.filter(d.between(F.date_sub(end, window_days), F.date_sub(end, 1)))
    return (recent.groupBy("channel", "dish", iso_dow(d).alias("dow_iso"))
            .agg(F.min(F.date_format(d, "EEE")).alias("dow"),
                 F.count(F.lit(1)).alias("days_sold"),
                 F.round(F.avg("units"), 1).alias("avg_units"),
                 F.round(F.percentile(F.col("units").cast("double"), F.lit(0.8)), 1).alias("prep_to_p80"),
                 F.max("units").alias("max_units"),
                 F.round(F.sum("net_value"), 0).alias("net_value_84d")))
