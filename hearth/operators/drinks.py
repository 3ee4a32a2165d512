"""Drinks ordering (V34-V42): what was poured over the last completed days,
turned into kegs, bottles and units to order.

Brand reference rows (keg serves, packaged products, cocktail recipes, wine
measures) are input DataFrames; each is a short menu-sized list and is
broadcast behind a size check. The source report covers one site; here every
site gets its own rows (grouped by site).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.functions.semantics import LONDON, clean_site_label, local_time, round_div
from hearth.plans.joins import broadcast_if_small

DRINK_GROUPS = ["Alcoholic Drinks", "Non-Alcoholic Drinks"]
# Spirit measures rung into the product name, and order rules.
MEASURE = r"(^| )(25|50)ml($| )"
MEASURE_TAIL = r"\s*(25|50)ml.*$"
BOTTLE_ML = 700
WINE_BOTTLE_ML = 750
PROSECCO_PER_SPRITZ_ML = 100
CATEGORY_ORDER = ["Draught Beer", "Packaged Beer/Cider", "Spirit", "Wine", "Cocktail", "Soft Drink"]


def _london_midnight(day) -> "F.Column":
    return F.convert_timezone(F.lit(LONDON), F.current_timezone(), day.cast("timestamp_ntz")).cast("timestamp")


def drinks_base(lines: DataFrame, sites: DataFrame, as_of, window_days: int = 7) -> DataFrame:
    """Positive drink lines sold in the ``window_days`` completed London
    days before ``as_of``, summed per (site, sku, name, group, price)."""
    end_day = F.lit(as_of).cast("date")
    lo, hi = _london_midnight(F.date_sub(end_day, window_days)), _london_midnight(end_day)
    st = broadcast_if_small(sites.select("business_location_id", clean_site_label(F.col("nickname")).alias("site")), basis=sites)
    l = lines.filter((F.col("quantity") > 0) & F.col("accounting_group_name").isin(*DRINK_GROUPS)
                     & (F.col("time_of_sale") >= lo) & (F.col("time_of_sale") < hi))
    return (l.join(st, "business_location_id")
             .groupBy("site", "sku", "name", "accounting_group_name", "menu_list_price")
             .agg(F.sum("quantity").alias("qty")))


def kegs(base: DataFrame, keg_ref: DataFrame) -> DataFrame:
    """Draught serves -> litres, pints, kegs consumed and kegs to order."""
    j = base.join(broadcast_if_small(keg_ref), "sku")
    g = j.groupBy("site", "keg_name", "keg_litres").agg(
        F.sum("qty").alias("pints_halves_sold"), F.sum(F.col("qty") * F.col("serve_ml")).alias("ml"))
    return g.select("site", "keg_name", F.col("keg_litres").alias("keg_size_l"), "pints_halves_sold",
                    round_div("ml", F.lit(1000), 1, scale=3).alias("litres_sold"),
                    round_div("ml", F.lit(568), 1, scale=3).alias("pints_sold"),
                    round_div("ml", F.col("keg_litres") * 1000, 2, scale=3).alias("kegs_consumed"),
                    F.ceil(F.col("ml") / (F.col("keg_litres") * 1000)).alias("kegs_to_order"))


def packaged(base: DataFrame, packaged_ref: DataFrame) -> DataFrame:
    """Bottles and cans as units."""
    j = base.join(broadcast_if_small(packaged_ref), "sku")
    return j.groupBy("site", "product").agg(F.sum("qty").alias("units_sold"),
                                            F.ceil(F.sum("qty")).alias("units_to_order"))


def spirits(base: DataFrame, cocktail_bom: DataFrame) -> DataFrame:
    """Straight measures (25/50 ml read from the product name, 0% excluded)
    plus cocktail recipe usage (bill of materials); a bottle is ordered for each
    full 700 ml used and one more when the remainder is over half a bottle."""
    name = F.col("name")
    straight = (base.filter((F.col("accounting_group_name") == "Alcoholic Drinks") & name.rlike(MEASURE)
                            & ~name.contains("0%"))
                .select("site", F.trim(F.regexp_replace(name, MEASURE_TAIL, "")).alias("spirit"),
                        (F.col("qty") * F.when(name.rlike(r"(^| )50ml"), F.lit(50)).otherwise(F.lit(25)))
                        .cast("decimal(24,5)").alias("ml"),
                        F.lit("straight").alias("src")))
    cocktail = (base.join(broadcast_if_small(cocktail_bom), "sku")
                .select("site", "spirit", (F.col("qty") * F.col("ml")).cast("decimal(24,5)").alias("ml"),
                        F.lit("cocktail").alias("src")))
    c = straight.unionByName(cocktail)
    g = c.groupBy("site", "spirit").agg(
        F.coalesce(F.sum(F.when(F.col("src") == "straight", F.col("ml"))), F.lit(0)).alias("straight_ml"),
        F.coalesce(F.sum(F.when(F.col("src") == "cocktail", F.col("ml"))), F.lit(0)).alias("cocktail_ml"),
        F.sum("ml").alias("total_ml"))
    full = F.floor(F.col("total_ml") / BOTTLE_ML)
    extra = F.when(F.col("total_ml") - BOTTLE_ML * full > BOTTLE_ML / 2, F.lit(1)).otherwise(F.lit(0))
    return g.select("site", "spirit", "straight_ml", "cocktail_ml", "total_ml",
                    round_div("total_ml", F.lit(BOTTLE_ML), 2, scale=5).alias("bottles_700ml"),
                    (full + extra).alias("bottles_to_order"))


def wine(base: DataFrame, wine_ref: DataFrame, cocktail_ref: DataFrame) -> DataFrame:
    """Wine by the glass/bottle plus the prosecco that goes into spritzes."""
    by_glass = (base.join(broadcast_if_small(wine_ref), "sku")
                .select("site", "wine_name", (F.col("qty") * F.col("ml")).alias("ml")))
    spritz = broadcast_if_small(cocktail_ref.filter(F.col("is_spritz")).select("sku"), basis=cocktail_ref)
    pros = (base.join(spritz, "sku")
            .select("site", F.lit("Prosecco").alias("wine_name"), (F.col("qty") * PROSECCO_PER_SPRITZ_ML).alias("ml")))
    u = by_glass.unionByName(pros)
    g = u.groupBy("site", "wine_name").agg(F.sum("ml").cast("decimal(24,3)").alias("ml_poured"))
    return g.select("site", "wine_name", "ml_poured",
                    round_div("ml_poured", F.lit(WINE_BOTTLE_ML), 2, scale=3).alias("bottles_equiv"),
                    F.ceil(F.col("ml_poured") / WINE_BOTTLE_ML).alias("bottles_to_order"))


def _paid_split(df, key, prefix):
    price, q = F.col("menu_list_price"), F.col("qty")
    return df.groupBy("site", key).agg(
        F.sum(F.when(price > 0, q).otherwise(F.lit(0))).alias(f"paid_{prefix}"),
        F.sum(F.when(price == 0, q).otherwise(F.lit(0))).alias(f"bottomless_{prefix}"),
        F.sum(q).alias(f"total_{prefix}"))


def cocktails(base: DataFrame, cocktail_ref: DataFrame) -> DataFrame:
    """Paid vs bottomless (price 0) serves; a NULL price counts in neither."""
    j = base.join(broadcast_if_small(cocktail_ref.select("sku", "cocktail_name"), basis=cocktail_ref), "sku")
    return _paid_split(j, "cocktail_name", "serves")


def softs(base: DataFrame) -> DataFrame:
    """The same split for soft drinks, by product name."""
    b = base.filter(F.col("accounting_group_name") == "Non-Alcoholic Drinks").withColumnRenamed("name", "product")
    return _paid_split(b, "product", "units")


def order_report(k, p, s, w, c, sd) -> DataFrame:
    """One layout for every category, with the category's display rank."""
    nul = lambda t: F.lit(None).cast(t)
    parts = [
        k.select("site", F.lit("Draught Beer").alias("category"), F.col("keg_name").alias("product"),
                 F.col("pints_sold").cast("double").alias("consumed"), F.lit("pints").alias("unit"),
                 F.col("litres_sold").cast("double").alias("litres"), nul("double").alias("bottomless"),
                 F.col("kegs_to_order").cast("double").alias("to_order"), F.lit("kegs").alias("order_unit")),
        p.select("site", F.lit("Packaged Beer/Cider"), "product", F.col("units_sold").cast("double"),
                 F.lit("units"), nul("double"), nul("double"), F.col("units_to_order").cast("double"), F.lit("units")),
        s.select("site", F.lit("Spirit"), "spirit", F.col("total_ml").cast("double"), F.lit("ml"), nul("double"),
                 nul("double"), F.col("bottles_to_order").cast("double"), F.lit("700ml bottles")),
        w.select("site", F.lit("Wine"), "wine_name", F.col("ml_poured").cast("double"), F.lit("ml"), nul("double"),
                 nul("double"), F.col("bottles_to_order").cast("double"), F.lit("75cl bottles")),
        c.select("site", F.lit("Cocktail"), "cocktail_name", F.col("total_serves").cast("double"), F.lit("serves"),
                 nul("double"), F.col("bottomless_serves").cast("double"), nul("double"), F.lit("")),
        sd.select("site", F.lit("Soft Drink"), "product", F.col("total_units").cast("double"), F.lit("units"),
                  nul("double"), F.col("bottomless_units").cast("double"), nul("double"), F.lit("")),
    ]
    u = parts[0]
    for x in parts[1:]:
        u = u.union(x)
    rank = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in CATEGORY_ORDER]), F.col("category")).cast("int"),
                      F.lit(9))
    return u.withColumn("category_rank", rank)


def drinks_intel(lines: DataFrame, sites: DataFrame) -> DataFrame:
    """Daily units and estimated revenue per drink, all time."""
    st = broadcast_if_small(sites.select("business_location_id", clean_site_label(F.col("nickname")).alias("site")), basis=sites)
    l = lines.filter((F.col("quantity") > 0) & F.col("accounting_group_name").isin(*DRINK_GROUPS)).join(st, "business_location_id")
    cat = (F.when(F.col("accounting_group_name") == "Alcoholic Drinks", F.lit("Alcoholic"))
            .when(F.col("accounting_group_name") == "Non-Alcoholic Drinks", F.lit("Non-Alcoholic"))
            .otherwise(F.col("accounting_group_name")))
    return l.groupBy(F.to_date(local_time("time_of_sale")).alias("sale_day"), "site", cat.alias("category"),
                     F.col("name").alias("product")).agg(
        F.sum("quantity").alias("units"),
        F.round(F.sum(F.col("quantity") * F.col("menu_list_price")), 2).alias("est_revenue"))
