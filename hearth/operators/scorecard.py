"""Site scorecards (V10-V13) and plates per cover.

The day spine is built the Spark way: the four per-(site, day) aggregates are
stacked with ``unionByName(allowMissingColumns=True)`` and folded by one
groupBy, instead of a DISTINCT spine plus four outer joins (four shuffles).
All inputs are already collapsed to (site, day) grain, so that one shuffle moves
a few rows per site-day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions.semantics import (business_date, clean_site_label, not_cancelled, site_key,
                                        week_start)
from hearth.operators.facts import RECEIPT_KEY, dominant_ringer
from hearth.plans.joins import broadcast_if_small

DAY = ["business_location_id", "business_date"]

# Fixed value: shareable dishes that count as two plates.
SHAREABLE_PATTERN = "mixed grill|vegetarian grill|poppad"
# Logins that are not people.
NON_PERSON_LOGINS = ["Order Anywhere", "Head Office", "Online Order"]


def _qty_if(cond):
    return F.sum(F.when(cond, F.col("quantity")))


def _fold(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Outer-merge per-key aggregates that each have at most one row per key."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    value_cols = [c for c in u.columns if c not in keys]
    return u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in value_cols])


def site_day(report_lines: DataFrame, sales: DataFrame, void_lines: DataFrame | None,
             cashoff: DataFrame, sites: DataFrame) -> DataFrame:
    """One row per (site, trading day) present in any of four sources.

    Void lines are the report lines (live receipts) that carry a void reason, so
    when ``void_lines`` is None their value is summed in the same pass over the
    lines instead of a second lines x receipts join."""
    rl = report_lines
    lines_agg = rl.groupBy(*DAY).agg(
        F.sum("net_ex_vat").alias("sales_exvat"),
        _qty_if(F.col("item_category") == "poppadoms").alias("poppadom_qty"),
        _qty_if(F.col("item_category") == "241 cocktails").alias("cocktail241_qty"),
        _qty_if(F.col("item_category") == "desserts").alias("dessert_qty"),
        F.sum(F.when(F.col("wet_dry") == "wet", F.col("net_ex_vat"))).alias("wet_exvat"),
        F.sum(F.when(F.col("wet_dry") == "dry", F.col("net_ex_vat"))).alias("dry_exvat"),
        _qty_if(F.col("wet_dry") == "wet").alias("drink_qty"),
        _qty_if(F.col("wet_dry") == "dry").alias("plate_qty"),
        *([] if void_lines is not None else
          [F.sum(F.when(F.coalesce(F.col("void_reason"), F.lit("")) != "", -F.col("net_ex_vat"))).alias("void_value")]),
    )
    covers_agg = (sales.filter(not_cancelled())
                  .groupBy("business_location_id", business_date("time_closed").alias("business_date"))
                  .agg(F.sum(F.coalesce(F.col("nb_covers"), F.lit(0))).cast("long").alias("covers")))
    void_agg = (void_lines.groupBy(*DAY).agg(F.sum("voided_value").alias("void_value"))
                if void_lines is not None else None)
    sn = broadcast_if_small(sites.select("business_location_id", site_key(F.col("nickname")).alias("_k")), basis=sites)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    delivery_agg = (cashoff.join(sn, site_key(F.col("site")) == sn["_k"])
                    .groupBy("business_location_id", "business_date")
                    .agg(F.sum(z("uber_eats") + z("just_eat") + z("deliveroo")).alias("delivery_total")))
    d = _fold([x for x in (lines_agg, covers_agg, void_agg, delivery_agg) if x is not None], DAY)
    st = broadcast_if_small(sites.select("business_location_id", F.col("nickname").alias("site")), basis=sites)
    d = d.join(st, "business_location_id")
    traded = F.col("sales_exvat").isNotNull()
    when_traded = lambda c: F.when(traded, z(c))
    wd = z("wet_exvat") + z("dry_exvat")
    return d.select(
        "business_location_id", "site", "business_date",
        traded.alias("traded"),
        "sales_exvat", "delivery_total",
        when_traded("poppadom_qty").alias("poppadom_qty"),
        when_traded("cocktail241_qty").alias("cocktail241_qty"),
        when_traded("dessert_qty").alias("dessert_qty"),
        when_traded("void_value").alias("void_value"),
        F.when(z("sales_exvat") > 0,
               F.round(z("void_value").cast("double") / F.col("sales_exvat").cast("double") * 100, 2)
               ).alias("void_pct"),
        "wet_exvat", "dry_exvat",
        F.when(wd > 0, F.round(z("wet_exvat").cast("double") / wd.cast("double") * 100, 1)).alias("wet_pct"),
        F.when(wd > 0, F.round(z("dry_exvat").cast("double") / wd.cast("double") * 100, 1)).alias("dry_pct"),
        "covers",
        when_traded("drink_qty").alias("drink_qty"),
        when_traded("plate_qty").alias("plate_qty"),
        F.when(z("covers") > 0, F.round(z("drink_qty").cast("double") / F.col("covers").cast("double"), 2))
         .alias("drinks_per_cover"),
    )


RANKED = [("sales_exvat", "sales_rank", False), ("delivery_total", "delivery_rank", False),
          ("poppadom_qty", "poppadom_rank", False), ("cocktail241_qty", "cocktail241_rank", False),
          ("dessert_qty", "dessert_rank", False), ("void_pct", "void_rank", True)]


def with_ranks(df: DataFrame, period_col: str) -> DataFrame:
    """Per-period rank of each metric; NULL metric -> NULL rank; void % ascending."""
    out = df
    for metric, name, asc in RANKED:
        o = F.col(metric).asc_nulls_last() if asc else F.col(metric).desc_nulls_last()
        w = Window.partitionBy(period_col).orderBy(o)
        out = out.withColumn(name, F.when(F.col(metric).isNotNull(), F.rank().over(w)).cast("long"))
    return out


def site_day_ranked(site_day_df: DataFrame) -> DataFrame:
    return with_ranks(site_day_df, "business_date")


def site_week(site_day_df: DataFrame) -> DataFrame:
    """ISO-week sums; ratios recomputed from the sums."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    g = site_day_df.groupBy("business_location_id", "site", week_start("business_date").alias("week_start")).agg(
        *[F.sum(c).alias(c) for c in ("sales_exvat", "delivery_total", "poppadom_qty", "cocktail241_qty",
                                      "dessert_qty", "void_value", "wet_exvat", "dry_exvat", "covers",
                                      "drink_qty", "plate_qty")],
        F.sum(z("void_value")).alias("_v0"), F.sum(z("wet_exvat")).alias("_w0"),
        F.sum(z("dry_exvat")).alias("_d0"), F.sum(z("covers")).alias("_c0"),
        F.sum(z("drink_qty")).alias("_dq0"))
    wd = (F.col("_w0") + F.col("_d0")).cast("double")
    return g.select(
        "business_location_id", "site", "week_start",
        "sales_exvat", "delivery_total", "poppadom_qty", "cocktail241_qty", "dessert_qty", "void_value",
        F.when(F.col("sales_exvat") > 0,
               F.round(F.col("_v0").cast("double") / F.col("sales_exvat").cast("double") * 100, 2)).alias("void_pct"),
        "wet_exvat", "dry_exvat",
        F.when(wd > 0, F.round(F.col("_w0").cast("double") / wd * 100, 1)).alias("wet_pct"),
        F.when(wd > 0, F.round(F.col("_d0").cast("double") / wd * 100, 1)).alias("dry_pct"),
        "covers", "drink_qty", "plate_qty",
        F.when(F.col("_c0") > 0, F.round(F.col("_dq0").cast("double") / F.col("covers").cast("double"), 2))
         .alias("drinks_per_cover"),
    )


def site_week_ranked(site_week_df: DataFrame) -> DataFrame:
    return with_ranks(site_week_df, "week_start")


def plates_per_cover_site(lines: DataFrame, sales: DataFrame, sites: DataFrame,
                          shareable: str = SHAREABLE_PATTERN) -> DataFrame:
    """Food quantity per receipt (shareables x2), summed per site-day, / covers."""
    weight = F.when(F.lower(F.col("name")).rlike(shareable), F.lit(2)).otherwise(F.lit(1))
    recf = lines.groupBy(*RECEIPT_KEY).agg(
        F.sum(F.when(F.col("accounting_group_name") == "Food", F.col("quantity") * weight)
               .otherwise(F.lit(0))).alias("plates"))
    s = sales.filter(not_cancelled() & F.col("time_closed").isNotNull())
    st = broadcast_if_small(sites.select("business_location_id", "nickname"), basis=sites)
    j = s.join(recf, RECEIPT_KEY).join(st, "business_location_id", "left")
    g = j.groupBy(clean_site_label(F.col("nickname")).alias("site"), "business_location_id",
                  business_date("time_closed").alias("business_date")).agg(
        F.sum("plates").alias("plates"),
        F.sum(F.coalesce(F.col("nb_covers"), F.lit(0))).cast("long").alias("covers"),
        F.sum("nb_covers").alias("_c"))
    return g.select("site", "business_location_id", "business_date", "plates", "covers",
                    F.round(F.col("plates").cast("double") / F.nullif(F.col("_c"), F.lit(0)).cast("double"), 2)
                     .alias("plates_per_cover"))


def plates_per_cover_staff(line_staff: DataFrame, sales: DataFrame, sites: DataFrame) -> DataFrame:
    """Dry quantity and covers per receipt credited to its dominant ringer
    (unweighted, as in the source view)."""
    prim = dominant_ringer(line_staff, "line_staff", "net_ex_vat")
    recf = line_staff.groupBy(*RECEIPT_KEY).agg(
        F.sum(F.when(F.col("wet_dry") == "dry", F.col("quantity"))).alias("plates"))
    s = sales.filter(not_cancelled() & F.col("time_closed").isNotNull())
    st = broadcast_if_small(sites.select("business_location_id", "nickname"), basis=sites)
    j = (prim.filter(~F.col("ringer").isin(*NON_PERSON_LOGINS))
             .join(s, RECEIPT_KEY).join(recf, RECEIPT_KEY).join(st, "business_location_id", "left"))
    g = j.groupBy(F.col("ringer").alias("staff"), "business_location_id",
                  clean_site_label(F.col("nickname")).alias("site"),
                  business_date("time_closed").alias("business_date")).agg(
        F.sum("plates").alias("plates"),
        F.sum(F.coalesce(F.col("nb_covers"), F.lit(0))).cast("long").alias("covers"),
        F.sum("nb_covers").alias("_c"))
    return g.select("staff", "business_location_id", "site", "business_date", "plates", "covers",
                    F.round(F.col("plates").cast("double") / F.nullif(F.col("_c"), F.lit(0)).cast("double"), 2)
                     .alias("plates_per_cover"))
