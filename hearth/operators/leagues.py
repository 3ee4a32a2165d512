"""Site league tables over a date range.

The aggregations collapse lines to one row per site before any window runs, so
the un-partitioned RANK windows only ever see (number of sites) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def in_range(df: DataFrame, start, end, col: str = "time_closed") -> DataFrame:
    """``col BETWEEN start AND end`` (timestamps; a date ``end`` stops at its midnight,
    as the source dashboards do)."""
    return df.filter(F.col(col).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def _rank_desc(c):
    return F.rank().over(Window.orderBy(F.coalesce(c, F.lit(0)).desc()))


def total_sales_league(fact_lines: DataFrame, start, end) -> DataFrame:
    """Total ex-VAT sales per site, rank 1 = highest."""
    agg = in_range(fact_lines, start, end).groupBy("site").agg(F.sum("net_ex_vat").alias("s"))
    return agg.select(
        _rank_desc(F.col("s")).cast("long").alias("rank"),
        "site",
        F.round(F.coalesce(F.col("s"), F.lit(0)), 2).cast("double").alias("total_sales"),
    )


def wet_dry_league(fact_lines: DataFrame, start, end) -> DataFrame:
    """Wet and dry sales per site, ranked on wet; wet % of (wet + dry)."""
    f = in_range(fact_lines, start, end)
    wet = F.sum(F.when(F.col("wet_dry") == "wet", F.col("net_ex_vat")))
    dry = F.sum(F.when(F.col("wet_dry") == "dry", F.col("net_ex_vat")))
    both = F.sum(F.when(F.col("wet_dry").isin("wet", "dry"), F.col("net_ex_vat")))
    agg = f.groupBy("site").agg(wet.alias("w"), dry.alias("d"), both.alias("b"))
    return agg.select(
        _rank_desc(F.col("w")).cast("long").alias("rank_wet"),
        "site",
        F.round(F.coalesce("w", F.lit(0)), 2).cast("double").alias("wet_sales"),
        F.round(F.coalesce("d", F.lit(0)), 2).cast("double").alias("dry_sales"),
        F.round(F.col("w").cast("double") * 100.0 / F.nullif(F.col("b").cast("double"), F.lit(0.0)), 1)
         .alias("wet_pct"),
    )


def tips_league(fact_payments: DataFrame, start, end) -> DataFrame:
    """Tips per site."""
    agg = in_range(fact_payments, start, end).groupBy("site").agg(F.sum("tip").alias("t"))
    return agg.select(
        _rank_desc(F.col("t")).cast("long").alias("rank"),
        "site",
        F.round(F.coalesce("t", F.lit(0)), 2).cast("double").alias("total_tips"),
    )


def exploded_categories(lines_with_cats: DataFrame) -> DataFrame:
    """Lines LEFT JOIN their categories, as the dashboard cards do: a line in two
    categories appears twice, a line in none once with a NULL category. Done as
    ``explode_outer`` of the per-line category array, so no join and no shuffle."""
    return lines_with_cats.withColumn("category", F.explode_outer("categories"))


def category_league(lines_with_cats: DataFrame, category: str, start, end) -> DataFrame:
    """Net sales and units of one item category per site; every site appears."""
    f = exploded_categories(in_range(lines_with_cats, start, end))
    hit = F.col("category") == category
    agg = f.groupBy("site").agg(F.sum(F.when(hit, F.col("net_ex_vat"))).alias("n"),
                                F.sum(F.when(hit, F.col("quantity"))).alias("q"))
    return agg.select(
        _rank_desc(F.col("n")).cast("long").alias("rank"),
        "site",
        F.round(F.coalesce("n", F.lit(0)), 2).cast("double").alias("net_sales"),
        F.round(F.coalesce("q", F.lit(0)), 0).cast("double").alias("units"),
    )


def scoreboard(lines_with_cats: DataFrame, fact_payments: DataFrame, start, end,
               dedupe: bool = False) -> DataFrame:
    """Six metrics, six ranks, one row per site.

    As in the source card the category LEFT JOIN repeats a line that sits in two
    categories, so total/wet/dry count it twice; ``dedupe=True`` sums each line once.
    """
    f = in_range(lines_with_cats, start, end)
    if dedupe:
        cat = lambda c: F.sum(F.when(F.array_contains(F.col("categories"), c), F.col("net_ex_vat")))
    else:
        f = exploded_categories(f)
        cat = lambda c: F.sum(F.when(F.col("category") == c, F.col("net_ex_vat")))
    base = f.groupBy("site").agg(
        F.sum("net_ex_vat").alias("total_sales"),
        F.sum(F.when(F.col("wet_dry") == "wet", F.col("net_ex_vat"))).alias("wet_sales"),
        F.sum(F.when(F.col("wet_dry") == "dry", F.col("net_ex_vat"))).alias("dry_sales"),
        cat("poppadoms").alias("poppadom_sales"),
        cat("cocktails").alias("cocktail_sales"),
        cat("desserts").alias("dessert_sales"),
    )
    tips = in_range(fact_payments, start, end).groupBy("site").agg(F.sum("tip").alias("total_tips"))
    b = base.join(tips, "site", "left")
    r = lambda c: _rank_desc(F.col(c)).cast("long")
    return b.select(
        "site",
        F.round(F.coalesce("total_sales", F.lit(0)), 2).cast("double").alias("total_sales"),
        r("total_sales").alias("rank_sales"),
        r("wet_sales").alias("rank_wet"),
        r("total_tips").alias("rank_tips"),
        r("poppadom_sales").alias("rank_poppadoms"),
        r("cocktail_sales").alias("rank_cocktails"),
        r("dessert_sales").alias("rank_desserts"),
    )
